"""Bulk file ingest and delimited exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.sinks.tables import write_table
from cardspark.sources.landing import file_name, read_csv


def ingest_files(
    spark: SparkSession, paths: str | list[str], table: str, hook: Callable[..., DataFrame] | None = None,
    hook_args: dict | None = None, mode: str = "append", path: str | None = None, **options: object,
) -> DataFrame:
    """Files of one structure into one table; returns (file_name, lines).

    All files are read as one frame that carries `FileSource`, so the hook is
    called once and the work is spread over tasks instead of threads.
    """
    rows = read_csv(spark, paths, **options).withColumn("FileSource", file_name())
    out = rows if hook is None else rows.transform(hook, **(hook_args or {}))
    write_table(out, table, mode, path=path)
    return rows.groupBy(F.col("FileSource").alias("file_name")).agg(F.count("*").alias("lines"))


def ingest_file_per_table(spark: SparkSession, paths: str | list[str], root: str, **options: object) -> DataFrame:
    """Each file into its own partition named after it, replacing an earlier load.

    `root/file_stem=<name>` is the table of a file; other files keep theirs.
    """
    rows = read_csv(spark, paths, **options).withColumn("file_stem", F.regexp_replace(file_name(), r"\.csv$", ""))
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_stem").parquet(root)
    )
    return rows.groupBy("file_stem").agg(F.count("*").alias("lines"))


def export_csv(
    df: DataFrame, path: str, run_date: dt.date, sep: str = ";", compression: str | None = None
) -> str:
    """Delimited text with a header in `<path>_<yyyymmdd>`, one part per task; returns the folder."""
    folder = f"{path.rstrip('/')}_{run_date:%Y%m%d}"
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(folder)
    return folder


def archive_copy(df: DataFrame, folder: str, **options: object) -> DataFrame:
    """Keep a CSV copy of a frame that was read and hand the frame on."""
    df.write.mode("append").options(**{"header": True, **options}).csv(folder)
    return df
