"""Warehouse tables: append, replace, refresh, month partitions, idempotent days."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardspark.functions.dates import one_day, period


def _schema_of(spark: SparkSession, name: str) -> None:
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name.split('.')[0]}`")


def write_table(
    df: DataFrame, name: str, mode: str = "append", partition_by: list[str] | None = None, path: str | None = None
) -> None:
    """Append to or replace a table, creating it (and its schema) when missing.

    `path` makes it an external table stored there. Partitions of the frame are
    the parallel writers.
    """
    _schema_of(df.sparkSession, name)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def with_month(df: DataFrame, ts: str = "TransactionTime") -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def write_monthly(df: DataFrame, name: str, path: str | None = None, ts: str = "TransactionTime") -> None:
    """Append rows to the month partition of their day.

    Rows of a month are gathered before writing, so that the number of files
    stays small; adaptive execution splits months that exceed a partition.
    """
    monthly = with_month(df, ts)
    write_table(monthly.hint("rebalance", "year", "month"), name, "append", ["year", "month"], path)


def create_table(
    spark: SparkSession, name: str, schema: StructType, keep_order: bool = False, path: str | None = None
) -> DataFrame:
    """Empty table from a declared schema, columns sorted unless `keep_order`."""
    _schema_of(spark, name)
    fields = schema.fields if keep_order else sorted(schema.fields, key=lambda f: f.name)
    kwargs = {"path": path} if path else {}
    return spark.catalog.createTable(name, source="parquet", schema=StructType(list(fields)), **kwargs)


def schema_like(spark: SparkSession, name: str) -> StructType:
    """Schema of an existing table, to create another one like it."""
    return spark.table(name).schema


def refresh_snapshot(df: DataFrame, name: str, root: str) -> None:
    """Replace all rows of a table that `df` may itself be computed from.

    The new rows go to a fresh folder below `root`; then the table is pointed at
    it. Readers see the old snapshot until that step, and a failed write leaves
    it in place. When the columns or their types differ from the table's, the
    table is defined again over the new folder, so added, removed and retyped
    columns all follow `df` (the old folder stays, like every earlier version).
    """
    spark = df.sparkSession
    _schema_of(spark, name)
    folder = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.format("parquet").save(folder)
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    if spark.catalog.tableExists(name):
        before = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
        if before == [(f.name, f.dataType) for f in spark.read.parquet(folder).schema.fields]:
            spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {quoted}")  # an external table: its files stay
    spark.catalog.createTable(name, path=folder, source="parquet")


def append_day(target: DataFrame | None, batch: DataFrame, day: dt.date | str | None = None,
               ts: str = "TransactionTime") -> DataFrame:
    """Rows of `batch` whose day has no row in `target` yet.

    With `day`, one look at that day decides. Without, the days present in the
    target are reduced to a list of distinct dates first.
    """
    if day is not None:
        span = one_day(day)
        batch = batch.filter(span.holds(ts))
        if target is None or period(target, span, ts).limit(1).isEmpty():
            return batch
        return batch.filter(F.lit(False))
    if target is None:
        return batch
    done = target.select(F.to_date(ts).alias("__day")).distinct()
    keyed = batch.withColumn("__day", F.to_date(ts))
    # one row per calendar day: small enough to broadcast for any history, and busy days stay spread
    return keyed.join(F.broadcast(done), "__day", "left_anti").drop("__day")


def append_day_to_table(batch: DataFrame, name: str, day: dt.date | str, path: str | None = None) -> None:
    """Idempotent daily append to a month-partitioned table."""
    spark = batch.sparkSession
    target = spark.table(name) if spark.catalog.tableExists(name) else None
    write_monthly(append_day(target, batch, day), name, path)
