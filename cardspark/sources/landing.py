"""Landing folders: files chosen by the date in their name, read as one frame."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardspark import schemas
from cardspark.operators.clean import transaction_file_day

def file_name() -> Column:
    """Name of the file a row was read from."""
    return F.col("_metadata.file_name")

# fixed values: last day before layout B and last day of layout B
LAYOUT_B_FROM = dt.date(2019, 1, 16)
LAYOUT_B_TO = dt.date(2019, 3, 12)

CORRUPT = "_corrupt_record"
CORRUPT_FIELD = StructField(CORRUPT, StringType())


def _day(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def file_day(name: Column, pattern: str) -> Column:
    """Day in a file name of one of three kinds: transactions, activations, status."""
    if pattern == "transactions":
        return transaction_file_day(name)
    if pattern == "activations":
        return _day(F.regexp_extract(name, r"_(\d{8})[^_]*\.csv$", 1))
    if pattern == "status":
        found = F.regexp_extract(name, r"^[^-]*-(\d{4}-\d{2}-\d{2})", 1)
        return _day(F.replace(found, F.lit("-"), F.lit("")))
    raise ValueError("pattern is transactions, activations or status")


def _tested_day(name: Column, pattern: str) -> Column:
    """Transactions are tested by the day of their rows, one before the file day."""
    day = file_day(name, pattern)
    return F.date_sub(day, 1) if pattern == "transactions" else day


def in_window(name: Column, pattern: str, start: dt.date | None, end: dt.date | None) -> Column:
    tested = _tested_day(name, pattern)
    keep = tested.isNotNull()
    if start is not None:
        keep = keep & (tested >= F.lit(start))
    if end is not None:
        keep = keep & (tested <= F.lit(end))
    return keep


def landing_files(
    spark: SparkSession, folder: str, pattern: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Files of a window with their days; the contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        .select("path", "length", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    name = F.col("file_name")
    data_day = F.date_sub(file_day(name, pattern), 1)
    return listed.filter(in_window(name, pattern, start, end)).select(
        "path", "file_name", "length", file_day(name, pattern).alias("file_day"), data_day.alias("data_day"),
        F.year(data_day).alias("Year"), F.month(data_day).alias("Month"), F.dayofmonth(data_day).alias("Day"),
    )


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: StructType | None = None, sep: str = ",",
    encoding: str = "ISO-8859-1", header: bool = True, mode: str = "FAILFAST",
) -> DataFrame:
    """CSV files; `mode` FAILFAST stops at a bad line, DROPMALFORMED skips it.

    Without a schema the header line names text columns. Lines are parsed whole
    even where few columns are wanted, as a bad line would pass otherwise.
    """
    reader = spark.read.option("columnPruning", False).option("sep", sep).option("encoding", encoding).option("header", header)
    reader = reader.option("mode", mode).option("pathGlobFilter", "*.csv")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def read_landing(
    spark: SparkSession, folder: str, pattern: str, start: dt.date | None = None, end: dt.date | None = None,
    schema: StructType | None = None, **options: object,
) -> DataFrame:
    """All files of a window as one frame with `FileSource`.

    Columns go by the names in each file's own header, whatever their order:
    files with the same header are read together, and columns that only some
    headers have are null elsewhere. A `schema` gives types by name; its columns
    must be in every header unless `mode` is PERMISSIVE. Without headers the
    columns go by position, and the window is a predicate on the file name, so
    that no list of paths is built.
    """
    name = file_name()
    if not options.get("header", True):
        rows = read_csv(spark, folder, schema, **options)
        return rows.filter(in_window(name, pattern, start, end)).withColumn("FileSource", name)
    parts = []
    for line, paths in headers(spark, folder, pattern, start, end, str(options.get("encoding", "ISO-8859-1"))).items():
        names = [c.strip() for c in next(csv.reader([line], delimiter=str(options.get("sep", ","))))]
        if len(set(names)) < len(names):
            raise ValueError(f"a header names a column twice: {line}")
        missing = [c for c in (schema.names if schema else []) if c not in names]
        if missing and options.get("mode") != "PERMISSIVE":
            raise ValueError(f"{paths[0]} lacks the columns {missing}")
        kinds = {f.name: f.dataType for f in schema or []}
        own = reduce(lambda s, c: s.add(c, kinds.get(c, StringType())), names, StructType())
        rows = read_csv(spark, paths, own, **options)
        wanted = [F.col(f"`{c}`") for c in names if not kinds or c in kinds]
        parts.append(rows.select(*wanted, name.alias("FileSource")))
    if not parts:
        return spark.createDataFrame([], StructType(list(schema or [])).add("FileSource", "string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def headers(
    spark: SparkSession, folder: str, pattern: str, start: dt.date | None = None, end: dt.date | None = None,
    encoding: str = "ISO-8859-1",
) -> dict[str, list[str]]:
    """The distinct header lines of a window's files and the files that have each."""
    # the whole line as one cell
    lines = spark.read.schema("line string").option("sep", "\u0001").option("quote", "").option(
        "encoding", encoding).option("pathGlobFilter", "*.csv").csv(folder)
    first = lines.filter(in_window(file_name(), pattern, start, end) & (F.col("_metadata.file_block_start") == 0)).select(
        "line", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"),
    ).groupBy("path").agg(F.min_by("line", "at").alias("line"))
    out: dict[str, list[str]] = {}
    for row in first.orderBy("path").collect():  # one row per file, as many as Spark lists to plan the read
        out.setdefault(row["line"].lstrip("\ufeff"), []).append(row["path"])
    return out


def read_card_status(
    spark: SparkSession, folder: str, start: dt.date | None = None, end: dt.date | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Header-less card-status files; the layout follows the date in the name.

    Files of the first layout have 20 or 21 columns: the missing one is null.
    Lines of any other length stop the job under FAILFAST and are skipped under
    DROPMALFORMED.
    """
    def layout(schema: StructType, first: dt.date | None, last: dt.date | None, how: str) -> DataFrame:
        lower = max(d for d in (first, start) if d is not None) if first or start else None
        upper = min(d for d in (last, end) if d is not None) if last or end else None
        return read_landing(spark, folder, "status", lower, upper, schema=schema, header=False, mode=how)

    one = dt.timedelta(days=1)
    a = _layout_a(layout, LAYOUT_B_FROM - one, mode)
    b = layout(schemas.STATUS_LAYOUT_B, LAYOUT_B_FROM, LAYOUT_B_TO, mode)
    c = layout(schemas.STATUS_LAYOUT_C, LAYOUT_B_TO + one, None, mode)
    everything = a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return everything.withColumn("file_day", file_day(F.col("FileSource"), "status"))


def _layout_a(layout: Callable[..., DataFrame], last: dt.date, mode: str) -> DataFrame:
    """Lines of 20 or 21 cells; `mode` decides on the others."""
    wide, corrupt = schemas.STATUS_LAYOUT_A, F.col(CORRUPT)
    rows = layout(StructType([*wide.fields, CORRUPT_FIELD]), None, last, "PERMISSIVE")
    # a line that does not fit is parsed again as one of 20 cells, which says whether it has as many
    short = StructType([*wide.fields[:-1], CORRUPT_FIELD])
    again = F.from_csv(corrupt, ", ".join(f"`{f.name}` string" for f in short), {"columnNameOfCorruptRecord": CORRUPT})
    good = corrupt.isNull() | again[CORRUPT].isNull()
    if mode == "FAILFAST":
        good = F.when(good, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("malformed line: "), corrupt)).cast("boolean"))
    elif mode == "PERMISSIVE":
        good = F.lit(True)
    # Spark refuses a query that needs the corrupt records alone, so a first cell is always read
    return rows.filter(good & (F.length(F.concat_ws("", corrupt, wide.names[0])) >= 0)).drop(CORRUPT)


def read_table(spark: SparkSession, name_or_query: str) -> DataFrame:
    """A warehouse table by name, or the result of a query."""
    text = name_or_query.strip()
    return spark.sql(text) if " " in text else spark.table(text)
