"""Column types for a relational target, and the size of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: type names of the relational target and the text limit
SHORT_TEXT = 20
TYPE_NAMES = {"double": "double precision", "float": "double precision", "int": "INTEGER", "bigint": "INTEGER",
              "smallint": "INTEGER", "tinyint": "INTEGER", "timestamp": "timestamp without time zone",
              "timestamp_ntz": "timestamp without time zone", "date": "timestamp without time zone"}


def infer_column_types(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """(column, type): text is VARCHAR (40) up to 20 characters, else TEXT.

    One aggregation covers all text columns.
    """
    overrides = overrides or {}
    texts = [c for c, t in df.dtypes if t == "string"]
    widths = df.agg(F.lit(1).alias("__one"), *[F.max(F.length(F.col(f"`{c}`"))).alias(c) for c in texts])

    def kind(name: str, dtype: str):
        if name in overrides:
            return F.lit(overrides[name])
        if dtype == "string":
            short = F.coalesce(F.col(f"`{name}`"), F.lit(0)) <= SHORT_TEXT
            return F.when(short, F.lit("VARCHAR (40)")).otherwise(F.lit("TEXT"))
        return F.lit("double precision" if dtype.startswith("decimal") else TYPE_NAMES.get(dtype, "TEXT"))

    pairs = [F.struct(F.lit(c).alias("column"), kind(c, t).alias("type")) for c, t in df.dtypes]
    return widths.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.type")


def jdbc_column_types(types: DataFrame) -> str:
    """The `createTableColumnTypes` text of a JDBC writer; one entry per column."""
    return ", ".join(f"`{r['column']}` {r['type']}" for r in types.collect())


def table_profile(df: DataFrame) -> DataFrame:
    """Row and column counts as one row."""
    return df.agg(F.count("*").alias("num_rows")).withColumn("num_columns", F.lit(len(df.columns)))
