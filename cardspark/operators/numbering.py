"""Consecutive numbers for distinct keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardspark.session import written

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def number_rows(df: DataFrame, order: list[str], name: str, after: int = 0) -> DataFrame:
    """Add `name` = after + 1, after + 2, … following `order` (nulls first).

    The rows are range-sorted in parallel and written once with their position
    inside the partition; a table with one row per partition then gives each
    partition its offset.
    """
    placed = df.sort(*[F.col(c).asc_nulls_first() for c in order]).withColumns({
        "__part": F.spark_partition_id(),
        "__pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
    })
    placed = written(placed, "numbered")
    counts = placed.groupBy("__part").count()
    # one row per partition of the sort, so this window is over a few thousand rows at most
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__pos") + F.lit(after + 1))
        .drop("__part", "__pos", "__offset")
    )
