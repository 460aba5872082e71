"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
HOT_ROWS = 1_000_000
SPREAD = 1024


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a rule table, given only after counting it.

    Beyond the limit the frame is returned as it is and the equi-join falls
    back to a shuffle that adaptive execution plans from real sizes.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def _same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str, null_safe: bool) -> Column:
    def one(k: str) -> Column:
        a, b = left[k], right[prefix + k]
        return a.eqNullSafe(b) if null_safe else a == b
    return reduce(lambda x, y: x & y, [one(k) for k in keys])


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    rows: str,
    hot_rows: int = HOT_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Left join of `facts` with a table that has one row per key.

    `table[rows]` says how many fact rows carry the key. Keys above `hot_rows`
    number at most (fact rows / hot_rows), so that part is broadcast and its
    rows never cross the network for the match. The other keys are joined by a
    shuffle, in which rows already matched, and rows that cannot match because
    a key is null, are spread over many buckets.
    """
    values = [c for c in table.columns if c not in (*on, rows)]
    keyed = [F.col(k).alias("__k_" + k) for k in on]
    packed = F.struct(*values)
    hot = table.filter(F.col(rows) > hot_rows).select(*keyed, packed.alias("__hot"))
    # always 0, but not as a constant: the optimizer would turn the test of a constant into a filter
    # and partition by the key alone, which brings the hot rows back into one task
    zero = F.pmod(F.col(rows), F.lit(1)).cast("int")
    cold = table.filter(F.col(rows) <= hot_rows).select(*keyed, zero.alias("__bucket"), packed.alias("__cold"))
    drop = ["__k_" + k for k in on]

    first = facts.join(F.broadcast(hot), _same(facts, hot, on, "__k_", null_safe), "left").drop(*drop)
    settled = F.col("__hot").isNotNull()
    if not null_safe:
        settled = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in on], settled)
    everything = [F.col(f"`{c}`") for c in facts.columns]
    first = first.withColumn(
        "__spread",
        F.when(settled, F.pmod(F.xxhash64(*everything), F.lit(SPREAD)) + 1).otherwise(0).cast("int"),
    )
    match = _same(first, cold, on, "__k_", null_safe) & (F.col("__spread") == F.col("__bucket"))
    both = first.join(cold, match, "left")
    return both.select(
        *[first[f"`{c}`"] for c in facts.columns],
        *[F.coalesce(F.col(f"__hot.`{v}`"), F.col(f"__cold.`{v}`")).alias(v) for v in values],
    )


def match(rows: DataFrame, table: DataFrame, key: str, count: str, hot_rows: int = HOT_ROWS,
          total: int | None = None) -> DataFrame:
    """Inner join with a table that has one row per key, for rows that are cheap to read twice.

    Keys above `hot_rows` take a broadcast path and never enter the shuffle, so
    the other path can reuse the partitioning of the aggregation that built the
    table. When `total`, the number of rows, does not exceed `hot_rows`, no key
    can be hot and only the second path is planned.
    """
    if total is not None and total <= hot_rows:
        return rows.join(table.drop(count), key)
    hot = F.broadcast(table.filter(F.col(count) > hot_rows).drop(count))
    cold = table.filter(F.col(count) <= hot_rows).drop(count)
    others = rows.join(hot.select(key), key, "left_anti").join(cold, key)
    return rows.join(hot, key).unionByName(others)
