"""Habits of a card within the month, rolled up over months."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import BUCKETS, calendar_buckets
from cardspark.functions.values import money, ratio
from cardspark.operators.families import money_class

CARD = "CardHolderID"
_SHARES = ["part_debit_credit", "part_credit_begin", "part_debit_end"]
_TOTALS = {"mois_moment": "sum_frequency_mois_moment", "jour_moment": "sum_frequency_debit_jour",
           "is_week_end": "sum_frequency_is_week_end"}


def _count_name(bucket: str, value: str) -> str:
    return f"frequence_debit_{bucket}_{value}"


COUNT_COLUMNS = [_count_name(b, v) for b, values in BUCKETS.items() for v in values]


def latest_rows(df: DataFrame, key: str | list[str], ts: str) -> DataFrame:
    """All rows at the latest time of their key, ties included.

    A semi join on (key, time) spreads a key that holds many rows; a window
    over the key would put them into one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(df.groupBy(*keys).agg(F.max(ts).alias(ts)), [*keys, ts], "left_semi")


def _prepared(df: DataFrame) -> DataFrame:
    real = df.filter(F.col(CARD) != "0")
    return money_class(calendar_buckets(real)).withColumn("amount", money("Amount"))


def _flow_aggregates() -> list[Column]:
    credit, debit = F.col("is_credit"), F.col("is_real_debit")
    return [
        F.sum(F.when(credit, F.col("amount"))).alias("__load"),
        F.sum(F.when(credit & (F.col("mois_moment") == "premiere_semaine"), F.col("amount"))).alias("__load_first"),
        F.sum(F.when(debit, F.col("amount"))).alias("__debit"),
        F.sum(F.when(debit & (F.col("mois_moment") == "quatrieme_semaine"), F.col("amount"))).alias("__debit_end"),
    ]


def _flow_columns() -> list[Column]:
    zero = F.lit(0).cast("decimal(18,2)")
    load, debit = F.coalesce("__load", zero), F.coalesce("__debit", zero)
    return [
        ratio(debit, load + debit).alias("part_debit_credit"),
        ratio(F.coalesce("__load_first", zero), load).alias("part_credit_begin"),
        ratio(F.coalesce("__debit_end", zero), debit).alias("part_debit_end"),
    ]


def _bucket_aggregates() -> list[Column]:
    return [
        F.count(F.when(F.col("is_real_debit") & (F.col(b) == v), 1)).alias(_count_name(b, v))
        for b, values in BUCKETS.items() for v in values
    ]


def month_features(df: DataFrame, by: tuple[str, ...] = (CARD,)) -> DataFrame:
    """Debit share, early-load share and late-debit share per card."""
    return _prepared(df).groupBy(*by).agg(*_flow_aggregates()).select(*by, *_flow_columns())


def debit_bucket_counts(df: DataFrame, by: tuple[str, ...] = (CARD,)) -> DataFrame:
    """Debits per day part, month week and week part; every bucket has a column."""
    return _prepared(df).groupBy(*by).agg(*_bucket_aggregates())


def end_balance(df: DataFrame, by: tuple[str, ...] = (CARD,)) -> DataFrame:
    """Mean balance over the rows at the latest time of each card.

    Grouped by time first, so that the rows of a busy card are combined in many
    tasks before the latest time is picked.
    """
    moments = (
        df.filter((F.col(CARD) != "0") & F.col("TransactionTime").isNotNull())
        .groupBy(*by, "TransactionTime")
        .agg(F.sum(money("RemainingBalance")).alias("s"), F.count("RemainingBalance").alias("n"))
    )
    last = moments.groupBy(*by).agg(F.max(F.struct("TransactionTime", "s", "n")).alias("last"))
    return last.select(
        *by,
        F.try_divide(F.col("last.s").cast("double"), F.col("last.n").cast("double"))
        .alias("remaining_balance_end_month"),
    )


def _moments(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """One row per group and time: credits, debits, number of debits, and the balances."""
    rows = money_class(df.filter(F.col(CARD) != "0")).withColumn("amount", money("Amount"))
    debit = F.col("is_real_debit")
    return calendar_buckets(rows.groupBy(*by, "TransactionTime").agg(
        F.sum(F.when(F.col("is_credit"), F.col("amount"))).alias("credit"),
        F.sum(F.when(debit, F.col("amount"))).alias("debit"), F.count(F.when(debit, 1)).alias("debits"),
        F.sum(money("RemainingBalance")).alias("s"), F.count("RemainingBalance").alias("n"),
    ))


def monthly_kpis(df: DataFrame, by: tuple[str, ...] = (CARD,)) -> DataFrame:
    """All month indicators of the cards of one month (or of each `by` group).

    The rows are read once: a first grouping by time serves the flows, the
    counts, whose buckets follow from the time, and the balance at the latest time.
    """
    def part(amount: str, bucket: str, value: str) -> Column:
        return F.sum(F.when(F.col(bucket) == value, F.col(amount)))

    folded = _moments(df, by).groupBy(*by).agg(
        F.sum("credit").alias("__load"), part("credit", "mois_moment", "premiere_semaine").alias("__load_first"),
        F.sum("debit").alias("__debit"), part("debit", "mois_moment", "quatrieme_semaine").alias("__debit_end"),
        *[F.coalesce(part("debits", b, v), F.lit(0)).alias(_count_name(b, v)) for b, values in BUCKETS.items() for v in values],
        F.max(F.when(F.col("TransactionTime").isNotNull(), F.struct("TransactionTime", "s", "n"))).alias("last"),
    )
    balance = F.try_divide(F.col("last.s").cast("double"), F.col("last.n").cast("double"))
    return folded.filter("last IS NOT NULL").select(
        *by, *_flow_columns(), *COUNT_COLUMNS, balance.alias("remaining_balance_end_month"))


def rollup_months(df: DataFrame) -> DataFrame:
    """Sums of the month indicators per card and the number of months with activity.

    One grouping by (card, month) and one by card; months are never looped over.
    """
    df = df.filter(F.col("TransactionTime").isNotNull()).withColumn(
        "__month", F.year("TransactionTime") * 12 + F.month("TransactionTime")
    )
    months = monthly_kpis(df, (CARD, "__month"))
    summed = [*_SHARES, "remaining_balance_end_month", *COUNT_COLUMNS]
    return months.groupBy(CARD).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed], F.count("*").alias("num_events")
    )


def normalize_rollup(df: DataFrame) -> DataFrame:
    """Bucket counts as shares of their family total, other sums as monthly means."""
    columns: list[Column] = [F.col(CARD)]
    for bucket, total_name in _TOTALS.items():
        names = [_count_name(bucket, v) for v in BUCKETS[bucket]]
        total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
        columns += [ratio(F.col(n), total).alias(n) for n in names]
        columns.append(total.alias(total_name))
    for name in ["part_credit_begin", "part_debit_credit", "part_debit_end", "remaining_balance_end_month"]:
        columns.append(ratio(F.col(name), F.col("num_events")).alias(f"avg_{name}"))
    return df.select(*columns)


def align(left: DataFrame, right: DataFrame, key: str = CARD) -> DataFrame:
    """Outer alignment of two indicator tables: common columns are added, gaps are 0."""
    names = sorted((set(left.columns) | set(right.columns)) - {key})
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(key).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
