"""Use of merchant categories per card."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import Period, period
from cardspark.functions.values import money, ratio

CARD = "CardHolderID"
REMAINDER = "__remainder"


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def usage_cells(pos: DataFrame, level: str, metric: str, span: Period | None = None) -> DataFrame:
    """(card, category, cell, total, share): one row per card and category that it used.

    `cell` is the `frequency` or the `amount_paid`, `total` that of the card
    over all its categories. The number of categories is not bounded.
    """
    paid = pos if span is None else period(pos, span)
    paid = paid.filter((F.col("Amount") > 0) & (F.col(level) != "")).select(
        CARD, F.col(level).alias("category"), money("Amount").alias("amount")
    )
    if metric not in ("frequency", "amount_paid"):
        raise ValueError("metric is frequency or amount_paid")
    cell = F.count("*") if metric == "frequency" else F.sum("amount")
    cells = paid.groupBy(CARD, "category").agg(cell.alias("cell"))
    totals = cells.groupBy(CARD).agg(F.sum("cell").alias("total"))
    kind = "long" if metric == "frequency" else "double"
    return cells.join(totals, CARD).select(
        CARD, "category", F.col("cell").cast(kind).alias("cell"), F.col("total").cast(kind).alias("total"),
        ratio(F.col("cell"), F.col("total")).alias("share"),
    )


def observed_values(cells: DataFrame) -> list[str]:
    """Categories of `usage_cells`, sorted. They are to become columns of a matrix."""
    return [r[0] for r in cells.select("category").distinct().orderBy("category").collect()]


def usage(
    pos: DataFrame, level: str, metric: str, span: Period | None = None, values: list[str] | None = None,
    remainder: bool = False,
) -> DataFrame:
    """Card x category matrix of `frequency` or `amount_paid`, missing cells 0.

    Without `values` every category becomes a column, which suits tens or
    hundreds of them; for more use `usage_cells`. With `values`, cards that used
    none of them keep their row, and with `remainder` the column `__remainder`
    holds what a card spent in other categories, so that shares are of its whole.
    """
    cells = usage_cells(pos, level, metric, span)
    if values is None:
        return cells.groupBy(CARD).pivot("category", observed_values(cells)).agg(F.first("cell")).fillna(0)
    values = sorted(values)
    kind = dict(cells.dtypes)["cell"]
    own = [F.coalesce(F.max(F.when(F.col("category") == v, F.col("cell"))), F.lit(0).cast(kind)).alias(v) for v in values]
    if remainder:
        rest = F.sum(F.when(~F.col("category").isin(values), F.col("cell")))
        own.append(F.coalesce(rest, F.lit(0).cast(kind)).alias(REMAINDER))
    return cells.groupBy(CARD).agg(*own)


def usage_share(matrix: DataFrame) -> DataFrame:
    """Each cell divided by its row total, the remainder included; columns get the suffix `_Prop`."""
    every = [c for c in matrix.columns if c != CARD]
    total = reduce(lambda a, b: a + b, [_quoted(n) for n in every])
    names = [c for c in every if c != REMAINDER]
    return matrix.select(CARD, *[ratio(_quoted(n), total).alias(f"{n}_Prop") for n in names])


def usage_summary(matrix: DataFrame, level: str, use_prop: bool = True) -> DataFrame:
    """The matrix (as shares by default) with its maximum, the category that holds
    it (first in column order) and the number of categories used."""
    categories = [c for c in matrix.columns if c not in (CARD, REMAINDER)]
    table = usage_share(matrix) if use_prop else matrix
    columns = {c: _quoted(f"{c}_Prop" if use_prop else c) for c in categories}
    top = F.greatest(*columns.values()) if len(columns) > 1 else next(iter(columns.values()))
    which = F.lit(None).cast("string")
    for name, column in reversed(columns.items()):
        which = F.when(column == top, F.lit(name)).otherwise(which)
    used = reduce(lambda a, b: a + b, [(c > 0).cast("int") for c in columns.values()])
    return table.withColumns(
        {f"max_usage_{level}": top, f"{level}_most_used": which, f"num_{level}": used}
    )
