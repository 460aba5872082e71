"""Spend-weighted age of the person behind a card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import Period, period, timestamp
from cardspark.functions.values import money
from cardspark.operators.families import spending_other

CARD = "CardHolderID"

# fixed values: birth dates typed in place of a real one, and the credibility limit
PLACEHOLDER_BIRTH_DATES = ["1988-08-08 00:00:00", "1989-09-09 00:00:00", "1992-02-02 00:00:00",
                           "1930-06-11 00:00:00"]
BORN_AFTER = "1940-01-01 00:00:00"


def weighted_age(
    pos: DataFrame, atm: DataFrame, other: DataFrame, cards: DataFrame, span: Period | None = None
) -> DataFrame:
    """Sum over years of (share of spending in the year) x (year - birth year).

    Equal to sum(amount x year) / sum(amount) - birth year, so one grouping by
    card is enough and the card table joins one row per card.
    """
    parts = [d if span is None else period(d, span) for d in (pos, atm, spending_other(other))]
    spent = None
    for part in parts:
        part = part.filter(F.col("Amount") > 0).select(CARD, "TransactionTime", money("Amount").alias("amount"))
        spent = part if spent is None else spent.unionByName(part)
    totals = spent.groupBy(CARD).agg(
        F.sum("amount").alias("total"),
        F.sum(F.col("amount") * F.year("TransactionTime")).alias("by_year"),
    )
    birth = F.col("BirthDate")
    credible = cards.filter(
        F.col("KYC_Status").isin("KYC", "KYC LITE")
        & birth.isNotNull()
        & ~birth.isin(*[timestamp(d) for d in PLACEHOLDER_BIRTH_DATES])
        & (birth > timestamp(BORN_AFTER))
    ).groupBy(CARD).agg(F.min(F.year("BirthDate")).alias("birth_year"))  # of repeated cards, the earliest year
    age = F.try_divide(
        (F.col("by_year") - F.col("birth_year") * F.col("total")).cast("double"), F.col("total").cast("double")
    )
    return totals.join(credible, CARD).select(CARD, age.alias("age_pondere"))
