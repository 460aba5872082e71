"""Change capture between two card snapshots, and the dates derived from it.

A snapshot has one row per card, so every join here is on a unique key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import timestamp
from cardspark.functions.text import address_key

CARD = "CardHolderID"
WATCHED = ["Email", "FirstName", "LastName", "BirthDate", "IBAN", "NoMobile", "Programme"]


def _day_before(file_day: dt.date | str) -> Column:
    day = dt.date.fromisoformat(str(file_day)[:10]) - dt.timedelta(days=1)
    return timestamp(day)


def status_changes(old: DataFrame, new: DataFrame, file_day: dt.date | str) -> DataFrame:
    """Old (CardStatus, KYC_Status) of the cards where either differs."""
    names = ["CardStatus", "KYC_Status"]
    now = new.select(CARD, F.struct(*names).alias("__now"))
    before = F.struct(*names)
    return (
        old.select(CARD, *names).join(now, CARD)
        .filter(~before.eqNullSafe(F.col("__now")))
        .select(CARD, *names, _day_before(file_day).alias("dt_change"))
    )


def _comparable(name: str) -> Column:
    text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.replace(text, F.lit(" "), F.lit("")) if name in ("FirstName", "LastName") else text


def customer_changes(old: DataFrame, new: DataFrame, file_day: dt.date | str) -> DataFrame:
    """Old row, a flag per changed attribute and their number, for changed cards."""
    before = old.select(CARD, *WATCHED, F.struct(*[_comparable(c).alias(c) for c in WATCHED]).alias("__old"))
    after = new.select(CARD, F.struct(*[_comparable(c).alias(c) for c in WATCHED]).alias("__new"))
    flags = [(F.col(f"__old.{c}") != F.col(f"__new.{c}")).cast("int").alias(f"Is_ch_{c}") for c in WATCHED]
    flagged = before.join(after, CARD).select(CARD, *WATCHED, *flags)
    total = sum((F.col(f"Is_ch_{c}") for c in WATCHED[1:]), F.col(f"Is_ch_{WATCHED[0]}"))
    return (
        flagged.withColumn("total_ch", total).filter(F.col("total_ch") > 0)
        .withColumn("dt_change", _day_before(file_day))
    )


def address_changes(old: DataFrame, new: DataFrame, file_day: dt.date | str) -> DataFrame:
    """Old address of cards that moved, and the address of cards not seen before."""
    names = [CARD, "Address1", "Address2", "PostCode", "City"]
    before = old.select(*names, address_key().alias("__old"), F.lit(True).alias("__known"))
    after = new.select(*names, address_key().alias("__new")).alias("n")
    both = after.join(before.alias("o"), CARD, "left")
    known = F.coalesce(F.col("__known"), F.lit(False))
    kept = both.filter(~known | (F.col("__old") != F.col("__new")))
    return kept.select(
        CARD,
        *[F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in names[1:]],
        _day_before(file_day).alias("dt_change"),
    )


def last_change(cards: DataFrame, changes: DataFrame) -> DataFrame:
    """LastChangeDate from the change log."""
    latest = changes.groupBy(CARD).agg(F.max("dt_change").alias("__latest"))
    return _filled(cards, latest, "LastChangeDate", F.coalesce("__latest", "LastChangeDate"))


def fill_activation(cards: DataFrame, activations: DataFrame) -> DataFrame:
    """ActivationDate from the earliest activation report, where it is missing."""
    first = activations.groupBy(CARD).agg(F.min("ActivationTime").alias("__first"))
    return _filled(cards, first, "ActivationDate", F.coalesce("ActivationDate", "__first"))


def _filled(cards: DataFrame, dates: DataFrame, name: str, value: Column) -> DataFrame:
    return cards.join(dates, CARD, "left").withColumn(name, value).select(*cards.columns)
