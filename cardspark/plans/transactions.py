"""From landing files to raw months to families."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from cardspark.operators.categorize import categorize
from cardspark.operators.clean import clean_activations, clean_transactions
from cardspark.operators.families import FAMILIES
from cardspark.plans.warehouse import Warehouse
from cardspark.sinks.tables import append_day_to_table, with_month, write_monthly, write_table
from cardspark.sources.landing import read_landing
from cardspark.sources.rules import Rules

RAW = "raw_transactions"
ACTIVATIONS = "activations"


def ingest_transactions(
    house: Warehouse, folder: str, start: dt.date | None = None, end: dt.date | None = None,
    programs: dict[str, str] | None = None,
) -> None:
    """Transaction files whose data day is in the window, appended to their month."""
    rows = read_landing(house.spark, folder, "transactions", start, end)
    write_monthly(clean_transactions(rows, programs), house.name(RAW), house.path(RAW))


def ingest_activations(house: Warehouse, folder: str, start: dt.date | None = None, end: dt.date | None = None) -> None:
    """Activation files of a window of file days."""
    rows = read_landing(house.spark, folder, "activations", start, end)
    write_table(clean_activations(rows), house.name(ACTIVATIONS), "append", path=house.path(ACTIVATIONS))


def _family(name: str, raw: DataFrame, day: dt.date | None, rules: Rules | None) -> DataFrame:
    rows = FAMILIES[name](raw, day)
    return categorize(rows, rules) if name == "pos" and rules is not None else rows


def build_families(house: Warehouse, rules: Rules | None = None) -> None:
    """Bulk build: every family is replaced, partitioned by month."""
    raw = house.table(RAW)
    for name in FAMILIES:
        rows = with_month(_family(name, raw, None, rules)).hint("rebalance", "year", "month")
        write_table(rows, house.name(name), "overwrite", ["year", "month"], house.path(name))


def add_day(house: Warehouse, day: dt.date, rules: Rules | None = None) -> None:
    """Daily increment: each family gets the day unless it has rows of it already."""
    raw = house.table(RAW)
    for name in FAMILIES:
        append_day_to_table(_family(name, raw, day, rules), house.name(name), day, house.path(name))
