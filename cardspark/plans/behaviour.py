"""Card behaviour tables from the warehouse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from cardspark.functions.dates import Period, period
from cardspark.operators.kpis import card_kpis
from cardspark.operators.monthly import normalize_rollup, rollup_months
from cardspark.operators.usage import usage, usage_summary
from cardspark.plans.card_status import CARDS
from cardspark.plans.transactions import RAW
from cardspark.plans.warehouse import Warehouse


def behaviour(house: Warehouse, start_ym: str, end_ym: str, as_of: dt.datetime) -> DataFrame:
    """Indicators of all cards for the months `start_ym` … `end_ym` (`YYYY_M`)."""
    families = {n: house.table(t) for n, t in
                {"pos": "pos", "atm": "atm", "other": "other", "load": "loads", "fees": "fees"}.items()}
    span = Period.months(start_ym, end_ym)
    return card_kpis(families, house.table(CARDS), house.table("transaction_types"), span, as_of)


def habits(house: Warehouse, start_ym: str, end_ym: str) -> DataFrame:
    """Normalised month habits of the months given, one scan of their folders."""
    return normalize_rollup(rollup_months(period(house.table(RAW), Period.months(start_ym, end_ym))))


def category_use(house: Warehouse, level: str, start_ym: str, end_ym: str, values: list[str] | None = None) -> DataFrame:
    """Use of UNIVERS or SOUS_UNIVERS as shares, with its summary."""
    matrix = usage(house.table("pos"), level, "amount_paid", Period.months(start_ym, end_ym), values, remainder=values is not None)
    return usage_summary(matrix, level)
