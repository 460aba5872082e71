"""Daily card-status snapshot with change capture."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from cardspark.operators.changes import (
    address_changes, customer_changes, fill_activation, last_change, status_changes,
)
from cardspark.operators.clean import clean_card_status
from cardspark.plans.transactions import ACTIVATIONS
from cardspark.plans.warehouse import Warehouse
from cardspark.session import written
from cardspark.sinks.tables import write_table
from cardspark.sources.landing import read_card_status

CARDS = "cards"
LOGS = {"status_changes": status_changes, "customer_changes": customer_changes, "address_changes": address_changes}


def daily_card_status(
    house: Warehouse, folder: str, day: dt.date, addresses: list[str] | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """Load the file of `day`, log what changed, replace the snapshot.

    Without a file of the day, or without a row in it, nothing is written and
    an error is raised: an empty snapshot would lose all cards.

    The cleaned file is written once and read by all captures. The logs are
    appended before the snapshot is swapped; until then the old one is served.
    """
    files = read_card_status(house.spark, folder, day, day, mode)
    fresh = written(clean_card_status(files, addresses), "card-status")
    if fresh.isEmpty():
        raise ValueError(f"no card-status rows of {day} in {folder}")
    if house.exists(CARDS):
        current = house.table(CARDS)
        for name, capture in LOGS.items():
            write_table(capture(current, fresh, day), house.name(name), "append", path=house.path(name))
    out = fresh
    if house.exists("status_changes"):
        out = last_change(out, house.table("status_changes"))
    if house.exists(ACTIVATIONS):
        out = fill_activation(out, house.table(ACTIVATIONS))
    return house.replace(CARDS, out)
