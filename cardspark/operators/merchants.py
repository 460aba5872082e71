"""Merchants of a cluster of cards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import from_month, timestamp

CARD = "CardHolderID"


def top_merchants(
    pos: DataFrame, clusters: DataFrame, cluster_id: int | str, since: dt.datetime | str, k: int = 10
) -> DataFrame:
    """The k merchants a cluster paid most often after `since`.

    Payments are counted per card and merchant before the join, so a card with
    very many payments joins as a few rows.
    """
    first = since if isinstance(since, dt.datetime) else dt.datetime.fromisoformat(str(since))
    paid = from_month(pos, first).filter(F.col("TransactionTime") > timestamp(since)).groupBy(CARD, "MerchantName").agg(
        F.count("*").alias("n")
    )
    members = clusters.filter(F.col("ClusterID") == cluster_id).select(CARD)
    return (
        paid.join(members, CARD)
        .groupBy("MerchantName").agg(F.sum("n").alias("nb_transactions"))
        .orderBy(F.desc("nb_transactions"), "MerchantName")
        .limit(k)
    )
