"""Look-backs read their month folders only; no caps, no arbitrary rows."""

import datetime as dt
import re
from dataclasses import replace

from cardspark.functions.dates import Period, from_month, months_back
from cardspark.operators import age, clusters, kpis, merchants, usage
from conftest import values
from pyspark.sql import functions as F

SPAN = Period.months("2024_1", "2024_3")
SCHEMA = ("CardHolderID string, TransactionTime timestamp_ntz, TransactionTP string, Amount double, Fee double, Surcharge double, "
          "IsInternational int, IsPOSInternational int, DebitCredit string, IsReversal int, IsFee int, MerchantName string, year int, month int")


def family(spark, path, times):
    rows = [("1", t, "POS", 2.0, 1.0, 0.0, 0, 0, "Debit", 0, 0, "m", t.year, t.month) for t in times]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("year", "month").mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)


def test_look_backs_prune_month_folders(spark, tmp_path):
    assert months_back(dt.datetime(2024, 3, 31), 12) == dt.datetime(2023, 3, 1)
    times = [dt.datetime(2020, 5, 1), dt.datetime(2023, 3, 31), dt.datetime(2023, 12, 31), dt.datetime(2024, 2, 1), dt.datetime(2024, 7, 1)]
    df = family(spark, str(tmp_path / "f"), times)
    assert values(from_month(df, dt.datetime(2023, 12, 15)), "TransactionTime") == [(t,) for t in times[2:]]
    types = spark.createDataFrame([("POS", "POS", 1), ("POS", "ATM", 0)], "TransactionTP string, group_transactions string, IsVolontaire int")
    families = {f: df for f in ("pos", "atm", "other", "load", "fees")}
    members = spark.createDataFrame([("1", 1)], "CardHolderID string, ClusterID int")
    frames = {
        "spend": kpis.spend_last_months(df, df, df, SPAN), "loads": kpis.loads_last_months(df, SPAN),
        "types": kpis.type_counts(families, types, SPAN),
        "all": kpis.card_kpis(families, df, types, SPAN, dt.datetime(2024, 4, 1)),
        "merchants": merchants.top_merchants(df, members, 1, "2023-12-01"),
    }
    for name, frame in frames.items():
        found = partition_filters(frame)
        pruned = [f for f in found if "year" in f and "month" in f]
        assert pruned and len(pruned) >= len(found) - (name == "all"), (name, found)
    # of a type with several rows the least counts; rows after the period count as well; fees have no amount
    got = frames["types"].first()
    assert got["Nb_Transaction_ATM_12_M"] == 4 * 4 and got["Nb_Transaction_POS_12_M"] == 0
    assert values(frames["merchants"], "nb_transactions") == [(3,)]


def test_usage_has_no_cap_and_loses_nothing(spark):
    rows = [("1", f"c{i:04d}", 1.0) for i in range(1500)] + [("2", "rare", 3.0)]
    pos = spark.createDataFrame(rows, "CardHolderID string, level string, Amount double")
    cells = usage.usage_cells(pos, "level", "amount_paid")
    assert cells.count() == 1501
    assert values(cells.filter("category IN ('c0007', 'rare')"), "CardHolderID", "cell", "total", "share") == [
        ("1", 1.0, 1500.0, 1 / 1500), ("2", 3.0, 3.0, 1.0)]
    matrix = usage.usage(pos, "level", "amount_paid", values=["c0001"], remainder=True)
    assert values(matrix, "CardHolderID", "c0001", usage.REMAINDER) == [("1", 1.0, 1499.0), ("2", 0.0, 3.0)]
    assert values(usage.usage_share(matrix), "CardHolderID", "c0001_Prop") == [("1", 1 / 1500), ("2", 0.0)]


def test_of_repeated_cards_the_earliest_year_counts(spark):
    spent = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 5.0)], "CardHolderID string, TransactionTime timestamp_ntz, Amount double")
    other = spent.withColumns({"DebitCredit": F.lit("Debit"), "IsReversal": F.lit(0), "IsFee": F.lit(0)})
    cards = spark.createDataFrame(
        [("1", "KYC", dt.datetime(y, 2, 2)) for y in (1990, 1960, 1980)], "CardHolderID string, KYC_Status string, BirthDate timestamp_ntz")
    assert values(age.weighted_age(spent, spent.limit(0), other.limit(0), cards), "age_pondere") == [(64.0,)]


def test_a_spoiled_fit_is_noticed(spark):
    rows = [(str(i), float(i % 2 * 10 + i % 3 / 10), float(i % 5) / 10) for i in range(60)]
    df = spark.createDataFrame(rows, "CardHolderID string, x double, y double")
    model, members = clusters.fit_clusters(df, ["x", "y"], 2, seed=1)
    flags = ["size_agrees", "all_nearest", "centre_is_mean", "one_label"]
    assert values(clusters.fit_properties(df, model, members), "n_members", *flags) == [(30, True, True, True, True)] * 2
    moved = members.withColumn("ClusterID", F.when(F.col("CardHolderID") == "0", 1 - F.col("ClusterID")).otherwise(F.col("ClusterID")))
    spoiled = values(clusters.fit_properties(df, model, moved), *flags)
    assert any(not row[0] for row in spoiled) and any(not row[1] for row in spoiled) and any(not row[2] for row in spoiled)
    bare = replace(model, labels=model.labels.filter("ClusterID = 0"))
    assert clusters.score_clusters(bare, df).count() == 60  # a cluster without a label keeps its cards
