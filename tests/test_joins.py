import random

import pytest
from pyspark.sql import functions as F

from cardspark.operators.components import components
from cardspark.operators.lookup import lookup, match
from cardspark.operators.numbering import number_rows
from conftest import values


def facts(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 7}" if i % 3 == 1 else None) for i in range(90)]
    return spark.createDataFrame(rows, "id long, k string")


@pytest.mark.parametrize("hot_rows", [0, 20, 1_000_000])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_equals_a_left_join(spark, hot_rows, null_safe):
    df = facts(spark)
    table = df.groupBy("k").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    got = values(lookup(df, table, ["k"], "n", hot_rows, null_safe), "id", "k", "first")
    want = []
    firsts = {}
    for i, k in [(r["id"], r["k"]) for r in df.collect()]:
        firsts.setdefault(k, i)
    for i, k in [(r["id"], r["k"]) for r in df.collect()]:
        want.append((i, k, firsts[k] if k is not None or null_safe else None))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("total", [None, 90])
@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_match_equals_an_inner_join(spark, hot_rows, total):
    df = facts(spark).filter(F.col("k").isNotNull())
    table = df.groupBy("k").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter(F.col("n") > 3)
    got = values(match(df, table, "k", "n", hot_rows, total), "id", "first")
    assert got == values(df.join(table, "k"), "id", "first")


def test_numbers_follow_the_order(spark):
    words = [f"w{random.Random(i).random()}" for i in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(7)
    got = sorted(values(number_rows(df, ["w"], "n", after=10), "n", "w"))
    assert [w for _, w in got] == sorted(words) and [n for n, _ in got] == list(range(11, 311))
    assert number_rows(df.limit(0), ["w"], "n").count() == 0


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components_equal_union_find(spark, kind, hot_rows):
    r = random.Random(5)
    edges = {
        "chain": [(i + 1, i) for i in range(40)],
        "star": [(i, 0) for i in range(1, 60)] + [(i + 100, 100) for i in range(1, 9)],
        "random": [tuple(sorted(r.sample(range(120), 2), reverse=True)) for _ in range(90)],
    }[kind]
    r.shuffle(edges)
    got = dict(values(components(spark.createDataFrame(edges, "hi long, lo long"), hot_rows), "node", "component"))
    assert got == {n: c for n, c in brute(edges).items() if n != c}


def test_no_edges_no_components(spark):
    assert components(spark.createDataFrame([], "hi long, lo long")).count() == 0


def test_hot_rows_are_spread_over_the_shuffle(spark):
    """The bucket is part of the partitioning, not a leftover filter."""
    df = spark.createDataFrame([(i, "hot") for i in range(400)] + [(1000 + i, f"k{i}") for i in range(20)], "id long, k string")
    table = df.groupBy("k").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = [r["count"] for r in lookup(df, table, ["k"], "n", hot_rows=50).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep[0])
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", keep[1])
    assert sum(sizes) == 420 and max(sizes) < 150
