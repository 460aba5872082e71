"""Connected components by alternating large-star and small-star rounds.

After Kiveris et al., "Connected Components in MapReduce and Beyond", 2014:
the number of rounds grows with log^2 of the node count, not with the length
of the longest chain. Node ids are non-negative longs; an edge is (hi, lo)
with hi > lo.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cardspark.operators.lookup import HOT_ROWS, match
from cardspark.session import written, written_with_metrics


def _large_star(edges: DataFrame, hot_rows: int, total: int) -> DataFrame:
    """(hi, lo, u): every larger neighbour hi of u linked to the smallest node u can see."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(
        "u", F.least("u", "m").alias("m"), "n"
    )
    up = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    return match(up, smallest, "u", "n", hot_rows, 2 * total).select(
        F.col("v").alias("hi"), F.col("m").alias("lo"), "u"
    )


def _small_star(edges: DataFrame, hot_rows: int, total: int) -> DataFrame:
    """(hi, lo, m): an edge with the smallest of the smaller neighbours of hi."""
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
    return match(edges.select("hi", "lo"), smallest, "hi", "n", hot_rows, total)


def components(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, component) for every node with a smaller node in its component.

    A node that is missing from the result is the smallest of its component.
    `edges` has columns hi > lo; the component id is the smallest node.

    A round that links nothing anew has found every lower end to be the
    smallest node it sees and every node to have one smaller neighbour: the
    components are stars. The counters that tell so are observed while the
    round is written, without another job.
    """
    size = Observation()
    edges, found = written_with_metrics(edges.distinct().observe(size, F.count("*").alias("edges")), "edges", size)
    while True:  # the number of rounds is bounded by log^2 of the nodes
        if found["edges"] == 0:
            break
        large, small = Observation(), Observation()
        wide = _large_star(edges, hot_rows, found["edges"]).observe(
            large, F.count_if(F.col("lo") < F.col("u")).alias("relinked")
        )
        if 2 * found["edges"] > hot_rows:
            # both steps split off hot nodes and read their input several times: keep the plan of each small
            wide = written(wide, "large-star")
        near = _small_star(wide, hot_rows, found["edges"]).observe(
            small, F.count_if(F.col("lo") > F.col("m")).alias("relinked")
        )
        pairs = F.array(
            F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        after = Observation()
        linked = near.select(F.explode(pairs).alias("e")).select("e.hi", "e.lo").filter(F.col("hi") > F.col("lo"))
        edges, found = written_with_metrics(
            linked.distinct().observe(after, F.count("*").alias("edges")), "edges", after
        )
        if large.get["relinked"] + small.get["relinked"] == 0:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
