"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order (by MD5 of the id),
repeated as often as its target may need. A document's virtual finish time is
the number of words its source has emitted up to and including it, divided by
the source's target, so that all queues advance at the rate of their targets.
The documents are then taken by ascending finish time until the total budget
is spent.

Running totals are found without a task that sees a whole source: documents
fall into ranges of the shuffled order, ranges are summed, and within a range
a window adds up the rest. The place where the budget ends is found by
histograms of the finish times, each of which refines the range that holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardspark.operators.numbering import number_rows
from cardspark.session import written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
_RANGE_ROWS = 50_000
_PARTS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, rank, target) from rows (source, size).

    `share` times all words are divided by weight; weights repeat in the order
    of the source names by code point, null last. A target above `most` times
    its source's size stops there, and the excess goes to the others by weight
    until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("none", F.col("source").isNull())
    ranked = number_rows(per, ["none", "source"], "rank").drop("none")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", weight), "sources")
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * most
    rate, rates = 0.0, -1.0
    while rate != rates:  # every round stops more targets, so it ends
        rates = rate
        stopped = F.col("weight") * F.lit(rates) > cap
        held, left = ranked.agg(F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight")))).first()
        rate = (budget - (held or 0)) / left if left else rates
    target = F.when(F.col("weight") * F.lit(rate) > cap, cap.cast("double")).otherwise(F.col("weight") * F.lit(rate))
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def _queued(docs: DataFrame, plan: DataFrame, digits: int, most: int) -> DataFrame:
    """Rows of `docs` (source, size, key, …) with the finish time of each of their repeats."""
    # a key without nulls, so that the join and the window are dealt alike and share one shuffle
    named = F.concat(F.when(F.col("source").isNull(), "").otherwise("s"), F.coalesce("source", F.lit("")))
    ranged = docs.withColumns({"queue": named, "range": F.substring("key", 1, digits)}).drop("source")
    sums = ranged.groupBy("queue", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("queue").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("queue", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")).join(
        plan.withColumn("queue", named).drop("source"), "queue")
    joined = ranged.join(offsets, ["queue", "range"])
    upto = Window.partitionBy("queue", "range").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    emitted = F.col("offset") + F.sum("size").over(upto)
    finish = [
        F.when(F.col("target") > 0, (emitted + F.col("source_size") * c) / F.col("target")).otherwise(F.lit(0.0))
        for c in range(most)
    ]
    return joined.withColumn("finish", F.array(*finish)).drop("queue", "range", "offset")


def _cut(queue: DataFrame, budget: float) -> tuple | None:
    """(finish, rank, key, id) of the last repeat that the budget holds, or None if it holds all or none are."""
    items = queue.select(F.explode("finish").alias("finish"), "rank", "key", "id", "size").filter("size > 0")
    low, high, n, total = items.agg(F.min("finish"), F.max("finish"), F.count("*"), F.sum("size")).first()
    if not n or total <= budget:
        return None
    done = 0
    while n > _RANGE_ROWS and high > low:
        step = (high - low) / _PARTS
        part = F.least(F.floor((F.col("finish") - low) / F.lit(step)), F.lit(_PARTS - 1))
        here = items.filter(F.col("finish").between(low, high)).groupBy(part.alias("part")).agg(
            F.sum("size").alias("words"), F.min("finish").alias("low"), F.max("finish").alias("high"), F.count("*").alias("n"))
        for row in here.orderBy("part").collect():  # at most _PARTS rows
            if done + row["words"] > budget:
                break
            done += row["words"]
        if (low, high) == (row["low"], row["high"]):
            break
        low, high, n = row["low"], row["high"], row["n"]
    order = ["finish", "rank", "key", "id"]
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one range of at most _RANGE_ROWS repeats, or of repeats that finish at the same instant
    last = items.filter(F.col("finish").between(low, high)).withColumn("sum", F.sum("size").over(upto)).filter(
        F.col("sum") + done <= budget).orderBy(*[F.desc(c) for c in order]).select(*order).first()
    return tuple(last) if last else (low, -1, "", None)


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`docs` with size, source_size, target and taken (words taken, repeats counted).

    size is the number of words (null text: 0). Every document is taken whole,
    zero to `most` times. Each source comes within a document of its target, and
    the total within a document of the budget. The order depends on the ids
    alone, so reruns agree. Null is a source of its own, the last by name.
    Documents without words are never taken. Rows that repeat an id stand side by
    side in the order and may exceed the budget by their own size. Columns of
    `docs` named like a result column are replaced; no rows give no rows.
    """
    new = ["size", "source_size", "target", "taken"]
    kept = [c for c in docs.columns if c not in new]
    packed = docs.select(
        *[F.col(f"`{c}`").alias(f"__{c}") for c in kept], F.col(f"`{source_col}`").alias("source"),
        F.col(f"`{id_col}`").alias("id"), word_count(F.col(f"`{text_col}`")).alias("size"),
        F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("key"))
    light = written(packed.select("source", "id", "size", "key"), "sizes")
    plan = written(targets(light, weights, share, most), "targets")
    rows, words = light.agg(F.count("*"), F.sum("size")).first()
    digits = 1
    while 16**digits * _RANGE_ROWS < rows:
        digits += 1
    cut = _cut(written(_queued(light, plan, digits, most), "queue"), share * (words or 0))
    queued = _queued(packed, plan, digits, most)
    place = [F.col("rank"), F.col("key"), F.col("id")]
    if cut is None:
        times = F.lit(most)
    else:
        kind = queued.schema["id"].dataType
        end = F.struct(F.lit(cut[0]).alias("finish"), F.lit(cut[1]).cast("long").alias("rank"), F.lit(cut[2]).alias("key"),
                       F.lit(cut[3]).cast(kind).alias("id"))
        times = sum(
            (F.struct(F.element_at("finish", c + 1).alias("finish"), place[0].cast("long").alias("rank"),
                      place[1].alias("key"), place[2].alias("id")) <= end).cast("int")
            for c in range(most))
    return queued.select(
        *[F.col(f"`__{c}`").alias(c) for c in kept], "size", "source_size", "target",
        (F.col("size") * times).alias("taken"))
