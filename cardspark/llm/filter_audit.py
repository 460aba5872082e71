"""Interaction audit of document filters by truth-table survival words.

Each document gets a failure mask f (bit i: it fails filter i) and from it a
32-bit survival word: bit S is set when the document survives the subset S of
the filters, i.e. f & S == 0. Summing the words position by position gives,
for every subset at once, how many documents survive it. The sums are taken
with a carry-save adder tree (three words in, a sum word and a carry word one
level up), so a task touches each word once and keeps one word per level of
the count. Every order of the filters, every step, and each filter's Shapley
total follow from the 32 survivor counts of a part by inclusion.

Counts are over all documents; the only shuffles are the pre-aggregated
groupings by text, by (text, id) and by (part, labels, subset).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: filter letters, bit i of a failure mask for letter i
LETTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
SYMBOLS = "[#$%&*|]"


def survival_word(mask: int, n_filters: int = len(LETTERS)) -> int:
    """Bit S set when a document with failure mask `mask` survives subset S."""
    return sum(1 << s for s in range(1 << n_filters) if mask & s == 0)


def failures(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """(doc_id, part, h, f4): the text filters A-D of every document, built-in functions only.

    Null text counts as empty; a null part as the empty string. A: under 50
    words. B: 100 x distinct words < 65 x words. C: 100 x [A-Z] characters >
    5 x code points. D: any of # $ % & * |.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    n = F.size(words)
    upper = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]", ""))
    fails = [n < MIN_WORDS, F.lit(100) * F.size(F.array_distinct(words)) < F.lit(DISTINCT_PERCENT) * n,
             F.lit(100) * upper > F.lit(UPPER_PERCENT) * F.length(t), t.rlike(SYMBOLS)]
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails)), F.lit(0))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")) if part_col in docs.columns else F.lit("")
    return docs.select(F.col(id_col).alias("doc_id"), part.alias("part"), F.sha2(t, 256).alias("h"), mask.alias("f4"))


def document_words(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   part_col: str = "source") -> DataFrame:
    """(part, good, toxic, word, n): survival words of all documents, repeated rows counted in n.

    E (an equal text under a smaller doc_id, table-wide) holds for every row
    whose id is not the smallest id of its text; a null id counts as larger
    than all ids, so it fails E when its text has an id, and passes when all
    ids of its text are null. good / toxic: some `labels` row of the doc_id
    has quality = 1 / toxic = 1 (no row, or a null id: 0).
    """
    base = failures(docs, text_col, id_col, part_col)
    # repeated rows are one row here, so no (id, text) is a hot key below
    rows = base.groupBy("doc_id", "h", "part", "f4").agg(F.count(F.lit(1)).alias("n"))
    smallest = base.groupBy(F.col("h").alias("__h")).agg(F.min("doc_id").alias("__min"))
    flags = labels.groupBy(F.col("doc_id").alias("__id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    first = (rows.join(smallest, (F.col("h") == F.col("__h")) & F.col("doc_id").eqNullSafe(F.col("__min")), "left")
             .select("*", F.col("__h").isNull().alias("e")).drop("__h", "__min"))
    labelled = first.join(flags, F.col("doc_id") == F.col("__id"), "left")
    mask = F.col("f4") + F.when(F.col("e"), F.lit(1 << 4)).otherwise(F.lit(0))
    table = F.array(*[F.lit(survival_word(m)) for m in range(1 << len(LETTERS))])
    return labelled.select(
        "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
        F.element_at(table, mask + 1).cast("long").alias("word"), "n")


def carry_save_counts(words: np.ndarray, weights: np.ndarray, bits: int = 32) -> np.ndarray:
    """Positional popcounts of `words` (each counted `weights` times) by a carry-save adder tree.

    A word of weight w enters level j for every set bit j of w. Each level is
    reduced three words at a time: sum = a ^ b ^ c stays, carry = majority(a,
    b, c) moves up one level. When no level holds more than two words, count
    j of position s is the number of words of level j with bit s set, and the
    result is the sum over levels of 2^j times it.
    """
    words = np.asarray(words, dtype=np.uint32)
    weights = np.asarray(weights, dtype=np.int64)
    levels: dict[int, list[np.ndarray]] = {}
    for j in range(int(weights.max()).bit_length() if len(weights) else 0):
        chosen = words[(weights >> j) & 1 == 1]
        if len(chosen):
            levels.setdefault(j, []).append(chosen)
    j = 0
    while j <= max(levels, default=-1):
        level = np.concatenate(levels.pop(j, [np.zeros(0, dtype=np.uint32)]))
        while len(level) > 2:
            m = len(level) // 3
            a, b, c, rest = level[:m], level[m:2 * m], level[2 * m:3 * m], level[3 * m:]
            levels.setdefault(j + 1, []).append((a & b) | (a & c) | (b & c))
            level = np.concatenate([a ^ b ^ c, rest])
        levels[j] = [level]
        j += 1
    total = np.zeros(bits, dtype=np.int64)
    for j, (level,) in levels.items():
        if len(level):
            positions = np.unpackbits(level.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
            total += positions.sum(axis=0).astype(np.int64) << j
    return total


def survivors(words: DataFrame) -> DataFrame:
    """(part, good, toxic, subset, n): how many documents survive each subset, per part and label class."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for frame in frames:  # one Arrow batch at a time; a task keeps 32 counts per (part, label class)
            for key, group in frame.groupby(["part", "good", "toxic"], sort=False):
                counts = carry_save_counts(group["word"].to_numpy(), group["n"].to_numpy())
                totals[key] = totals.get(key, 0) + counts
        if totals:
            keys = list(totals)
            yield pd.DataFrame({"part": [k[0] for k in keys], "good": [int(k[1]) for k in keys],
                                "toxic": [int(k[2]) for k in keys], "counts": [totals[k].tolist() for k in keys]})

    # one row per (part, label class) and task; the sums across tasks are an ordinary partial aggregation
    return (words.mapInPandas(partial, "part string, good int, toxic int, counts array<long>")
            .select("part", "good", "toxic", F.posexplode("counts").alias("subset", "n"))
            .groupBy("part", "good", "toxic", "subset").agg(F.sum("n").alias("n")))


def orders(n_filters: int = len(LETTERS)) -> list[tuple]:
    """(filter_order, step, letter, before, after) for every order of the filters and step; masks of applied filters."""
    out = []
    for perm in itertools.permutations(range(n_filters)):
        before = 0
        for step, i in enumerate(perm, start=1):
            out.append(("".join(LETTERS[k] for k in perm), step, LETTERS[i], before, before | (1 << i)))
            before |= 1 << i
    return out


def audit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          part_col: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    kept: survivors after the step; removed: survivors before minus after;
    redundant: documents failing the step's filter that an earlier step
    removed; unique_fails: documents failing that filter and no other;
    good_lost / toxic_lost: removed documents labelled quality 1 / toxic 1;
    shapley: the filter's removed summed over all 120 orders. Every part with
    a document gets all 600 rows, zeros included. Empty table: no rows.
    """
    full = (1 << len(LETTERS)) - 1
    per = survivors(document_words(docs, labels, text_col, id_col, part_col))
    counts = per.groupBy("part").pivot("subset", list(range(full + 1))).agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("good") == 1, F.col("n"))).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n"))).alias("toxic"))

    def at(kind: str, subset: Column) -> Column:
        cells = F.array(*[F.coalesce(F.col(f"{s}_{kind}"), F.lit(0)).cast("long") for s in range(full + 1)])
        return F.element_at(cells, subset + 1)

    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(x).alias("letter"),
                               F.lit(b).alias("before"), F.lit(a).alias("after")) for o, s, x, b, a in orders()])
    rows = counts.select("*", F.explode(steps).alias("o")).select("*", "o.*")
    bit = F.col("after") - F.col("before")
    removed = at("all", F.col("before")) - at("all", F.col("after"))
    result = rows.select(
        "part", "filter_order", "step", "letter",
        at("all", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (at("all", F.lit(0)) - at("all", bit) - removed).alias("redundant"),
        (at("all", F.lit(full) - bit) - at("all", F.lit(full))).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", F.col("after"))).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", F.col("after"))).alias("toxic_lost"))
    # 120 rows of one part and filter: a bounded window
    return result.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
