"""Bounded samples of labelled documents and statistics of their terms, shared by the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.llm import terms as t
from cardspark.session import written

Terms = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, int]]


def held_out(id_col: str, folds: int = 5, fold: int = 0) -> Column:
    """Whether the remainder of the id's CRC-32 is `fold`; a null id is held out of nothing."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(folds)) == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, text_col: str = "text",
           id_col: str = "doc_id") -> DataFrame:
    """(row, label, text) of at most `bound` labelled documents that are not held out, those first in hash order.

    An id with several labels counts with the largest. The chosen ids are few
    enough to be sent to every executor, so the documents are not shuffled.
    """
    chosen = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).alias("row")).agg(F.max(label).cast("int").alias("label"))
    chosen = written(chosen.orderBy(F.xxhash64("row"), "row").limit(bound), "labelled")
    texts = docs.select(F.col(f"`{id_col}`").alias("row"), F.col(f"`{text_col}`").alias("text"))
    return written(texts.join(F.broadcast(chosen), "row").select("row", "label", "text"), "sample")


def term_classes(rows: DataFrame, terms: Terms) -> DataFrame:
    """(term, positive, negative): in how many texts of either label (0, 1) each term occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in t.slices(batch.column("text")):
                found, of, _ = terms(batch.column("text").slice(a, b - a))
                found, of = t.distinct(found, of)
                positive = batch.column("label").to_numpy(zero_copy_only=False)[a:b][of] == 1
                names, at = np.unique(found, return_inverse=True)
                yield pa.record_batch({
                    "term": pa.array(names.view(np.int64)),
                    "positive": pa.array(np.bincount(at[positive], minlength=len(names)), pa.int64()),
                    "negative": pa.array(np.bincount(at[~positive], minlength=len(names)), pa.int64()),
                })
    parts = rows.mapInArrow(count, "term long, positive long, negative long")
    return parts.groupBy("term").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


def document_frequency(docs: DataFrame, vocabulary: np.ndarray, terms: Terms, text_col: str = "text") -> tuple[np.ndarray, int]:
    """(number of documents with each term of the sorted vocabulary, number of documents), over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, n = shared.value, np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for a, b in t.slices(batch.column("text")):
                found, of, _ = terms(batch.column("text").slice(a, b - a))
                total += np.bincount(t.counted(found, of, known)[1], minlength=len(known))
                n += b - a
        yield pa.record_batch({"at": pa.array(np.arange(-1, len(known)), pa.int64()),
                               "n": pa.array(np.concatenate([[n], total]), pa.int64())})
    parts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "at long, n long")
    found = dict(tuple(r) for r in parts.groupBy("at").agg(F.sum("n")).collect())  # one row per term
    return np.array([found.get(i, 0) for i in range(len(vocabulary))], np.int64), found.get(-1, 0)


def example_counts(rows: DataFrame, vocabulary: np.ndarray, terms: Terms) -> DataFrame:
    """(row, label, at, count): the vocabulary terms of each sampled text as arrays."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in t.slices(batch.column("text")):
                found, of, n = terms(batch.column("text").slice(a, b - a))
                doc, at, counts = t.counted(found, of, shared.value)
                first = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                yield pa.record_batch({
                    "row": batch.column("row").slice(a, b - a), "label": batch.column("label").slice(a, b - a),
                    "at": pa.ListArray.from_arrays(first, pa.array(at, pa.int32())),
                    "count": pa.ListArray.from_arrays(first, pa.array(counts, pa.int32())),
                })
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(count, f"row {kind}, label int, at array<int>, count array<int>")


def scored(docs: DataFrame, score: Callable[[pa.Array], dict[str, pa.Array]], schema: str, text_col: str = "text",
           id_col: str = "doc_id", folds: tuple[int, int] = (5, 0)) -> DataFrame:
    """(id, held_out, …) with the columns that `score` gives for slices of the texts."""
    rows = docs.select(F.col(f"`{id_col}`").alias("row"), F.col(f"`{text_col}`").alias("text"),
                       held_out(id_col, *folds).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in t.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                yield pa.record_batch({"row": part.column("row"), "held_out": part.column("held_out"),
                                       **score(part.column("text"))})
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, held_out boolean, {schema}").withColumnRenamed("row", id_col)


def kept(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text `keep` flags, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            flags = [keep(texts.slice(a, b - a)) for a, b in t.slices(texts)]
            yield batch.filter(pa.array(np.concatenate(flags) if flags else np.zeros(0, bool)))
    return docs.mapInArrow(run, docs.schema)
