"""Benchmark decontamination: documents that contain the shingles of a test item.

Items are partitioned by size into classes whose set sizes differ by less than
a factor of two. The MinHash sketch of an item is its m smallest shingles in
hash order, with m one more than the largest number of shingles that an item
of the class may miss. A document that contains enough of an item then
contains a sketch shingle, so the sketches find every such pair, however long
the document is; the candidates are confirmed on the item's whole set.

The items are the queries: they are held in blocks of bounded size, and every
block is held against all documents. Documents are neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm import kernels as k
from cardspark.llm.shingles import raw_shingles, shingle_sets

PERCENT = 80
BLOCK_BYTES = 4 << 20
_DOCS_BYTES = 4 << 20


class Items:
    """A block of test items: their shingle sets, and the sketches by hash value."""

    def __init__(self, texts: list[str | None], percent: int):
        values, self.first = shingle_sets(pa.array(texts, pa.string()))
        self.values, self.percent = values, percent
        self.sizes = np.diff(self.first)
        sketch, owner = [], []
        for i in np.flatnonzero(self.sizes).tolist():
            n = int(self.sizes[i])
            largest = (1 << n.bit_length()) - 1
            m = largest * (100 - percent) // 100 + 1
            mixed = np.sort(k.mix(values[self.first[i] : self.first[i + 1]]))[:m]
            sketch.append(mixed)
            owner.append(np.full(len(mixed), i))
        self.sketch = np.concatenate(sketch) if sketch else np.zeros(0, np.uint64)
        self.owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(self.sketch, kind="stable")
        self.sketch, self.owner = self.sketch[order], self.owner[order]

    def found_in(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(document, item, number of its shingles found) for the items contained to the wanted degree."""
        values, of, _ = raw_shingles(texts)
        if len(self.sketch) == 0 or len(values) == 0:
            return []
        mixed = k.mix(values)
        low = np.searchsorted(self.sketch, mixed)
        hit = np.flatnonzero(self.sketch[np.minimum(low, len(self.sketch) - 1)] == mixed)
        low, high = low[hit], np.searchsorted(self.sketch, mixed[hit], "right")
        counts = high - low
        entries = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        pairs = np.unique(np.stack([np.repeat(of[hit], counts), self.owner[entries]], 1), axis=0)
        out, last, there = [], -1, values[:0]
        for doc, item in pairs.tolist():
            if doc != last:
                there, last = np.sort(values[np.searchsorted(of, doc) : np.searchsorted(of, doc, "right")]), doc
            own = self.values[self.first[item] : self.first[item + 1]]
            at = np.minimum(np.searchsorted(there, own), len(there) - 1)
            same = int((there[at] == own).sum())
            if 100 * same >= self.percent * len(own):
                out.append((doc, item, same))
        return out


def _bounded(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about `_DOCS_BYTES` of text."""
    lengths = k.text_buffer(texts)[1]
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(lengths, lengths[at] + _DOCS_BYTES, "right")) - 1)
        yield at, end
        at = end


def _blocks(benchmark: DataFrame, text_col: str, id_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about `block_bytes`, one at a time on the driver."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).filter(
        "text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()]


def contained_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    item_text_col: str = "text", item_col: str = "item_id", percent: int = PERCENT,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item id, n_shingles, n_found): the items of which a document has `percent` % of the shingles or more.

    Shingles are distinct runs of five words lower-cased in A-Z; a text with
    fewer words is one shingle, its word sequence, so such an item is found only
    in documents that consist of it. Null texts and texts without words contain
    nothing and are contained in nothing. Each row of `docs` is judged on its
    own, and so is each row of `benchmark`; other columns are ignored; with no
    documents or no items there are no rows.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    kinds = base.schema[0].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc {kinds[0]}, item {kinds[1]}, n_shingles long, n_found long"
    result = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_text_col, item_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((Items([t for _, t in block], percent), [i for i, _ in block]))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, names = shared.value
            for batch in batches:
                texts = batch.column("text")
                for a, b in _bounded(texts):
                    rows = items.found_in(texts.slice(a, b - a))
                    ids = batch.column("doc")
                    yield pa.record_batch({
                        "doc": ids.take(pa.array([a + d for d, _, _ in rows], pa.int64())),
                        "item": pa.array([names[i] for _, i, _ in rows]).cast(pa_type),
                        "n_shingles": pa.array([int(items.sizes[i]) for _, i, _ in rows], pa.int64()),
                        "n_found": pa.array([n for _, _, n in rows], pa.int64()),
                    })
        pa_type = _arrow_type(kinds[1])
        result = result.unionByName(base.mapInArrow(search, schema))
    return result.withColumnsRenamed({"doc": id_col, "item": item_col})


def _arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text",
                   item_col: str = "item_id", percent: int = PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs` that contain no item, with all their columns; same rules as `contained_items`."""
    for block in _blocks(benchmark, item_text_col, item_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Items([t for _, t in block], percent))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(text_col)
                keep = np.ones(batch.num_rows, bool)
                for a, b in _bounded(texts):
                    for doc, _, _ in shared.value.found_in(texts.slice(a, b - a)):
                        keep[a + doc] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs
