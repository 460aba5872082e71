"""Suffix-array dedup: bytes covered by a string that an earlier document has as well.

A logarithmic index family. The documents arrive in batches, which are chunks
of ascending ids. A batch brings a suffix array: its sampled suffixes in the
order of the fingerprint of their first bytes. It is merge-scanned against the
arrays already there, the levels, and then becomes a level itself; levels of
equal size are merged, so that n batches leave about log2(n) levels and every
suffix takes part in as many merges. Each hash bucket of suffixes keeps its own
family, so the index is spread over the cluster and no array holds all suffixes.

Not every suffix is indexed. A string of `size` bytes is represented by the
smallest fingerprint among the `SAMPLE`-byte strings in it; equal strings have
equal representatives, and strings that start side by side mostly share one. A
maximal run of starts with the same representative is a block. Three scans lead
from blocks to bytes:

0. representatives: which of them occur in another document at all;
1. blocks of those: which blocks, as a whole, occur in an earlier batch, and
   which representatives stand for different blocks (where copies begin, end or
   differ);
2. the single strings of such blocks.

Within a batch the order of the documents decides. The outcome is that of a
search for every string at every byte; fingerprints have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from cardspark.llm import exchange as ex
from cardspark.llm import kernels as k

SIZE = 50
SAMPLE = 24
_SLICE = 1 << 15  # positions at a time: their 8-byte intermediates stay in the cache of a core


class Family:
    """Sorted arrays of geometrically growing size."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def scan(self, batch: np.ndarray) -> np.ndarray:
        """Flags of the entries of a sorted batch that some level has."""
        found = np.zeros(len(batch), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, batch), len(level) - 1)
            found |= level[at] == batch
        return found

    def add(self, batch: np.ndarray) -> None:
        """Make a sorted batch a level and merge levels of equal size."""
        if len(batch) == 0:
            return
        self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            merged = np.concatenate([self.levels.pop(), self.levels.pop()])
            merged.sort(kind="stable")  # a merge of two sorted runs
            keep = np.ones(len(merged), bool)
            keep[1:] = merged[1:] != merged[:-1]
            self.levels.append(merged[keep])


def _met_before(batches: list[np.ndarray]) -> list[np.ndarray]:
    """For each batch, which of its entries an earlier batch has."""
    family, out = Family(), []
    for batch in batches:
        out.append(family.scan(batch))
        family.add(batch)
    return out


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, end), one after the other."""
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class _Groups:
    """Distinct values in sorted order, with the lowest and highest document rank of each."""

    def __init__(self, values: np.ndarray, ranks: np.ndarray, second: np.ndarray | None = None):
        order = np.argsort(values, kind="stable") if second is None else np.lexsort((second, values))
        sorted_values = values[order]
        new = np.ones(len(order), bool)
        if second is None:
            new[1:] = sorted_values[1:] != sorted_values[:-1]
        else:
            sorted_second = second[order]
            new[1:] = (sorted_values[1:] != sorted_values[:-1]) | (sorted_second[1:] != sorted_second[:-1])
        at = np.flatnonzero(new)
        self.values = sorted_values[at]
        self.second = None if second is None else sorted_second[at]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        sorted_ranks = ranks[order]
        none = len(order) == 0
        self.lowest = sorted_ranks if none else np.minimum.reduceat(sorted_ranks, at)
        self.highest = sorted_ranks if none else np.maximum.reduceat(sorted_ranks, at)


class _Batch:
    """The documents of a chunk: their blocks, and what the answers so far say of them."""

    def __init__(self, docs: pa.Table, size: int, sample: int, n_buckets: int):
        self.size, self.sample, self.n_buckets = size, sample, n_buckets
        self.buf, self.offsets = k.text_buffer(docs.column("__text"))
        ids = docs.column("__row").combine_chunks()
        # nulls rank last, as one
        distinct = ids.unique()
        place = {v: i for i, v in enumerate(sorted((v for v in distinct.to_pylist() if v is not None)))}
        self.rank_of_doc = np.array([place.get(v, len(place)) for v in ids.to_pylist()], np.int64)
        self._blocks()

    def _blocks(self) -> None:
        count = max(0, len(self.buf) - self.size + 1)
        valid = k.valid_starts(self.offsets, self.size, count)
        width = self.size - self.sample + 1
        starts, keys = [], []
        for low in range(0, count, _SLICE):
            high = min(low + _SLICE, count)
            back = min(low, 1)
            part = self.buf[low - back : high + self.size - 1]
            least = k.sliding_min(k.window_hashes(None, self.sample, (8, k.byte_words(part))), width)
            fits = valid[low - back : high]
            new = fits.copy()
            new[1:] &= ~fits[:-1] | (least[1:] != least[:-1])
            if back:
                new[0] = False
            at = np.flatnonzero(new)
            starts.append(at + low - back)
            keys.append(k.mix(least[at]))  # smallest fingerprints crowd at the low end, scrambled ones do not
        self.start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        doc = np.searchsorted(self.offsets, self.start, "right") - 1
        last = self.offsets[doc + 1] - self.size + 1
        self.end = np.minimum(np.append(self.start[1:], count), last) if len(doc) else np.zeros(0, np.int64)
        self.rank = self.rank_of_doc[doc]

    def strings(self, positions: np.ndarray) -> np.ndarray:
        """Fingerprints of the strings of `size` bytes at ascending positions."""
        out = np.empty(len(positions), np.uint64)
        i = 0
        while i < len(positions):
            low = int(positions[i])
            j = int(np.searchsorted(positions, low + _SLICE))
            part = self.buf[low : int(positions[j - 1]) + self.size]
            out[i:j] = k.window_hashes(None, self.size, (8, k.byte_words(part)))[positions[i:j] - low]
            i = j
        return out

    def ask_keys(self) -> np.ndarray:
        self.keys = _Groups(self.key, self.rank)
        return self.keys.values

    def settle_keys(self, answers: pa.Table) -> None:
        g = self.keys
        (elsewhere,) = ex.received(answers, 0, 1, ex.entry_counts(g.values, self.n_buckets))
        alive = np.flatnonzero((elsewhere | (g.lowest < g.highest))[g.of])
        self.start, self.end, self.key, self.rank = (x[alive] for x in (self.start, self.end, self.key, self.rank))

    def ask_blocks(self) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.end - self.start
        before = np.cumsum(lengths) - lengths
        at = _ranges(self.start, self.end)
        nth = (np.arange(len(at)) - np.repeat(before, lengths)).astype(np.uint64)
        each = k.pair(self.strings(at), nth)
        block = np.add.reduceat(each, before) if len(before) else each
        self.blocks = _Groups(self.key, self.rank, k.mix(block + lengths.astype(np.uint64)))
        return self.blocks.values, self.blocks.second

    def settle_blocks(self, answers: pa.Table) -> None:
        g = self.blocks
        earlier, several = ex.received(answers, 1, 2, ex.entry_counts(g.values, self.n_buckets))
        whole = earlier[g.of] | (g.lowest[g.of] < self.rank)
        self.gone = [_ranges(self.start[whole], self.end[whole])]
        rest = np.flatnonzero(several[g.of] & ~earlier[g.of])
        self.at = _ranges(self.start[rest], self.end[rest])
        self.at_rank = np.repeat(self.rank[rest], (self.end - self.start)[rest])

    def ask_strings(self) -> np.ndarray:
        self.single = _Groups(self.strings(self.at), self.at_rank)
        return self.single.values

    def settle_strings(self, answers: pa.Table) -> None:
        g = self.single
        (earlier,) = ex.received(answers, 2, 1, ex.entry_counts(g.values, self.n_buckets))
        self.gone.append(self.at[earlier[g.of] | (g.lowest[g.of] < self.at_rank)])


def _send(docs: pa.Table, answers: pa.Table | None, level: int, **shape: int) -> pa.Table:
    if docs.num_rows == 0:
        return ex.sent_table([])
    batch = _Batch(docs, **shape)
    sent = [batch.ask_keys()]
    if level > 0:
        batch.settle_keys(answers)
        sent = batch.ask_blocks()
    if level > 1:
        batch.settle_blocks(answers)
        sent = [batch.ask_strings()]
    return ex.sent_table(ex.send(docs.column("chunk")[0].as_py(), level, sent[0], shape["n_buckets"], *sent[1:]))


def _send_keys(docs: pa.Table, **shape: int) -> pa.Table:
    return _send(docs, None, 0, **shape)


def _answer_keys(sent: pa.Table) -> pa.Table:
    """One bit: another batch has the entry."""
    parts = ex.entry_parts(sent)
    batches = [p[2][0] for p in parts]
    earlier = _met_before(batches)
    later = _met_before(batches[::-1])[::-1]
    return _answered(sent, parts, [(a | b,) for a, b in zip(earlier, later, strict=True)])


def _answer_blocks(sent: pa.Table) -> pa.Table:
    """Two bits: an earlier batch has the block; the key stands for several blocks."""
    parts = ex.entry_parts(sent, 2)
    whole = [k.pair(*p[2]) for p in parts]
    orders = [np.argsort(w) for w in whole]
    earlier = []
    for order, found in zip(orders, _met_before([w[o] for w, o in zip(whole, orders, strict=True)]), strict=True):
        flags = np.empty(len(order), bool)
        flags[order] = found
        earlier.append(flags)
    blocks = np.unique(np.concatenate(whole), return_index=True)[1]
    keys, counts = np.unique(np.concatenate([p[2][0] for p in parts])[blocks], return_counts=True)
    several = [(counts > 1)[np.searchsorted(keys, p[2][0])] for p in parts]
    return _answered(sent, parts, list(zip(earlier, several, strict=True)))


def _answer_strings(sent: pa.Table) -> pa.Table:
    """One bit: an earlier batch has the string."""
    parts = ex.entry_parts(sent)
    return _answered(sent, parts, [(found,) for found in _met_before([p[2][0] for p in parts])])


def _answered(sent: pa.Table, parts: list[tuple], flags: list[tuple[np.ndarray, ...]]) -> pa.Table:
    bucket = sent.column("bucket")[0].as_py()
    return ex.answer_table([(p[0], p[1], bucket, ex.packed(*f)) for p, f in zip(parts, flags, strict=True)])


def _whole_characters(gone: np.ndarray, buf: np.ndarray) -> np.ndarray:
    """The flagged bytes without those of characters that are flagged in part."""
    if not gone.any():
        return gone
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    whole = np.logical_and.reduceat(gone, lead)
    return np.repeat(whole, np.diff(np.append(lead, len(buf))))


def _cut(docs: pa.Table, answers: pa.Table, characters: bool, **shape: int) -> pa.Table:
    batch = _Batch(docs, **shape)
    batch.ask_keys()
    batch.settle_keys(answers)
    batch.ask_blocks()
    batch.settle_blocks(answers)
    batch.ask_strings()
    batch.settle_strings(answers)
    size, n = shape["size"], len(batch.buf)
    flags = np.zeros(max(0, n - size + 1), bool)
    for at in batch.gone:
        flags[at] = True
    gone = k.cover(flags, size)[:n] if len(flags) else np.zeros(n, bool)
    if characters:
        gone = _whole_characters(gone, batch.buf)
    at = batch.offsets.tolist()
    n_bytes, n_removed, spans, kept = [], [], [], []
    for i in range(docs.num_rows):
        here = gone[at[i] : at[i + 1]]
        part = batch.buf[at[i] : at[i + 1]]
        n_bytes.append(len(part))
        n_removed.append(int(here.sum()))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
        spans.append([{"start": a, "end": b} for a, b in edges])
        kept.append((part[~here] if edges else part).tobytes())
    return pa.table({
        **{c: docs.column(c) for c in docs.column_names if c not in ("__text", "chunk")},
        "n_bytes": pa.array(n_bytes, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "kept": pa.array(kept, pa.binary()),
    })


def suffix_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SIZE,
                 sample: int = SAMPLE, chunk_bytes: int = ex.CHUNK_BYTES, characters: bool = False,
                 rest: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_removed, removed `spans` of byte numbers [start, end), and the `kept` bytes.

    A byte goes if some string of `size` bytes that covers it also starts in a
    document with a smaller id; strings never cross documents and are judged
    on the input. Removed spans may overlap in their strings but not as spans:
    each is a maximal run of removed bytes. A null text is empty; texts of
    fewer than `size` bytes stay whole; rows with the same id are one another's
    equals, so neither loses bytes to the other; a null id counts as larger than
    all others. `kept` may cut a character in two, therefore it is binary; with
    `characters`, only characters go that are removed as a whole, and `kept` is
    UTF-8. Other columns are ignored, or with `rest` returned as the struct
    `rest`; no rows give no rows.
    """
    if not 8 <= sample <= size:
        raise ValueError("sample must be between 8 and size")
    n = ex.chunk_count(docs, text_col, chunk_bytes)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    base = docs.select(F.col(f"`{id_col}`").alias("__row"), F.col(f"`{text_col}`").alias("__text"),
                       *([F.struct(*others).alias("rest")] if rest and others else []))
    chunked = base.select("*", ex.range_chunk(base, "__row", n)).groupBy("chunk")
    shape = {"size": size, "sample": sample, "n_buckets": n}

    def answered(sent: DataFrame, answer: object) -> DataFrame:
        return sent.groupBy("bucket").applyInArrow(ex.on_group(answer), ex.ANSWERS)

    answers = answered(chunked.applyInArrow(ex.on_group(_send_keys, **shape), ex.SENT), _answer_keys)
    for level, answer in ((1, _answer_blocks), (2, _answer_strings)):
        sent = chunked.cogroup(answers.groupBy("chunk")).applyInArrow(ex.on_pair(_send, level=level, **shape), ex.SENT)
        answers = answers.unionByName(answered(sent, answer))
    result = StructType([f for f in base.schema if f.name != "__text"])
    span = StructType().add("start", "long").add("end", "long")
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("spans", ArrayType(span)), ("kept", "binary")):
        result = result.add(name, kind)
    out = chunked.cogroup(answers.groupBy("chunk")).applyInArrow(
        ex.on_pair(_cut, characters=characters, **shape), result)
    return out.withColumnRenamed("__row", id_col)
