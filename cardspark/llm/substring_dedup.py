"""Substring dedup: words covered by a word window that occurs more than once.

Level-wise doubling. Windows of a quarter of the wanted length are looked at
first; only windows that contain a repeated one are extended to twice that
length, and so on up to the wanted length. Below that length not every window
needs a look: two equal long windows contain the same smallest fingerprint of
their short windows, so each long window asks about that one alone, and
neighbouring windows mostly share it. A level costs one exchange of distinct
fingerprints per chunk (`exchange`), which shrinks with the candidates; the
last level asks about every window that is still a candidate, so the outcome
is that of a search over all windows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm import exchange as ex
from cardspark.llm import kernels as k

WINDOW = 35


def levels(size: int) -> list[int]:
    """Window lengths: a quarter of `size`, doubled until `size` is reached."""
    length, out = max(1, -(-size // 4)), []
    while length < size:
        out.append(length)
        length *= 2
    return [*out, size]


class _Chunk:
    """The words of a chunk and the windows that are still candidates."""

    def __init__(self, texts: pa.ChunkedArray, size: int):
        self.buf, self.offsets = k.text_buffer(texts)
        self.starts, self.ends, self.first = k.words(self.buf, self.offsets)
        self.size = size
        self.count = max(0, len(self.starts) - size + 1)
        self.alive = k.valid_starts(self.first, size, self.count)
        self._known = (1, k.word_hashes(self.buf, self.starts, self.ends))

    def ask(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, repeated here, smallest key of each window) for the short windows that stand for the candidates."""
        if self.count == 0:
            none = np.zeros(0, np.uint64)
            return none, none > 0, none
        short = k.window_hashes(self._known[1], length, self._known)
        self._known = (length, short)
        width = self.size - length + 1
        least = k.sliding_min(short, width)
        least = np.where(self.alive, least, np.uint64(0))
        if width > 1:
            edge = np.zeros(width - 1, np.uint64)
            most = ~k.sliding_min(~np.concatenate([edge, least, edge]), width)
            chosen = short[(most == short) & (most > 0)]
        else:
            chosen = least[self.alive]
        # smallest fingerprints crowd at the low end; scrambled again they fill the bucket ranges evenly
        keys, counts = np.unique(k.mix(chosen), return_counts=True)
        return keys, counts > 1, k.mix(least)

    def settle(self, keys: np.ndarray, repeated: np.ndarray, least: np.ndarray) -> None:
        """Keep the candidates whose key is repeated."""
        if len(keys) == 0:
            self.alive = np.zeros(self.count, bool)
            return
        at = np.minimum(np.searchsorted(keys, least), len(keys) - 1)
        self.alive &= repeated[at] & (keys[at] == least)


def _settled(texts: pa.ChunkedArray, answers: pa.Table | None, size: int, n_buckets: int, upto: int) -> _Chunk:
    chunk = _Chunk(texts, size)
    for level, length in enumerate(levels(size)[:upto]):
        keys, here, least = chunk.ask(length)
        (elsewhere,) = ex.received(answers, level, 1, ex.entry_counts(keys, n_buckets))
        chunk.settle(keys, here | elsewhere, least)
    return chunk


def _send(docs: pa.Table, answers: pa.Table | None, size: int, n_buckets: int, level: int) -> pa.Table:
    if docs.num_rows == 0:
        return ex.sent_table([])
    chunk = _settled(docs.column("__text"), answers, size, n_buckets, level)
    keys, _, _ = chunk.ask(levels(size)[level])
    return ex.sent_table(ex.send(docs.column("chunk")[0].as_py(), level, keys, n_buckets))


def _send_first(docs: pa.Table, size: int, n_buckets: int) -> pa.Table:
    return _send(docs, None, size, n_buckets, 0)


def _answer(sent: pa.Table) -> pa.Table:
    """One bit per entry: another chunk has it as well."""
    parts = ex.entry_parts(sent)
    keys, inverse, counts = np.unique(np.concatenate([p[2][0] for p in parts]), return_inverse=True, return_counts=True)
    several = (counts > 1)[inverse]
    bucket, at, rows = sent.column("bucket")[0].as_py(), 0, []
    for chunk, level, (entries,) in parts:
        rows.append((chunk, level, bucket, ex.packed(several[at : at + len(entries)])))
        at += len(entries)
    return ex.answer_table(rows)


_RESULT = "__row long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]


def _cut(docs: pa.Table, answers: pa.Table, size: int, n_buckets: int) -> pa.Table:
    chunk = _settled(docs.column("__text"), answers, size, n_buckets, len(levels(size)))
    n = len(chunk.starts)
    gone = np.zeros(n, bool)
    if chunk.count:
        gone[:] = k.cover(chunk.alive, size)[:n]
    data = chunk.buf.tobytes()
    first, at = chunk.first.tolist(), chunk.offsets.tolist()
    n_words, n_removed, spans, kept = [], [], [], []
    for i in range(docs.num_rows):
        flags = gone[first[i] : first[i + 1]]
        removed = int(flags.sum())
        tokens = data[at[i] : at[i + 1]].split()
        n_words.append(len(flags))
        n_removed.append(removed)
        spans.append(_runs(flags) if removed else [])
        kept.append(b" ".join(compress(tokens, (~flags).tolist()) if removed else tokens))
    return pa.table({
        "__row": docs.column("__row"),
        "n_words": pa.array(n_words, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
    })


def substring_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = WINDOW,
                    chunk_bytes: int = ex.CHUNK_BYTES) -> DataFrame:
    """Per document: id, n_words, n_removed, removed `spans` of word numbers [start, end), and kept_text.

    A word goes if a window of `size` words of its document that covers it has
    the same words as a window that starts anywhere else, in the same document
    or another. Windows are judged on the input. Kept words are joined by one
    space. A null text has no words and an empty kept text; texts with fewer
    than `size` words stay whole; rows that repeat an id are documents of
    their own; other columns of `docs` are ignored; no rows give no rows.
    """
    n = ex.chunk_count(docs, text_col, chunk_bytes)
    base = docs.select(F.col(f"`{id_col}`").alias("__row"), F.col(f"`{text_col}`").alias("__text"))
    chunked = base.select("*", ex.hashed_chunk(n, "__row", "__text"))
    by_chunk = chunked.groupBy("chunk")
    answers = None
    for level in range(len(levels(size))):
        if answers is None:
            sent = by_chunk.applyInArrow(ex.on_group(_send_first, size=size, n_buckets=n), ex.SENT)
        else:
            sent = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
                ex.on_pair(_send, size=size, n_buckets=n, level=level), ex.SENT)
        answered = sent.groupBy("bucket").applyInArrow(ex.on_group(_answer), ex.ANSWERS)
        answers = answered if answers is None else answers.unionByName(answered)
    out = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        ex.on_pair(_cut, size=size, n_buckets=n), _RESULT.replace("__row long", f"__row {base.schema[0].dataType.simpleString()}"))
    return out.withColumnRenamed("__row", id_col)
