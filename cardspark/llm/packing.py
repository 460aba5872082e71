"""Packing of tokenized documents into fixed-size sequences by length patterns fitted with non-negative least squares.

1. Tokenize on the executors; a document longer than the capacity is cut into
   capacity-sized pieces (the last one shorter). Each piece is one row.
2. The histogram of piece lengths (at most `capacity` rows) is the only thing
   the plan needs from the data. On the driver, patterns of one to three
   lengths that fill a sequence up to `WASTE` tokens are enumerated from the
   lengths present; repeat counts x >= 0 are fitted so that the patterns'
   length counts A x match the histogram h (min |A x - h|, multiplicative
   updates), rounded down and cut back to what the histogram holds. What the
   patterns leave is packed best-fit decreasing, by groups of equal bins.
3. The plan says, per length, which ranks of that length go to which
   sequences at which offset (intervals). Pieces are numbered within their
   length by a distributed range sort, and each piece finds its interval by a
   window over (length, block of ranks): no hot length lands in one task, no
   pair join.

The plan grows with the number of distinct lengths and patterns, never with
the rows.
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardspark.operators.numbering import number_rows
from cardspark.session import written

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: a pattern may leave at most so many tokens of its sequence empty
WASTE = 32
#: second lengths tried with each first length when patterns are enumerated
PARTNERS = 64
FIT_ROUNDS = 400
#: ranks of one length that one window partition numbers
BLOCK = 1 << 16
#: characters of text encoded by one call of the tokenizer
TEXT_CHARS = 1 << 21
#: distinct new pre-tokens given to the tokenizer in one call
WORDS_PER_CALL = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def _tokenizer(name: str):
    import os

    # one thread per task: the executor's cores are its tasks
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    if not os.path.isabs(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer.from_file(name)


#: the word tokenizer's split of normalized text into pre-tokens
EXACT_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: the same split for a text of ASCII characters alone, after lower-casing (letters a-z, digits, the six ASCII White_Space)
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9]+"


@cache
def _splitter() -> tuple[regex.Pattern, re.Pattern]:
    return regex.compile(EXACT_SPLIT), re.compile(ASCII_SPLIT)


def _split(text: str | None, exact: regex.Pattern, ascii_only: re.Pattern) -> list[str]:
    # per character, as the tokenizer lowercases: no final-sigma rule
    t = unicodedata.normalize("NFC", text or "").replace("Σ", "σ").lower()
    return (ascii_only if t.isascii() else exact).findall(t)


class PieceIds:
    """Token ids of texts for a tokenizer that encodes each pre-token alone (normalize, split, BPE per word).

    Ids of a distinct pre-token are asked of the tokenizer once per task, many
    at a time, and kept; a text's ids are then one gather of the kept ids. The
    result equals encoding the whole text (tested on the test tables).
    """

    def __init__(self, tokenizer: str):
        self.tokenizer = _tokenizer(tokenizer)
        self.split = _splitter()
        self.index: dict[str, int] = {}
        self.pool = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.asarray(found.ids, dtype=np.uint32)
        owner = np.asarray([w for w in found.word_ids], dtype=np.int64)
        counts = np.bincount(owner, minlength=len(words)) if len(owner) else np.zeros(len(words), dtype=np.int64)
        base = len(self.index)
        for k, w in enumerate(words):
            self.index[w] = base + k
        self.pool = np.concatenate([self.pool, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])

    def ids(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets): ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        words = [_split(t, *self.split) for t in texts]
        flat = pa.array(itertools.chain.from_iterable(words), type=pa.string())
        coded = pc.dictionary_encode(flat).combine_chunks() if isinstance(flat, pa.ChunkedArray) else pc.dictionary_encode(flat)
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.index]
        for i in range(0, len(new), WORDS_PER_CALL):
            self._learn(new[i:i + WORDS_PER_CALL])
        which = np.asarray([self.index[w] for w in distinct], dtype=np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.starts[which + 1] - self.starts[which]
        ends = np.cumsum(lengths)
        gather = np.repeat(self.starts[which] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        per_text = np.asarray([len(ws) for ws in words], dtype=np.int64)
        word_end = np.concatenate([[0], ends])[np.cumsum(per_text)]
        return self.pool[gather], np.concatenate([[0], word_end])


@cache
def _piece_ids(tokenizer: str) -> PieceIds:
    return PieceIds(tokenizer)


def piece_rows(doc_ids: list, texts: list, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
               end_id: int = END_ID) -> list[tuple]:
    """(doc_id, piece, start, length, ids_crc32) of the pieces of each text (null: empty), ids then `end_id`."""
    flat, offsets = _piece_ids(tokenizer).ids(texts)
    end = np.asarray([end_id], dtype="<u4")
    out = []
    for n, doc_id in enumerate(doc_ids):
        ids = np.concatenate([flat[offsets[n]:offsets[n + 1]].astype("<u4"), end])
        for k, start in enumerate(range(0, len(ids), capacity)):
            chunk = ids[start:start + capacity]
            out.append((doc_id, k, start, len(chunk), zlib.crc32(chunk.tobytes())))
    return out


def pieces(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer: str = TOKENIZER,
           capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document; the token ids themselves stay in the task.

    Texts go to the tokenizer in runs of at most `TEXT_CHARS` characters (a
    longer text alone), so a task holds the encodings of a few MB of text at a
    time however long its Arrow batches are.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, texts = frame["doc_id"].tolist(), frame["text"].tolist()
            sizes = np.cumsum([0 if t is None else len(t) for t in texts])
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + TEXT_CHARS, side="right")))
                rows = piece_rows(ids[i:j], texts[i:j], tokenizer, capacity)
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                    {"piece": "int32", "start": "int64", "length": "int64", "ids_crc32": "int64"})
                i = j

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, PIECES)


def patterns(lengths: np.ndarray, capacity: int = CAPACITY, waste: int = WASTE, partners: int = PARTNERS) -> list[tuple]:
    """Patterns of one to three present lengths (descending) that leave at most `waste` tokens of a sequence empty."""
    lens = np.unique(lengths)
    found = set()
    for a in lens.tolist():
        if a >= capacity - waste:
            found.add((a,))
        top = bisect.bisect_right(lens, min(a, capacity - a))
        for b in lens[max(0, top - partners):top].tolist():
            if a + b >= capacity - waste:
                found.add((a, b))
            room = min(b, capacity - a - b)
            i = bisect.bisect_right(lens, room)
            if i:
                c = int(lens[i - 1])
                if a + b + c >= capacity - waste:
                    found.add((a, b, c))
    return sorted(found, key=lambda p: (-sum(p), p))


def fit_counts(pats: list[tuple], hist: dict[int, int], rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 with A x close to the histogram: multiplicative updates x <- x * (A'h) / (A'A x)."""
    if not pats:
        return np.zeros(0)
    index = {length: i for i, length in enumerate(sorted(hist))}
    h = np.array([hist[k] for k in sorted(hist)], dtype=float)
    cols = np.repeat(np.arange(len(pats)), [len(p) for p in pats])
    rows = np.array([index[x] for p in pats for x in p])

    def times(x):
        return np.bincount(rows, weights=x[cols], minlength=len(h))

    def back(r):
        return np.bincount(cols, weights=r[rows], minlength=len(pats))

    target = back(h)
    x = np.ones(len(pats))
    for _ in range(rounds):
        x *= target / np.maximum(back(times(x)), 1e-12)
    return x


def plan(hist: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Groups (lengths of one bin, number of such bins) that hold every piece of the histogram exactly once."""
    left = {k: int(v) for k, v in hist.items() if v > 0}
    pats = patterns(np.array(sorted(left), dtype=np.int64), capacity)
    x = np.floor(fit_counts(pats, left)).astype(np.int64)
    groups: list[tuple[tuple, int]] = []
    for p, r in sorted(zip(pats, x), key=lambda t: (-t[1], -sum(t[0]), t[0])):
        need = {k: p.count(k) for k in set(p)}
        r = min([int(r)] + [left[k] // n for k, n in need.items()])
        if r > 0:
            groups.append((p, r))
            for k, n in need.items():
                left[k] -= n * r
    # the rest goes first into the room the patterns leave, then into new bins
    return best_fit(left, capacity, groups)


def best_fit(hist: dict[int, int], capacity: int = CAPACITY, opened: list[tuple[tuple, int]] = ()) -> list[tuple[tuple, int]]:
    """Best-fit decreasing over groups of equal bins: the longest pieces first, each into the bins with least room that fit.

    `opened`: groups of bins already holding pieces; returned with the rest.
    """
    free: dict[int, list[list]] = {}
    rooms: list[int] = []
    for lengths, n in opened:
        _put(free, rooms, capacity - sum(lengths), [tuple(lengths), n])
    for length in sorted((k for k, v in hist.items() if v > 0), reverse=True):
        count = hist[length]
        while count:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                per = capacity // length
                full, rest = divmod(count, per)
                for n, k in ((full, per), (1 if rest else 0, rest)):
                    if n:
                        _put(free, rooms, capacity - k * length, [(length,) * k, n])
                count = 0
                continue
            room = rooms[i]
            group = free[room][-1]
            k = min(count, group[1])
            group[1] -= k
            if group[1] == 0:
                free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(i)
            _put(free, rooms, room - length, [group[0] + (length,), k])
            count -= k
    return [(tuple(g[0]), g[1]) for room in sorted(free) for g in free[room]]


def _put(free: dict, rooms: list, room: int, group: list) -> None:
    if room not in free:
        bisect.insort(rooms, room)
        free[room] = []
    free[room].append(group)


def intervals(groups: list[tuple[tuple, int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence_id, offset): where each run of ranks of a length goes."""
    cursor: dict[int, int] = {}
    out = []
    seq = 0
    for lengths, n in groups:
        offset = 0
        for length in lengths:
            start = cursor.get(length, 0)
            out.append((length, start, n, seq, offset))
            cursor[length] = start + n
            offset += length
        seq += n
    return out


def pack(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer: str = TOKENIZER,
         capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the sequence and offset each is packed at.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A
    null text is empty and packs as its single end id; a null doc_id stays
    null; repeated rows are packed as separate documents. Empty table: no rows.
    """
    spark = docs.sparkSession
    # written once: the range sort of the numbering samples its input, which would tokenize everything twice
    cut = number_rows(written(pieces(docs, text_col, id_col, tokenizer, capacity), "pieces"),
                      ["length", "doc_id", "piece", "ids_crc32", "start"], "__n", after=-1)
    hist = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    groups = plan(hist, capacity)
    runs = intervals(groups)
    first = {}
    total = 0
    for length in sorted(hist):
        first[length] = total
        total += hist[length]
    # one row per run of the plan: bounded by the patterns and groups, not by the rows
    table = spark.createDataFrame(
        [(length, first[length] + s, n, q, o) for length, s, n, q, o in runs],
        "length long, i_start long, i_count long, i_seq long, i_offset long")
    starts = table.select(
        "length", "i_start", "i_seq", "i_offset",
        F.explode(F.sequence(F.floor(F.col("i_start") / BLOCK), F.floor((F.col("i_start") + F.col("i_count") - 1) / BLOCK))).alias("block")
    ).select("length", "block", F.greatest(F.col("i_start"), F.col("block") * BLOCK).alias("__n"),
             F.lit(0).alias("is_piece"), "i_start", "i_seq", "i_offset")
    rows = cut.select("length", F.floor(F.col("__n") / BLOCK).alias("block"), "__n", F.lit(1).alias("is_piece"),
                      "doc_id", "piece", "start", "ids_crc32")
    both = rows.unionByName(starts, allowMissingColumns=True)
    w = Window.partitionBy("length", "block").orderBy("__n", "is_piece").rowsBetween(Window.unboundedPreceding, 0)
    return (both.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"_{c}") for c in ("i_start", "i_seq", "i_offset")])
            .filter("is_piece = 1")
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("_i_seq") + F.col("__n") - F.col("_i_start")).alias("sequence_id"),
                    F.col("_i_offset").alias("offset")))
