"""Language ID: script ranges narrow the candidates, Viterbi labels the words.

The model counts, per language, the byte trigrams of all words of the learning
documents (hashed to `BUCKETS` buckets) and their scripts. A word may only have
a language that uses its script; its score is the log likelihood of its
trigrams. Along a document, the best sequence of languages is found where each
change costs `SWITCH`, so that stray words do not count but foreign passages
do. The document's language is the one with most letters.

All documents of a slice advance together, one word at a time, the longest
ones first, so a step is a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm import kernels as k
from cardspark.llm import labelled
from cardspark.llm import terms as t

BUCKETS = 1 << 15
SWITCH = 12.0
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

# fixed values: first code points of the Unicode blocks of a script, by ascending code point
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "symbol"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"),
    (0xD7B0, "symbol"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0x20000, "han"),
]
_NAMES = sorted({name for _, name in SCRIPTS})
_FROM = np.array([start for start, _ in SCRIPTS])
_WHICH = np.array([_NAMES.index(name) for _, name in SCRIPTS])

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class _Words:
    """The words of some texts: letter runs, numbered by distinct word, with the script and bytes of each distinct word."""

    def __init__(self, texts: pa.Array):
        buf, offsets = k.text_buffer(texts)
        starts, ends, self.of = t.runs_of(buf, offsets, _LETTER[buf])
        self.n_docs = len(offsets) - 1
        hashes = k.word_hashes(buf, starts, ends, fold=True)
        _, at, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.lengths = (ends - starts)[at]
        # the distinct words, each behind a blank
        size = self.lengths + 1
        self.first = np.cumsum(size) - size
        total = int(size.sum())
        source = np.repeat(starts[at] - self.first - 1, size) + np.arange(total)
        self.bytes = np.append(buf[np.maximum(source, 0)] if total else np.zeros(0, np.uint8), np.uint8(32)).copy()
        self.bytes[self.first] = 32
        capital = (self.bytes >= 65) & (self.bytes <= 90)
        self.bytes[capital] += 32
        self.script = self._scripts()

    def _scripts(self) -> np.ndarray:
        out = np.full(len(self.first), _NAMES.index("latin"))
        b = self.bytes.astype(np.int64)
        lead = np.flatnonzero(self.bytes >= 0xC0)
        if len(lead) == 0:
            return out
        wide = np.concatenate([b, [0, 0, 0]])
        c = wide[lead]
        one, two, three = (wide[lead + i] & 0x3F for i in (1, 2, 3))
        point = np.where(c < 0xE0, (c & 0x1F) << 6 | one, np.where(
            c < 0xF0, (c & 0x0F) << 12 | one << 6 | two, (c & 0x07) << 18 | one << 12 | two << 6 | three))
        word = np.searchsorted(self.first, lead, "right") - 1
        which, first = np.unique(word, return_index=True)
        out[which] = _WHICH[np.searchsorted(_FROM, point[first], "right") - 1]
        return out

    def trigrams(self) -> np.ndarray:
        """Bucket of the three bytes around every byte of `bytes` but the last; blanks belong to no word."""
        b = self.bytes.astype(np.uint64)
        code = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
        return (k.mix(code) % np.uint64(BUCKETS)).astype(np.int64)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all documents that have a language; one row per language and bucket reaches the driver."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for a, b in t.slices(batch.column("text")):
                words = _Words(batch.column("text").slice(a, b - a))
                names, lang = np.unique(batch.column("lang").slice(a, b - a).to_pylist(), return_inverse=True)
                per_word = np.bincount(lang[words.of] * len(words.first) + words.number,
                                       minlength=len(names) * len(words.first)).reshape(len(names), -1)
                grams = words.trigrams() if len(words.first) else np.zeros(0, np.int64)
                inside = np.flatnonzero(words.bytes[1:-1] != 32) if len(words.first) else np.zeros(0, np.int64)
                word = np.searchsorted(words.first, inside + 1, "right") - 1
                for i, name in enumerate(names.tolist()):
                    own = totals.setdefault(name, np.zeros(BUCKETS + len(_NAMES), np.int64))
                    own[:BUCKETS] += np.bincount(grams[inside], per_word[i][word], BUCKETS).astype(np.int64)
                    own[BUCKETS:] += np.bincount(words.script, per_word[i], len(_NAMES)).astype(np.int64)
        for name, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "at": pa.array(at, pa.int64()),
                                   "n": pa.array(own[at], pa.int64())})
    counts = rows.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    return Model(counts.toArrow())


class Model:
    def __init__(self, counts: pa.Table):
        self.langs = sorted(set(counts.column("lang").to_pylist()))
        table = np.zeros((len(self.langs), BUCKETS + len(_NAMES)))
        place = {name: i for i, name in enumerate(self.langs)}
        rows = [place[x] for x in counts.column("lang").to_pylist()]
        table[rows, counts.column("at").to_numpy()] = counts.column("n").to_numpy()
        grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
        self.log = np.log(grams / grams.sum(1, keepdims=True)).T.astype(np.float32).copy() if self.langs else grams.T
        used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
        # a script that no language uses rules none out
        self.allowed = np.where(used.any(0), used, True).T

    def _word_scores(self, words: _Words) -> np.ndarray:
        inside = words.bytes[1:-1] != 32
        scores = self.log[words.trigrams()] * inside[:, None]
        sums = np.add.reduceat(scores, np.minimum(words.first, len(scores) - 1), axis=0)
        ruled_out = ~self.allowed[words.script]
        return np.where(ruled_out, sums.min(1, keepdims=True) - 1000, sums).astype(np.float32)

    def _paths(self, scores: np.ndarray, words: _Words) -> np.ndarray:
        """Best language of every word."""
        lengths = np.bincount(words.of, minlength=words.n_docs)
        begin = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        lengths, begin = lengths[order], begin[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left").tolist()  # documents longer than t words
        stay = np.empty((len(words.of), len(self.langs)), bool)
        best = np.empty(len(words.of), np.int16)
        value = np.zeros((len(lengths), len(self.langs)), np.float32)
        for step, n in enumerate(active):
            at = begin[:n] + step
            now = value[:n]
            top = now.argmax(1)
            change = now[np.arange(n), top][:, None] - np.float32(SWITCH if step else 0)
            stay[at], best[at] = now >= change, top
            value[:n] = np.maximum(now, change) - change + scores[words.number[at]]
        label = np.empty(len(words.of), np.int16)
        last = value.argmax(1).astype(np.int16)
        for step in range(len(active) - 1, -1, -1):
            n = active[step]
            at = begin[:n] + step
            label[at] = last[:n]
            last[:n] = np.where(stay[at, last[:n]], last[:n], best[at])
        return label

    def predict(self, texts: pa.Array) -> dict[str, pa.Array]:
        words = _Words(texts)
        n = words.n_docs
        names, shares, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
        if self.langs and len(words.of):
            label = self._paths(self._word_scores(words), words)
            size = words.lengths[words.number]
            letters = np.bincount(words.of * len(self.langs) + label, size, n * len(self.langs)).reshape(n, -1)
            top = letters.argmax(1)
            shares = letters.max(1) / np.maximum(letters.sum(1), 1)
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (words.of[1:] != words.of[:-1])
            at = np.flatnonzero(new)
            begin = np.searchsorted(words.of, np.arange(n))
            ends = np.append(at[1:], len(label))
            for doc, a, b, lang in zip(words.of[at].tolist(), at.tolist(), ends.tolist(), label[at].tolist(), strict=True):
                spans[doc].append({"start": a - int(begin[doc]), "end": b - int(begin[doc]), "lang": self.langs[lang]})
            for i, text in enumerate(texts):
                if letters[i].any() and any(map(str.isalpha, text.as_py())):
                    names[i] = self.langs[top[i]]
                else:
                    shares[i], spans[i] = 0, []
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(shares, pa.float64()),
                "spans": pa.array(spans, kind)}


def identify(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id",
             folds: tuple[int, int] = (5, 0)) -> DataFrame:
    """Per document: id, held_out, lang_pred, score (share of its letters in that language) and spans.

    held_out: whether the id's CRC-32 leaves folds[1] when divided by folds[0].
    Spans are [start, end) in words, runs of letters, with the language of each.
    Null texts and texts without a letter are `und` with score 0, and so is
    every text if nothing was learned. Rows are judged one by one by their text
    alone; other columns are ignored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return labelled.scored(
        docs, lambda texts: shared.value.predict(texts),
        "lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>", text_col, id_col,
        folds)
