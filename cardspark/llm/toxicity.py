"""Toxicity: nearest labelled examples by TF-IDF cosine, found with block-max inverted indexes.

The examples are at most `examples` labelled texts. Their terms (words and word
beginnings) are all indexed; term frequencies come from the examples, document
frequencies from all documents. A term that no example has counts towards the
length of a text as if no other document had it, so its frequency is not looked
up. Terms that toxic examples have more often than chance allows weigh
`LEAN` times their idf, because among plain TF-IDF weights the subject of a text
outweighs a few insults; all others weigh their idf. The index has one posting list per term. Lists of more than 1 / `LONG` of
the examples, at most `LONG_LISTS` of them, are stored by block with the
largest weight in each; the others are shorter than their block maxima are
worth and read whole. A text looks at the blocks with the highest bounds, then
at those whose bound reaches its nearest examples so far, so the neighbours are
exact. Texts are searched in batches that share the reading of a block.

The vote weighs each neighbour by its squared similarity and the share of toxic
examples by `PRIOR`, so a text without near examples gets that share. Texts
without any indexed term have the same distance to all examples; their score
is the share of toxic ones among the examples without a term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm import labelled
from cardspark.llm import terms as t

EXAMPLES = 12_000
NEIGHBOURS = 15
BLOCK = 128
FIRST_BLOCKS = 2
LONG, LONG_LISTS = 24, 2048
BATCH = 128
TERMS = 1 << 20  # bytes of text whose terms are found at a time
PRIOR = 0.5
Z, LEAN = 4.0, 16.0
EVIDENCE = 3
_BITS = 20


class Vocabulary:
    """Sorted terms, found by their leading bits."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        edges = np.arange(1 << _BITS, dtype=np.uint64) << np.uint64(64 - _BITS)
        self.start = np.searchsorted(terms, edges).astype(np.int32)

    def __len__(self) -> int:
        return len(self.terms)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, -1 if it is not there."""
        out = np.full(len(terms), -1, np.int64)
        if not len(self):
            return out
        at = self.start[(terms >> np.uint64(64 - _BITS)).astype(np.int64)].astype(np.int64)
        open_ = np.flatnonzero(at < len(self))
        while len(open_):
            here = self.terms[at[open_]]
            same = here == terms[open_]
            out[open_[same]] = at[open_[same]]
            open_ = open_[here < terms[open_]]
            at[open_] += 1
            open_ = open_[at[open_] < len(self)]
        return out

    def counted(self, terms: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, index, count) for the terms that are in it, by document."""
        at = self.find(terms)
        known = at >= 0
        joint, counts = np.unique(of[known] * len(self) + at[known], return_counts=True)
        return joint // max(1, len(self)), joint % max(1, len(self)), counts

    def beyond(self, terms: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        """Sum of the squared frequency weights of the terms that are not in it, for each of `n` documents."""
        out = self.find(terms) < 0
        terms, of = terms[out], of[out]
        order = np.lexsort((terms, of))
        terms, of = terms[order], of[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        weight = 1 + np.log(np.diff(first, append=len(terms)))
        return np.bincount(of[first], weight * weight, n)


class Lists:
    """Posting lists in one array: the long ones first, cut at blocks and laid out by block, with block maxima; then the others.

    The long lists are far from full, so rows of all their weights would take several times their size in every
    worker. A block is spread out when a batch looks at it.
    """

    def __init__(self, length: np.ndarray, rows: list[tuple], weigh: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        """`length`: number of examples with each term; `rows`: (…, distinct terms, counts) of each example.

        A posting is put straight into its place, since sorting them takes many times their size on the driver.
        """
        n_examples = len(rows)
        self.size = -(-n_examples // BLOCK) * BLOCK
        longest = np.argsort(-length, kind="stable")[:LONG_LISTS]
        longest = longest[length[longest] > n_examples // LONG]  # the most frequent term first
        self.row = np.full(len(length), -1, np.int32)
        self.row[longest] = np.arange(len(longest))
        self.n_long = len(longest)
        cuts = np.zeros((self.size // BLOCK, self.n_long), np.int64)
        for example, r in enumerate(rows):
            row = self.row[r[-2]]
            cuts[example // BLOCK, row[row >= 0]] += 1
        self.cut = np.append(0, np.cumsum(cuts))  # of block and row
        self.first = self.cut[-1] + np.append(0, np.cumsum(np.where(self.row >= 0, 0, length)))
        self.example = np.empty(self.first[-1], np.uint16 if self.size < 1 << 16 else np.int32)
        self.weight = np.empty(self.first[-1], np.float32)
        free = self.first[:-1].copy()
        for example, r in enumerate(rows):
            if example % BLOCK == 0:
                at = example // BLOCK * self.n_long
                free[longest] = self.cut[at : at + self.n_long]
            to = free[r[-2]]
            self.example[to], self.weight[to] = example, weigh(r[-2], r[-1])
            free[r[-2]] += 1

    def __getstate__(self) -> dict:
        """Without the block maxima, which each worker takes itself."""
        return {k: v for k, v in self.__dict__.items() if k != "most"}

    @cached_property
    def most(self) -> np.ndarray:
        """The largest weight of each long list, by block."""
        some = np.flatnonzero(np.diff(self.cut))
        out = np.zeros(len(self.cut) - 1, np.float32)
        if len(some):
            out[some] = np.maximum.reduceat(self.weight[: self.cut[-1]], self.cut[some])
        return np.ascontiguousarray(out.reshape(self.size // BLOCK, self.n_long).T)

    def block(self, b: int) -> np.ndarray:
        """The long lists within a block, as rows of weights."""
        cut = self.cut[b * self.n_long : (b + 1) * self.n_long + 1]
        cell = np.repeat(np.arange(self.n_long, dtype=np.int32) * BLOCK - b * BLOCK, np.diff(cut))
        cell += self.example[cut[0] : cut[-1]]
        out = np.zeros(self.n_long * BLOCK, np.float32)
        out[cell] = self.weight[cut[0] : cut[-1]]
        return out.reshape(self.n_long, BLOCK)

    def leading(self, at: np.ndarray, n: int = 8) -> list[int]:
        """The most frequent terms as rows."""
        row = self.row[at]
        return np.sort(row[row >= 0])[:n].tolist()

    def short(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the short lists of the terms add to each example."""
        length = self.first[at + 1] - self.first[at]
        ends = np.cumsum(length)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[at] - ends + length, length)
        return np.bincount(self.example[where], self.weight[where] * np.repeat(w.astype(np.float32), length), self.size)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The lists of some terms as rows of weights."""
        at = np.asarray(at)
        out = np.zeros((len(at), self.size), np.float32)
        for i, term in enumerate(at.tolist()):
            a, b = self.first[term], self.first[term + 1]
            out[i, self.example[a:b]] = self.weight[a:b]
        far = np.flatnonzero(self.row[at] >= 0)
        for b in range(self.size // BLOCK if len(far) else 0):
            out[far, b * BLOCK : (b + 1) * BLOCK] = self.block(b)[self.row[at[far]]]
        return out


class Index:
    """Posting lists of the examples, with their block maxima."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, rows: list[tuple], beyond: float = 0.0):
        """`rows`: (id, label, distinct term indexes, counts) of each example; `beyond`: idf of terms of no example."""
        self.vocabulary, self.idf, self.beyond = Vocabulary(vocabulary), idf, beyond
        bare = [r[1] for r in rows if not len(r[2])]
        self.share = (sum(r[1] for r in rows) + 1) / (len(rows) + 2)
        self.bare = (sum(bare) + self.share) / (len(bare) + 1)
        rows = [r for r in rows if len(r[2])]
        length = np.zeros(len(vocabulary), np.int64)
        for r in rows:
            length[r[2]] += 1
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.argsort(-length, kind="stable")] = np.arange(len(vocabulary))
        # like examples into the same blocks: by their most frequent terms
        rows = sorted(rows, key=lambda r: (np.sort(rank[r[2]])[:16].tolist(), str(r[0])))
        self.ids = [r[0] for r in rows]
        self.labels = np.array([r[1] for r in rows], np.float64)
        self.postings = Lists(length, rows, self.weights)

    def weights(self, at: np.ndarray, counts: np.ndarray, beyond: float = 0.0) -> np.ndarray:
        """Weights of a text's terms; `beyond`: squared frequency weights of its terms of no example."""
        w = (1 + np.log(counts)) * self.idf[at]
        return w / np.sqrt((w * w).sum() + beyond * self.beyond**2)

    def search(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(examples, similarities) of the nearest ones of each (terms, weights), ties by position."""
        lists, n = self.postings, len(texts)
        blocks = lists.size // BLOCK
        if not blocks:
            return [(np.zeros(0, np.int64), np.zeros(0, np.float32))] * n
        long, sims = np.zeros((n, lists.n_long), np.float32), np.empty((n, blocks, BLOCK), np.float32)
        for i, (at, w) in enumerate(texts):
            row = lists.row[at]
            far = row >= 0
            long[i, row[far]] = w[far]
            sims[i] = lists.short(at[~far], w[~far]).reshape(blocks, BLOCK)
        used = np.flatnonzero(long.any(0))
        long = long[:, used]
        bounds = (long @ lists.most[used] + sims.max(2)) * np.float32(1 + 1e-5)
        seen = np.zeros((n, blocks), bool)

        def look(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)).tolist():
                some = np.flatnonzero(wanted[:, b])
                sims[some, b] += long[some] @ lists.block(b)[used]
            seen[wanted] = True

        top = np.argsort(-bounds, 1, kind="stable")[:, :FIRST_BLOCKS]
        wanted = np.zeros((n, blocks), bool)
        np.put_along_axis(wanted, top, True, 1)
        look(wanted)
        near = sims[np.arange(n)[:, None], top].reshape(n, -1)
        least = np.partition(near, near.shape[1] - NEIGHBOURS, 1)[:, near.shape[1] - NEIGHBOURS]
        look(~seen & (bounds > 0) & (bounds >= least[:, None]))
        sims[~seen] = 0
        out = []
        for flat, low in zip(sims.reshape(n, -1), (least - np.float32(1e-5)).tolist(), strict=True):
            found = np.flatnonzero(flat > max(low, 0))
            found = found[np.lexsort((found, -np.round(flat[found], 6)))[:NEIGHBOURS]]
            out.append((found, flat[found]))
        return out

    def nearest(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(examples, similarities) of the nearest ones of a text, ties by position."""
        return self.search([(at, self.weights(at, counts))])[0]

    def terms(self, texts: pa.Array, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document from `base` on, index, count) of the indexed terms, and what the others of each document add to its length."""
        found, of, n = t.word_terms(texts)
        doc, at, counts = self.vocabulary.counted(found, of)
        beyond = self.vocabulary.beyond(found, of, n)
        return (doc + base).astype(np.int32), at.astype(np.int32), counts.astype(np.int32), beyond

    def score(self, texts: pa.Array) -> dict[str, pa.Array]:
        n = len(texts)
        # the terms of few texts at a time, since finding them takes many times the size of the texts
        parts = [self.terms(texts.slice(a, b - a), a) for a, b in t.slices(texts, TERMS)]
        doc, at, counts, beyond = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 4
        del parts
        scores, evidence = np.full(n, self.bare), [[] for _ in range(n)]
        first = np.flatnonzero(np.diff(doc, prepend=-1)) if len(doc) else np.zeros(0, np.int64)
        ranges = list(zip(first.tolist(), [*first[1:].tolist(), len(doc)], strict=True)) if len(first) else []
        # texts that share frequent terms into the same batches
        ranges.sort(key=lambda r: self.postings.leading(at[r[0] : r[1]]))
        for start in range(0, len(ranges), BATCH):
            batch = ranges[start : start + BATCH]
            texts_in = [(at[a:b], self.weights(at[a:b], counts[a:b], beyond[doc[a]])) for a, b in batch]
            for (a, _), (near, sims) in zip(batch, self.search(texts_in), strict=True):
                weights = sims.astype(np.float64) ** 2
                i = int(doc[a])
                scores[i] = (weights @ self.labels[near] + PRIOR * self.share) / (weights.sum() + PRIOR)
                evidence[i] = [{"id": str(self.ids[e]), "similarity": float(s), "toxic": int(self.labels[e])}
                               for e, s in zip(near[:EVIDENCE].tolist(), sims[:EVIDENCE].tolist(), strict=True)]
        kind = pa.list_(pa.struct([("id", pa.string()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        return {"score": pa.array(np.clip(scores, 0, 1)), "evidence": pa.array(evidence, kind)}


def document_frequency(docs: DataFrame, words: np.ndarray, text_col: str = "text") -> tuple[np.ndarray, int]:
    """(number of documents with each of the sorted words, number of documents), over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = Vocabulary(shared.value), 0
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for a, b in t.slices(batch.column("text"), TERMS):
                found, of, _ = t.word_terms(batch.column("text").slice(a, b - a))
                total += np.bincount(known.counted(found, of)[1], minlength=len(known))
                n += b - a
        at = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(np.append(at, -1), pa.int64()),
                               "n": pa.array(np.append(total[at], n), pa.int64())})
    parts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "at long, n long")
    found = parts.groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # one row per term
    at, n = (found.column(c).to_numpy() for c in ("at", "n"))
    out = np.zeros(len(words), np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def leaning(positive: np.ndarray, negative: np.ndarray, positives: int, negatives: int) -> np.ndarray:
    """Factor of each term's idf: `LEAN` if toxic examples have it more often than chance allows, else 1."""
    if not positives or not negatives:
        return np.ones(len(positive))
    share = (positive + negative) / (positives + negatives)
    z = (positive / positives - negative / negatives) / np.sqrt(
        np.maximum(share * (1 - share), 1e-12) * (1 / positives + 1 / negatives))
    return np.where((z >= Z) & (positive >= 3), LEAN, 1.0)


def example_rows(counted: pa.Table) -> list[tuple]:
    """(row, label, at, count) of each example, the arrays as views of the table."""
    out = []
    for part in counted.to_batches():
        at, counts = (part.column(c).flatten().to_numpy() for c in ("at", "count"))
        sizes = pc.list_value_length(part.column("at")).to_numpy()
        ends = np.cumsum(sizes)
        out += [(i, c, at[b - s : b], counts[b - s : b]) for i, c, b, s in zip(
            part.column("row").to_pylist(), part.column("label").to_pylist(), ends.tolist(), sizes.tolist(), strict=True)]
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text_col: str = "text", id_col: str = "doc_id",
        examples: int = EXAMPLES) -> Index:
    """Index of the labelled texts; without labelled texts every score is one half."""
    rows = labelled.sample(docs, labels, label, examples, text_col, id_col)
    terms = labelled.term_classes(rows, t.word_terms).toArrow()  # of at most `examples` texts
    words = terms.column("term").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words = words[order]
    totals = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    lean = leaning(*(terms.column(c).to_numpy()[order] for c in ("positive", "negative")), totals.get(1, 0),
                   sum(v for c, v in totals.items() if c != 1))
    frequency, n = document_frequency(docs, words, text_col) if len(words) else (np.zeros(0), 0)
    idf = np.log((n + 1) / (frequency + 1)) + 1
    counted = labelled.example_counts(rows, words, t.word_terms).toArrow()
    return Index(words, idf * lean, example_rows(counted), np.log((n + 1) / 2) + 1)


def toxicity(docs: DataFrame, index: Index, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: id, held_out, score (0 to 1), predicted (1 from 0.5 on) and evidence, the nearest examples.

    Null and empty texts score as texts without an indexed term. Rows are
    scored one by one by their text alone; other columns are ignored; no rows
    give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    out = labelled.scored(
        docs, lambda texts: shared.value.score(texts),
        "score double, evidence array<struct<id:string,similarity:double,toxic:int>>", text_col, id_col)
    return out.select(id_col, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def clean(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score below one half, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    return labelled.kept(docs, lambda texts: np.asarray(shared.value.score(texts)["score"]) < 0.5, text_col)
