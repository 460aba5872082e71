"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

At most `examples` labelled texts are described by TF-IDF over the `vocabulary`
commonest of their terms (words, word shapes, neighbouring shapes, repetition).
A truncated singular value decomposition of that matrix gives the projection to
`rank` latent dimensions. The examples' unit vectors are broadcast; their size
is bounded by `examples` x `rank`. Every document is projected, all cosines with
the examples are computed block by block, and the labels of the nearest are
weighed by similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm import labelled
from cardspark.llm import terms as t

EXAMPLES = 6000
VOCABULARY = 2048
RANK = 48
NEIGHBOURS = 25
THRESHOLD = 0.3
_BLOCK = 256


class Space:
    """The latent space and the labelled vectors in it."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, rows: list[tuple], rank: int = RANK):
        """`rows`: (id, label, term indexes, counts) of each example."""
        self.vocabulary, self.idf = vocabulary, idf
        rows = sorted(rows, key=lambda r: (r[2], r[3], r[1]))
        self.share = sum(r[1] for r in rows) / len(rows) if rows else 0.5
        rows = [r for r in rows if r[2]]
        self.labels = np.array([r[1] for r in rows], np.float32)
        lengths = [len(r[2]) for r in rows]
        doc = np.repeat(np.arange(len(rows)), lengths)
        at = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, np.int64)
        counts = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, np.int64)
        self.projection = np.eye(len(vocabulary), dtype=np.float32)
        gram = np.zeros((len(vocabulary), len(vocabulary)), np.float32)
        for i in range(0, len(rows), 512):
            part = (doc >= i) & (doc < i + 512)
            dense = self._dense(doc[part] - i, at[part], counts[part], min(512, len(rows) - i))
            gram += dense.T @ dense
        _, vectors = np.linalg.eigh(gram) if len(gram) else (None, gram)
        self.projection = np.ascontiguousarray(vectors[:, ::-1][:, :rank])
        self.vectors = self._latent(doc, at, counts, len(rows))

    def _dense(self, doc: np.ndarray, at: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.vocabulary)), np.float32)
        out[doc, at] = (1 + np.log(counts)) * self.idf[at]
        return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)

    def _latent(self, doc: np.ndarray, at: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Unit vectors of n documents; the zero vector without a known term."""
        out = np.zeros((n, self.projection.shape[1]), np.float32)
        for i in range(0, n, _BLOCK):
            a, b = np.searchsorted(doc, [i, i + _BLOCK])
            out[i : i + _BLOCK] = self._dense(doc[a:b] - i, at[a:b], counts[a:b], min(_BLOCK, n - i)) @ self.projection
        return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)

    def score(self, texts: pa.Array) -> dict[str, pa.Array]:
        found, of, n = t.style_terms(texts)
        vectors = self._latent(*t.counted(found, of, self.vocabulary), n)
        scores = np.full(n, self.share, np.float64)
        some = min(NEIGHBOURS, len(self.labels))
        for i in range(0, n if some else 0, _BLOCK):
            cosines = vectors[i : i + _BLOCK] @ self.vectors.T
            near = np.argpartition(-cosines, some - 1, axis=1)[:, :some]
            weights = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** 4
            total = weights.sum(1)
            voted = (weights * self.labels[near]).sum(1) / np.maximum(total, 1e-12)
            scores[i : i + _BLOCK] = np.where(total > 1e-12, voted, self.share)
        return {"score": pa.array(np.clip(scores, 0, 1))}


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text_col: str = "text", id_col: str = "doc_id",
        examples: int = EXAMPLES, vocabulary: int = VOCABULARY, rank: int = RANK) -> Space:
    """The space of the labelled texts; without any, every score is one half."""
    rows = labelled.sample(docs, labels, label, examples, text_col, id_col)
    common = labelled.term_classes(rows, t.style_terms).withColumn("n", F.col("positive") + F.col("negative")).orderBy(
        F.desc("n"), "term").limit(vocabulary).select("term").collect()
    words = np.sort(np.array([r[0] for r in common], np.int64).view(np.uint64))
    frequency, n = labelled.document_frequency(docs, words, t.style_terms, text_col) if len(words) else (np.zeros(0), 0)
    idf = (np.log((n + 1) / (frequency + 1)) + 1).astype(np.float32)
    counted = labelled.example_counts(rows, words, t.style_terms)
    return Space(words, idf, [tuple(r) for r in counted.collect()], rank)  # at most `examples` rows of `vocabulary` terms


def quality(docs: DataFrame, space: Space, text_col: str = "text", id_col: str = "doc_id",
            threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, held_out, score (0 to 1, higher: good quality likelier) and predicted (1 from `threshold` on).

    Null and empty texts, and texts without a known term, score the share of
    good examples. Rows are scored one by one by their text alone; other columns
    are ignored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(space)
    out = labelled.scored(docs, lambda texts: shared.value.score(texts), "score double", text_col, id_col)
    return out.select(id_col, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
