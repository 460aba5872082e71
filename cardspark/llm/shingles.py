"""Five-word shingle sets of documents, as sorted distinct fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cardspark.llm import kernels as k

SHINGLE = 5


def shingle_sets(texts: pa.ChunkedArray | pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): document i has the sorted distinct shingles values[first[i]:first[i + 1]].

    Words are lower-cased in A-Z. A text with fewer than `size` words has its
    whole word sequence as one shingle; a text without words has none.
    """
    values, of, n_docs = raw_shingles(texts, size)
    at = np.searchsorted(of, np.arange(n_docs + 1))
    values = values.copy()
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.searchsorted(of[new], np.arange(n_docs + 1))


def raw_shingles(texts: pa.ChunkedArray | pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, int]:
    """(values, document of each, number of documents): all shingles in the order of the text."""
    buf, offsets = k.text_buffer(texts)
    starts, ends, first = k.words(buf, offsets)
    hashes = k.word_hashes(buf, starts, ends, fold=True)
    n_docs = len(offsets) - 1
    windows = k.window_hashes(hashes, size)
    fits = k.valid_starts(first, size, len(windows))
    at = np.flatnonzero(fits)
    values, of = windows[at], np.searchsorted(first, at, "right") - 1
    counts = np.diff(first)
    extra_values, extra_of = [], []
    for n in range(1, size):  # the few texts with exactly n words
        docs = np.flatnonzero(counts == n)
        if len(docs):
            whole = k.window_hashes(hashes, n)[first[docs]]
            extra_values.append(k.pair(whole, np.full(len(docs), n, np.uint64)))
            extra_of.append(docs)
    if extra_of:
        values, of = np.concatenate([values, *extra_values]), np.concatenate([of, *extra_of])
        order = np.argsort(of, kind="stable")
        values, of = values[order], of[order]
    return values, of, n_docs
