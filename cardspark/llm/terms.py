"""Terms of documents for the classifiers, as fingerprints in text order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cardspark.llm import kernels as k

PREFIX = 5

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

# byte classes for word shapes: letters by case, digits, and every other character as itself
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = ord("a")
_SHAPE[48:58] = ord("0")
_SHAPE[128:] = ord("a")


def runs_of(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of the maximal runs of flagged bytes within documents."""
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_terms(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """(terms, document of each, number of documents): words, and the first five bytes of longer words.

    A word is a run of ASCII letters and digits and bytes beyond ASCII, A-Z read as a-z.
    """
    buf, offsets = k.text_buffer(texts)
    starts, ends, of = runs_of(buf, offsets, _WORD[buf])
    whole = k.word_hashes(buf, starts, ends, fold=True)
    long = ends - starts > PREFIX
    heads = k.word_hashes(buf, starts[long], starts[long] + PREFIX, fold=True)
    heads = k.pair(heads, np.full(len(heads), PREFIX, np.uint64))
    return np.concatenate([whole, heads]), np.concatenate([of, of[long]]), len(offsets) - 1


def style_terms(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Words, their shapes, pairs of neighbouring shapes, and whether a word repeats its predecessor.

    A word is a run of bytes other than white space. Its shape has one character
    for each run of capitals, of other letters, of digits or of one other byte.
    """
    buf, offsets = k.text_buffer(texts)
    starts, ends, first = k.words(buf, offsets)
    of = np.searchsorted(first, np.arange(len(starts)), "right") - 1
    if len(starts) == 0:
        return np.zeros(0, np.uint64), of, len(offsets) - 1
    shaped = _SHAPE[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = shaped[1:] != shaped[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shapes = k.word_hashes(shaped[keep], at[starts], at[ends])
    whole = k.word_hashes(buf, starts, ends, fold=True)
    next_to = of[1:] == of[:-1]
    pairs = k.pair(shapes[:-1], shapes[1:])[next_to]
    again = (whole[1:] == whole[:-1]) & next_to
    repeated = np.full(int(again.sum()), 0x5EED, np.uint64)
    tagged = k.mix(shapes + np.uint64(1))
    return (np.concatenate([whole, tagged, pairs, repeated]),
            np.concatenate([of, of, of[1:][next_to], of[1:][again]]), len(offsets) - 1)


def counted(terms: np.ndarray, of: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, index in the sorted vocabulary, count) for the terms that are in it, by document."""
    if len(vocabulary) == 0 or len(terms) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    known = vocabulary[at] == terms
    joint, counts = np.unique(of[known] * len(vocabulary) + at[known], return_counts=True)
    return joint // len(vocabulary), joint % len(vocabulary), counts


def distinct(terms: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each term of a document once."""
    order = np.lexsort((terms, of))
    terms, of = terms[order], of[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (of[1:] != of[:-1])
    return terms[new], of[new]


def slices(texts: pa.Array, limit: int = 4 << 20):
    """Row ranges of about `limit` bytes of text."""
    offsets = k.text_buffer(texts)[1]
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(end, len(texts))
        at = end
