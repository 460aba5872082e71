"""Packing: pieces against the tokenizer itself, a valid gapless plan, as few sequences as best fit."""

import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from cardspark.llm import packing
from cardspark.llm.shipping import ship

DOCS = "doc_id long, text string, length string, sequence_id int"


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def plain_pieces(docs, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text, *_ in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            chunk = ids[s:s + capacity]
            out.append((doc_id, k, s, len(chunk), zlib.crc32(np.asarray(chunk, dtype="<u4").tobytes())))
    return sorted(out, key=repr)


def valid(rows, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_seq.values():
        placed.sort()
        at = 0
        for offset, length in placed:
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_pack_equals_tokenizer_and_is_valid(session):
    rng = random.Random(1)
    words = ["alpha", "beta", "Gamma", "déjà", "x", "1234", "hello,", "world."]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 700))) for _ in range(60)]
    texts += [None, "", "   ", "long " * 9000]
    docs = [(i, t, "clash", 7) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1), (None, "null id", None, None)]
    out = packing.pack(session.createDataFrame(docs, DOCS), capacity=512).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == plain_pieces(docs, 512)
    n = valid(out, 512)
    total = sum(r.length for r in out)
    hist = {}
    for r in out:
        hist[r.length] = hist.get(r.length, 0) + 1
    assert -(-total // 512) <= n <= sum(k for _, k in packing.best_fit(hist, 512))


@pytest.mark.parametrize("seed", range(5))
def test_plan_holds_every_piece_once(seed):
    rng = random.Random(seed)
    hist = {}
    for _ in range(rng.randrange(1, 3000)):
        length = rng.choice([rng.randrange(1, 4097), 4096, rng.randrange(1, 200), rng.randrange(1900, 2200)])
        hist[length] = hist.get(length, 0) + 1
    groups = packing.plan(hist)
    placed = {}
    for lengths, n in groups:
        assert sum(lengths) <= 4096 and n > 0
        for x in lengths:
            placed[x] = placed.get(x, 0) + n
    assert placed == hist
    bins = sum(n for _, n in groups)
    assert bins <= sum(n for _, n in packing.best_fit(hist))
    runs = packing.intervals(groups)
    assert sum(n for *_, n, _, _ in [(r[0], r[1], r[2], r[3], r[4]) for r in runs]) == sum(len(g) * n for g, n in groups)


def test_empty_table(session):
    assert packing.pack(session.createDataFrame([], DOCS)).count() == 0


def test_piece_ids_equal_the_tokenizer_on_any_text():
    rng = random.Random(4)
    alphabet = "aZ0 _-'sΣσİıǅ²½Ⅻ\t\n\x1c 　漢é́ﬁ.,!?"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 80))) for _ in range(400)]
    texts += ["ΣΑΣ don't 'S", None, ""]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    flat, offsets = packing.PieceIds("word_bpe_49k.json").ids(texts)
    for k, t in enumerate(texts):
        assert flat[offsets[k]:offsets[k + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids, repr(t)
