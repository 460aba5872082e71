"""Duplicate operators against plain Python."""

import hashlib
import random
import re

import pytest

from cardspark.llm import fingerprints, near_dedup, substring_dedup, suffix_dedup
from cardspark.llm.shipping import ship

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, chunk string, level int, node string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ß€", "日本", "𝄞"]
    passages = [" ".join(rng.choices(vocabulary, k=n)) for n in (12, 40, 60)]
    out = [None, "", "  \n ", "one two", "One TWO", "one two", "a " * 90, "a " * 91, "é" * 130, "é" * 120]
    for _ in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 2)):
            parts.append(rng.choice(passages))
            parts.append(" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))))
        out.append(rng.choice(["  ", "\n", " \x0b"]).join(parts))
    base = rng.choices(vocabulary, k=150)
    for i in range(12):  # near copies of near copies
        base = list(base)
        base[rng.randrange(len(base))] = f"edit{i}"
        out.append(" ".join(base))
    rows = list(enumerate(out))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    # extra columns named like internal ones
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_windows(texts, size):
    words = {i: SPACE.findall(t or "") for i, t in texts}
    starts = {}
    for i, w in words.items():
        for p in range(len(w) - size + 1):
            starts.setdefault(tuple(w[p : p + size]), []).append((i, p))
    gone = {i: set() for i in words}
    for places in starts.values():
        if len(places) > 1:
            for i, p in places:
                gone[i].update(range(p, p + size))
    return {i: (len(w), len(gone[i]), " ".join(x for p, x in enumerate(w) if p not in gone[i])) for i, w in words.items()}


@pytest.mark.parametrize(("size", "chunk"), [(35, 1 << 20), (35, 700), (8, 900), (1, 2000), (2, 2000)])
def test_word_windows(docs, texts, size, chunk):
    out = substring_dedup.substring_dedup(docs, size=size, chunk_bytes=chunk).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in out}
    assert got == plain_windows(texts, size)
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in out)


def plain_bytes(texts, size):
    data = {i: (t or "").encode() for i, t in texts}
    first = {}
    for i in sorted(data):
        for p in range(len(data[i]) - size + 1):
            first.setdefault(data[i][p : p + size], i)
    out = {}
    for i, b in data.items():
        gone = set()
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] < i:
                gone.update(range(p, p + size))
        out[i] = (len(b), len(gone), bytes(x for p, x in enumerate(b) if p not in gone))
    return out


@pytest.mark.parametrize(("size", "sample", "chunk"), [(50, 24, 1 << 20), (50, 24, 700), (20, 8, 600), (9, 9, 1500)])
def test_bytes_of_earlier_documents(docs, texts, size, sample, chunk):
    out = suffix_dedup.suffix_dedup(docs, size=size, sample=sample, chunk_bytes=chunk).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in out} == plain_bytes(texts, size)


def test_cut_at_characters_with_the_other_columns(docs, texts):
    out = suffix_dedup.suffix_dedup(docs, chunk_bytes=700, characters=True, rest=True).collect()
    assert all(bytes(r.kept).decode() is not None and tuple(r.rest) == ("x", 1, "y") for r in out)
    assert len(out) == len(texts)


def test_ids_that_repeat_or_are_null(spark):
    long = "abcdefghij" * 7
    rows = [(1, long), (1, long), (None, long), (None, long + "z"), (2, long)]
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=100)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in out.collect())
    assert got == [(False, 1, 0), (False, 1, 0), (False, 2, 70), (True, 0, 70), (True, 0, 70)]
    out = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in out.collect()} >= {(1, 1), (2, 1)}


def plain_components(texts, percent):
    sets = {}
    for i, t in texts:
        w = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("chunk", [1 << 20, 1500])
def test_near_copies(docs, texts, chunk):
    out = near_dedup.near_dedup(docs, chunk_bytes=chunk).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == plain_components(texts, 85)


def test_blocks_of_a_large_band(spark, docs, texts):
    """Bands far above the block size give the same components."""
    from pyspark.sql import functions as F

    base = docs.select(F.col("doc_id").alias("__row"), F.col("text").alias("__text"), F.lit(0).cast("long").alias("chunk"))
    signed = base.groupBy("chunk").applyInArrow(
        near_dedup.ex.on_group(near_dedup._sign), near_dedup._SIGNED.format(id="bigint"))
    nodes = signed.filter("n > 0").withColumnRenamed("__row", "node").select("node", "n", "m", "sketch", "bands")
    found = near_dedup.linked_components(nodes, docs.select(F.col("doc_id").alias("node"), "text"), 3, block=2)
    want = {i: c for i, (n, c, _) in plain_components(texts, 85).items() if c != i}
    assert {r.node: r.component for r in found.collect()} == want


def plain_lanes(text):
    lanes = [0] * (5 + 120)
    for piece in re.findall(fingerprints.PATTERN, text):
        h = hashlib.md5(piece.encode()).hexdigest()
        a, b = int(h[:15], 16), int(h[15:30], 16)
        for i, x in enumerate([1, a >> 30, a & (1 << 30) - 1, b >> 30, b & (1 << 30) - 1]):
            lanes[i] += x
        for j in range(60):
            lanes[5 + j] += a >> j & 1
            lanes[65 + j] += b >> j & 1
    return lanes


def plain_print(lanes):
    def at(word, j):
        return lanes[5 + 60 * word + j] % 65536
    wide = "".join(f"{x % 2**32:08x}" for x in lanes[:5])
    return wide + "".join(f"{at(w, j + 30):04x}{at(w, j):04x}" for w in (0, 1) for j in range(30))


@pytest.mark.parametrize("chunk", [1 << 20, 900])
def test_fingerprints(docs, texts, chunk):
    by_id = dict(texts)
    order = sorted(by_id, reverse=True)
    out = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs, chunk_bytes=chunk).collect()}
    assert len(out) == len(by_id)
    for at, i in enumerate(order):
        text, after = by_id[i] or "", by_id[order[(at + 1) % len(order)]] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert out[i].n_chars == len(text)
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i].fingerprint == plain_print(plain_lanes(text))
        assert out[i].edited_fingerprint == plain_print(plain_lanes(edited))
        assert 0 <= out[i].near_edited <= 1
        assert (out[i].near_next == 1) == (sorted(re.findall(fingerprints.PATTERN, text)) == sorted(
            re.findall(fingerprints.PATTERN, after)))
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert plain == {i: r.fingerprint for i, r in out.items()}


def test_empty_tables(empty):
    assert substring_dedup.substring_dedup(empty).collect() == []
    assert suffix_dedup.suffix_dedup(empty).collect() == []
    assert near_dedup.near_dedup(empty).collect() == []
    assert fingerprints.edited_fingerprints(empty).collect() == []


def test_index_family_grows_geometrically():
    import numpy as np

    family = suffix_dedup.Family()
    for i in range(64):
        batch = np.arange(i * 10, i * 10 + 10, dtype=np.uint64)
        assert not family.scan(batch).any()
        family.add(batch)
    assert len(family.levels) <= 2
    assert family.scan(np.array([0, 639, 640], np.uint64)).tolist() == [True, True, False]
