"""Product codes: Orchard's search against all distances, rounds against plain numpy, edge rows."""

import math

import numpy as np
import pytest

from cardspark.llm import vector_codes as vc
from cardspark.llm.shipping import ship

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def brute(q, book):
    d = ((q[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)  # argmin: first (lowest) index among ties


@pytest.mark.parametrize("seed", range(6))
def test_orchard_equals_all_distances(seed):
    rng = np.random.default_rng(seed)
    book = rng.integers(-4, 5, size=(64, 3))  # small range: many equal entries and tied distances
    book[10] = book[3]
    q = rng.integers(-6, 7, size=(2000, 3))
    lists = vc.neighbour_lists(book)
    for start in (None, rng.integers(0, 64, size=2000)):
        code, dist = vc.orchard(q, book, *lists, start=start)
        want_code, want_dist = brute(q, book)
        assert (dist == want_dist).all() and (code == want_code).all()


def plain(rows, rounds=2, parts=16, entries=64):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    x = np.array([[math.floor(np.float32(c) * 256) for c in v] for _, v, _ in kept], dtype=np.int64)
    width = x.shape[1] // parts
    xs = x.reshape(len(x), parts, width)
    books = xs[:entries].transpose(1, 0, 2).copy()
    for _ in range(rounds + 1):
        codes = np.stack([brute(xs[:, p], books[p])[0] for p in range(parts)], axis=1)
        if _ == rounds:
            break
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = xs[codes[:, p] == e, p]
                if len(mine):
                    books[p, e] = np.floor_divide(mine.sum(axis=0), len(mine))
    err = sum(((xs[:, p] - books[p][codes[:, p]]) ** 2).sum(axis=1) for p in range(parts))
    return kept, codes, err, books


def test_compress_equals_plain_numpy(session):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(v) for v in rng.normal(0, 0.2, 32).astype(np.float32)], int(i % 3) if i % 5 else None)
            for i in rng.permutation(300)]
    rows += [(5, rows[0][1], 1), (None, rows[1][1], 2)]  # a repeated id and a null id
    rows += [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [1.0] * 31 + [None], 1), (903, [float("inf")] * 32, 1)]
    out = vc.compress(session.createDataFrame(rows, SCHEMA)).collect()
    kept, codes, err, books = plain(rows)
    assert len(out) == len(kept)
    want = sorted(((r[0], "".join(f"{c:02x}" for c in code), int(e)) for r, code, e in zip(kept, codes, err)), key=repr)
    assert sorted(((r.vec_id, r.code, r.error) for r in out), key=repr) == want
    assert {r.codebooks_sha256 for r in out} == {vc.codebooks_sha256(books)}
    by_label = {}
    for r in out:
        by_label[r.label] = by_label.get(r.label, 0) + r.error
    assert all(r.label_error == by_label[r.label] for r in out)


def test_edge_tables(session):
    empty = session.createDataFrame([], SCHEMA)
    assert vc.compress(empty).count() == 0
    nothing_kept = session.createDataFrame([(1, None, 1), (2, [float("nan")] * 16, None)], SCHEMA)
    assert vc.compress(nothing_kept).count() == 0
    few = session.createDataFrame([(i, [float(i) / 64] * 16, None) for i in range(3)] + [(1, [0.0] * 16, None)], SCHEMA)
    out = vc.compress(few).collect()
    assert len(out) == 4 and all(len(r.code) == 32 for r in out) and all(r.error >= 0 for r in out)
    clash = session.createDataFrame([(1, [0.5] * 16, 1, "x", 3)], SCHEMA + ", v string, code int")
    assert vc.compress(clash).select("vec_id", "code", "error").collect()[0].error == 0
