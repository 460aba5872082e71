"""Filter audit: carry-save counts against a plain count, the whole audit against plain Python."""

import itertools
import random
import re

import numpy as np
import pytest

from cardspark.llm import filter_audit as fa
from cardspark.llm.shipping import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, part string, h int"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


@pytest.mark.parametrize("seed", range(4))
def test_carry_save_equals_plain_popcount(seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, 1 << 32, size=int(rng.integers(0, 3000)), dtype=np.uint64).astype(np.uint32)
    weights = rng.integers(1, 1 << int(rng.integers(1, 40)), size=len(words))
    want = [sum(int(w) for x, w in zip(words, weights) if (int(x) >> s) & 1) for s in range(32)]
    assert fa.carry_save_counts(words, weights).tolist() == want


def plain_audit(docs, labels):
    def fails(d):
        t = d[1] or ""
        w = WORD.findall(t)
        f = (len(w) < 50) | (100 * len(set(w)) < 65 * len(w)) << 1
        f |= (100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)) << 2 | bool(re.search("[#$%&*|]", t)) << 3
        ids = [e[0] for e in docs if (e[1] or "") == t]
        smaller = any(i is not None and (d[0] is None or i < d[0]) for i in ids)
        return f | smaller << 4

    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    rows = [(d[2] or "", fails(d), d[0] in good, d[0] in toxic) for d in docs]
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for perm in itertools.permutations(range(5)):
            order = "".join("ABCDE"[i] for i in perm)
            before = 0
            for step, i in enumerate(perm, 1):
                after = before | 1 << i
                removed = [r for r in mine if r[1] & before == 0 and r[1] & after]
                out[(part, order, step)] = dict(
                    kept=sum(r[1] & after == 0 for r in mine), removed=len(removed),
                    redundant=sum(bool(r[1] >> i & 1) and r[1] & before != 0 for r in mine),
                    unique_fails=sum(r[1] == 1 << i for r in mine),
                    good_lost=sum(r[2] for r in removed), toxic_lost=sum(r[3] for r in removed), letter="ABCDE"[i])
                before = after
        for letter in "ABCDE":
            total = sum(v["removed"] for k, v in out.items() if k[0] == part and v["letter"] == letter)
            for k, v in out.items():
                if k[0] == part and v["letter"] == letter:
                    v["shapley"] = total
    return out


def test_audit_equals_plain_python(session):
    rng = random.Random(5)
    vocab = ["a", "b", "Cc", "DD", "e#", "f", "g", "h|", "ij", "k"] + [f"w{i}" for i in range(80)]
    texts = [" ".join(rng.choice(vocab[:n]) for _ in range(rng.randrange(0, 120))) for n in (5, 30, 90) for _ in range(12)]
    texts += [None, "", "  \t\n", "x" * 100000, "É" * 60 + " A" * 60, " ".join(f"u{i}" for i in range(60))]
    docs = [(i, t, rng.choice(["s1", "s2", None]), "p", 0) for i, t in enumerate(texts)]
    docs += [docs[3], (None, texts[3], "s1", "p", 0), (None, "lone", None, "p", 0), (100, texts[5], "s2", "p", 0),
             (2, texts[0], "s1", "p", 0), (101, None, "s1", "p", 0)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 40, 2)] + [(4, 1, 1), (None, 1, 1)]
    got = fa.audit(session.createDataFrame(docs, DOCS), session.createDataFrame(labels, LABELS)).collect()
    want = plain_audit(docs, labels)
    assert len(got) == len(want) == 3 * 600
    for r in got:
        w = want[(r.part, r.filter_order, r.step)]
        assert {k: r[k] for k in w if k != "letter"} == {k: v for k, v in w.items() if k != "letter"}


def test_empty_table(session):
    out = fa.audit(session.createDataFrame([], DOCS), session.createDataFrame([], LABELS))
    assert out.count() == 0
