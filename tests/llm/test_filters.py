"""URL filter, classifiers, language, decontamination and mixing against plain Python."""

import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cardspark.llm import decontamination, labelled, language_id, mixing, quality, toxicity, url_filter
from cardspark.llm.queries import URL_RULES
from cardspark.llm.shipping import ship

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, lang string, label int, row string, size string"


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


# --- URL filter


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule_host, rule_path, verdict in URL_RULES:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule_host + rule_path) > len(best[0]):
                best = (rule_host + rule_path, verdict)
    return host, path, best


def test_url_rules(session):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/e", "http://example.net",
            "http://notexample.net/en/", "http://x.org/fr/", "http://x.org/fr", "http://example.com/de/1#/", "http://a.example.com?/de/",
            "ftp://É.ORG/fr/é", "http://x://y.net/", "http://example.com/es/1", "http://example.com/es/1", "a" * 5000 + "://net/"]
    pages = session.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    out = url_filter.filter_urls(pages, URL_RULES).collect()
    assert len(out) == len(urls)
    for r in out:
        host, path, rule = plain_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        assert r.verdict == (rule[1] if rule else r.verdict) and r.verdict in ("allow", "block") and 0 <= r.score <= 1


def test_url_trees_learn_the_rules(session):
    rng = random.Random(3)
    urls = [f"http://s{rng.randrange(999)}.{h}/{p}/{rng.randrange(999)}" for h in ("a.net", "b.org", "example.com")
            for p in ("fr", "en", "de") for _ in range(40)]
    pages = session.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("net", "/", "block"), ("org", "/", "allow")]
    rows = url_filter.filter_urls(pages, rules).filter("rule IS NOT NULL").collect()
    assert all((r.score >= 0.5) == (r.verdict == "block") for r in rows) and len(rows) == 240
    one = url_filter.filter_urls(pages, [("net", "/", "block")])
    assert {r.verdict for r in one.collect()} == {"block"}  # without a counter-example there are no trees
    assert {r.verdict for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).collect() == []


# --- classifiers and language


@pytest.fixture(scope="module")
def corpus(session):
    rng = random.Random(11)
    words = {"en": ["the", "thing", "and", "other", "with"], "fr": ["être", "avec", "eaux", "que", "où"],
             "ru": ["привет", "мир", "это", "как"], "zh": ["你好", "世界", "中文"]}
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(list(words))
        text = " ".join(rng.choices(words[lang], k=rng.randint(20, 60))).split()
        toxic, good = rng.random() < 0.3, rng.random() < 0.6
        if toxic:
            text[3] = rng.choice(["vile", "scornful", "scornfully"])
        if not good:
            text = [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text), "s", lang, 9, "r", "z"))
        labels.append((i, int(good), int(toxic)))
    rows += [(1000, None, "s", "en", 9, "r", "z"), (1001, "", "s", None, 9, "r", "z"), (1002, "12 34 !!", "s", "en", 9, "r", "z"),
             (1003, "the thing " * 20000, "s", "en", 9, "r", "z"), (7, rows[7][1], "s", "en", 9, "r", "z"),
             (None, "vile thing", None, "en", 9, "r", "z"), (1005, "☃ ☃", "s", "en", 9, "r", "z")]
    labels += [(1001, None, None), (None, 1, 1), (5, labels[5][1], labels[5][2]), (5000, 1, 1)]
    return (session.createDataFrame(rows, DOCS).repartition(4),
            session.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity(session, corpus):
    docs, labels = corpus
    index = toxicity.fit(docs, labels)
    out = {(r.doc_id, i): r for i, r in enumerate(toxicity.toxicity(docs, index).collect())}
    assert len(out) == 407
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.predicted == truth[r.doc_id] for r in out.values() if r.doc_id in range(400))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    special = {r.doc_id: r for r in out.values()}
    assert special[None].predicted == 1 and not special[None].held_out and special[None].evidence[0].toxic == 1
    assert special[1000].score == special[1001].score == special[1002].score < 0.5
    kept = toxicity.clean(docs, index)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in out.values())


def test_nearest_examples_are_exact(session, corpus):
    """Block-max search against all similarities."""
    import numpy as np
    rng = np.random.default_rng(2)
    vocabulary = np.sort(rng.integers(0, 1 << 60, 40, np.uint64))
    rows = []
    for i in range(700):
        at = np.sort(rng.choice(40, rng.integers(0, 6), replace=False)).tolist()
        rows.append((i, int(rng.random() < 0.3), at, rng.integers(1, 5, len(at)).tolist()))
    index = toxicity.Index(vocabulary, rng.random(40) + 1, rows)
    for _ in range(60):
        at = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        counts = rng.integers(1, 5, len(at))
        found, sims = index.nearest(at, counts)
        every = index.weights(at, counts).astype(np.float32) @ index.postings[at]
        want = np.sort(every[every > 0])[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose(np.sort(sims)[::-1], want, rtol=1e-5) and np.allclose(every[found], sims, rtol=1e-5)


def test_index_takes_little_more_memory_than_its_lists():
    """The driver builds the index of all examples, so no array beside the lists may hold every posting."""
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(4)
    vocabulary = np.sort(rng.integers(0, 1 << 62, 20_000, np.uint64))
    rows = [(i, i % 2, rng.choice(20_000, 800, replace=False).astype(np.int32), rng.integers(1, 5, 800, np.int32))
            for i in range(2000)]
    tracemalloc.start()
    try:
        index = toxicity.Index(vocabulary, rng.random(20_000) + 1, rows)
        lists = index.postings.example.nbytes + index.postings.weight.nbytes
        assert len(index.postings.weight) == 2000 * 800
        assert tracemalloc.get_traced_memory()[1] < 2.5 * lists + (20 << 20)  # and what finds the terms by their bits
    finally:
        tracemalloc.stop()
    terms = np.arange(0, 20_000, 50)
    dense = index.postings[terms]
    place = {i: e for e, i in enumerate(index.ids)}
    for i, _, at, counts in rows[::100]:
        want = np.zeros(20_000, np.float32)
        want[at] = index.weights(at, counts)
        assert np.array_equal(dense[:, place[i]], want[terms])


def traced(run):
    """(result, bytes held at most meanwhile)."""
    import tracemalloc
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_search_takes_no_rows_of_all_examples():
    """An executor holds the index once for each worker, so a worker may not spread out all its long lists."""
    import pickle

    import numpy as np
    rng = np.random.default_rng(6)
    vocabulary = np.sort(rng.integers(0, 1 << 62, 3000, np.uint64))
    rows = []
    for i in range(3001):
        often, seldom = rng.choice(1500, 150, replace=False), rng.choice(np.arange(1500, 3000), 40, replace=False)
        at = np.sort(np.append(often, seldom)).astype(np.int32)
        rows.append((i, i % 2, at, rng.integers(1, 5, len(at), np.int32)))
    index = pickle.loads(pickle.dumps(toxicity.Index(vocabulary, rng.random(3000) + 1, rows)))
    lists = index.postings
    assert lists.n_long == 1500 and lists.size > 3001
    texts = [(r[2][::3], index.weights(r[2][::3], r[3][::3])) for r in rows[:64]]
    found, most = traced(lambda: index.search(texts))
    assert most < lists.n_long * lists.size * 4 / 2
    dense = lists[np.arange(3000)]
    assert np.array_equal(lists.most, dense[np.argsort(lists.row)[-1500:]].reshape(1500, -1, toxicity.BLOCK).max(2))
    for (at, w), (near, sims) in zip(texts, found, strict=True):
        every = w.astype(np.float32) @ dense[at]
        assert np.allclose(np.sort(sims)[::-1], np.sort(every)[::-1][: toxicity.NEIGHBOURS], rtol=1e-5)
        assert np.allclose(every[near], sims, rtol=1e-5)


def test_terms_of_few_texts_at_a_time():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(5000)])
    texts = pa.array([" ".join(rng.choice(words, 800)) for _ in range(900)] + [None, "", "..."])
    found, of, _ = toxicity.t.word_terms(texts.slice(0, 40))
    vocabulary = np.unique(found)
    doc, at, counts = toxicity.Vocabulary(vocabulary).counted(found, of)
    rows = [(i, i % 2, at[doc == i], counts[doc == i]) for i in range(40)]
    index = toxicity.Index(vocabulary, np.ones(len(vocabulary)), rows, 1.0)
    index.score(texts.slice(0, 3))
    whole, most = traced(lambda: index.score(texts))
    assert texts.nbytes > 3 << 20 and most < 10 * texts.nbytes
    ones = [index.score(texts.slice(i, 1)) for i in [*range(0, 900, 90), 900, 901, 902]]
    assert [w.as_py() for w in whole["score"].take(pa.array([*range(0, 900, 90), 900, 901, 902]))] == pytest.approx(
        [o["score"][0].as_py() for o in ones], rel=1e-6)


def test_example_rows_of_several_batches():
    import pyarrow as pa
    kind = pa.schema([("row", pa.int64()), ("label", pa.int32()), ("at", pa.list_(pa.int32())), ("count", pa.list_(pa.int32()))])
    rows = [(4, 1, [2, 5], [1, 3]), (5, 0, [], []), (6, None, [0], [2]), (7, 1, [], []), (8, 0, [1, 2, 3], [4, 4, 1])]
    whole = pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], kind)
    table = pa.concat_tables([whole.slice(0, 0), whole.slice(1, 3), whole.slice(0, 1), whole.slice(4)])
    found = [(i, c, at.tolist(), counts.tolist()) for i, c, at, counts in toxicity.example_rows(table)]
    assert found == [*rows[1:4], rows[0], rows[4]] and toxicity.example_rows(whole.slice(0, 0)) == []


def test_every_term_is_indexed(session):
    """Copies of toxic examples whose words no other example has; one listed word in a long clean text."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:240]
    texts = {i: " ".join([*rng.choices(words, k=30), *([f"insult{i}x"] if n < 40 else [])]) for n, i in enumerate(ids)}
    toxic = set(ids[:40])
    labels = [(i, int(i in toxic)) for i in ids]
    for i in [i for i in range(1000, 1020) if zlib.crc32(str(i).encode()) % 5][:5]:
        texts[i] = "vile"
        labels.append((i, 1))
    copies = {5000 + i: texts[i] for i in ids}
    long = {9000: " ".join([*rng.choices(words, k=400), "vile"])}
    docs = session.createDataFrame(list({**texts, **copies, **long}.items()), "doc_id long, text string").repartition(3)
    index = toxicity.fit(docs, session.createDataFrame(labels, "doc_id long, toxic int"))
    out = {r.doc_id: r for r in toxicity.toxicity(docs, index).collect()}
    for i in ids:
        near = out[5000 + i].evidence[0]
        assert (near.id, near.toxic) == (str(i), int(i in toxic)) and abs(near.similarity - 1) < 1e-5
        assert out[5000 + i].predicted == int(i in toxic)
    assert all(e.similarity < 0.9 for e in out[9000].evidence)


def test_quality(corpus):
    docs, labels = corpus
    out = quality.quality(docs, quality.fit(docs, labels)).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    known = [r for r in out if r.doc_id in range(400)]
    assert len(out) == 407 and sum(r.predicted == truth[r.doc_id] for r in known) >= 0.98 * len(known)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert len({r.score for r in out if r.doc_id in (1000, 1001)}) == 1


def test_classifiers_without_labels_or_documents(corpus):
    docs, labels = corpus
    index, space = toxicity.fit(docs, labels.limit(0)), quality.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.toxicity(docs, index).collect()} == {0.5}
    assert {r.score for r in quality.quality(docs, space).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []
    assert quality.quality(docs.limit(0), quality.fit(docs.limit(0), labels)).collect() == []


def test_language(corpus):
    docs, _ = corpus
    model = language_id.learn(docs.filter(~labelled.held_out("doc_id", 3, 1)))
    out = language_id.identify(docs, model, folds=(3, 1)).join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert all(r.lang_pred == r.truth for r in out if r.doc_id < 400)
    special = {r.doc_id: r for r in out}
    assert [special[i].lang_pred for i in (1000, 1001, 1002, 1005)] == ["und"] * 4 and special[1003].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in out)
    nothing = language_id.learn(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).collect() == []


def test_spans_of_mixed_text_and_viterbi_by_brute_force(session, corpus):
    import itertools

    import numpy as np
    import pyarrow as pa
    docs, _ = corpus
    model = language_id.learn(docs)
    text = " ".join(["the thing and other with"] * 5 + ["привет мир это"] * 5 + ["the thing and other"] * 6)
    got = model.predict(pa.array([text]))
    spans = [(s["start"], s["end"], s["lang"]) for s in got["spans"][0].as_py()]
    assert spans == [(0, 25, "en"), (25, 40, "ru"), (40, 64, "en")]
    rng = random.Random(4)
    vocabulary = ["the", "être", "eaux", "мир", "thing", "que"]
    texts = [" ".join(rng.choices(vocabulary, k=n)) for n in (1, 2, 5, 6, 6)]
    words = language_id._Words(pa.array(texts))
    scores = model._word_scores(words)
    label = model._paths(scores, words)
    for doc in range(len(texts)):
        own = scores[words.number[words.of == doc]]

        def value(path):
            return sum(own[i, p] for i, p in enumerate(path)) - language_id.SWITCH * sum(
                a != b for a, b in zip(path, path[1:], strict=False))
        best = max(value(p) for p in itertools.product(range(len(model.langs)), repeat=len(own)))
        assert np.isclose(value(label[words.of == doc].tolist()), best, rtol=1e-4)


# --- decontamination


def folded_shingles(text):
    w = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_contained_items(session, block):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate([1, 3, 5, 6, 9, 10, 14, 25, 40, 57, 57])]
    items += [(50, None), (51, ""), (52, items[5][1]), (5, items[6][1])]
    rows = [(0, None), (1, ""), (2, "w1"), (3, items[1][1].upper()), (4, " ".join(words * 300))]
    for i in range(80):
        text = rng.choices(words, k=rng.randint(0, 80))
        item = rng.choice(items[2:11])[1].split()
        for _ in range(rng.randint(0, 3)):
            item[rng.randrange(len(item))] = "edited"
        at = rng.randint(0, len(text))
        rows.append((10 + i, "  ".join(text[:at] + item + text[at:])))
    docs = session.createDataFrame([(i, t, 1, "q") for i, t in rows], "doc_id long, text string, doc int, item string").repartition(3)
    bench = session.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = []
    for i, t in rows:
        for j, x in items:
            a, b = folded_shingles(x), folded_shingles(t)
            if a and 100 * len(a & b) >= 80 * len(a):
                want.append((i, j, len(a), len(a & b)))
    got = decontamination.contained_items(docs, bench, block_bytes=block)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 20
    clean = decontamination.decontaminated(docs, bench, block_bytes=block)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted({i for i, _ in rows} - {w[0] for w in want})
    assert decontamination.contained_items(docs, bench.limit(0)).collect() == []
    assert decontamination.contained_items(docs.limit(0), bench).collect() == []


# --- mixing


def plain_targets(sizes, weights, share, most):
    """Exact water filling; sizes by source in order."""
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(sizes)}
    budget = Fraction(share) * sum(sizes.values())
    stopped = set()
    while True:
        rest = [s for s in sizes if s not in stopped]
        if not rest:
            return {s: Fraction(most * sizes[s]) for s in sizes}
        rate = (budget - sum(most * sizes[s] for s in stopped)) / sum(weight[s] for s in rest)
        over = [s for s in rest if rate * weight[s] > most * sizes[s]]
        if not over:
            return {s: Fraction(most * sizes[s]) if s in stopped else rate * weight[s] for s in sizes}
        stopped |= set(over)


@pytest.mark.parametrize("range_rows", [50_000, 5])
def test_mix(session, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "_RANGE_ROWS", range_rows)
    rng = random.Random(6)
    rows = []
    for i in range(300):
        source = rng.choices(["a", "B", "é", "zz", None, "hot"], [1, 3, 2, 1, 2, 9])[0]
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 40])), source, "l", 1, "r", "s"))
    rows += [(900, None, "a", "l", 1, "r", "s"), (901, "", "only empty", "l", 1, "r", "s"), (902, "w " * 3000, "hot", "l", 1, "r", "s")]
    docs = session.createDataFrame(rows, DOCS).repartition(3)
    out = mixing.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "lang", "label", "row", "size", "source_size", "target", "taken"]
    got = out.collect()
    size = {r[0]: len(SPACE.findall(r[1] or "")) for r in rows}
    names = sorted({r[2] for r in rows if r[2]}, key=lambda s: s.encode()) + [None]
    sizes = {s: sum(size[r[0]] for r in rows if r[2] == s) for s in names}
    target = plain_targets(sizes, [5, 2, 1], Fraction(3, 2), 2)
    assert len(got) == len(rows)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(target[r.source])) and r.taken in (0, r.size, 2 * r.size)
    total = sum(r.taken for r in got)
    assert total <= 1.5 * sum(size.values()) and total >= 1.5 * sum(size.values()) - max(size.values())
    for s in names:
        taken = sum(r.taken for r in got if r.source == s)
        assert abs(taken - target[s]) <= max([r.size for r in got if r.source == s] + [max(size.values())])
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(5)).collect()}


def test_mix_of_nothing_and_of_repeated_rows(session):
    docs = session.createDataFrame([], DOCS)
    assert mixing.mix(docs).collect() == []
    docs = session.createDataFrame([(1, "a b", "s", "l", 1, "r", "s")] * 4 + [(None, "a", None, "l", 1, "r", "s")] * 2, DOCS)
    assert len(mixing.mix(docs).collect()) == 6
    empty = session.createDataFrame([(1, "", "s", "l", 1, "r", "s")], DOCS)
    assert [r.taken for r in mixing.mix(empty).collect()] == [0]
