"""The pipeline and its stages against plain Python on a small corpus."""

import random

import pytest
from test_dedup import plain_bytes, plain_components
from test_filters import folded_shingles

import corpus_pipeline
from cardspark.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(300)]

    def words(n):
        return rng.choices(vocabulary, k=n)

    rows, labels, passages = [], [], [" ".join(words(60)) for _ in range(3)]
    items = [(i, " ".join(words(30))) for i in range(5)] + [(9, None)]
    for i in range(160):
        text = words(rng.randint(30, 90))
        toxic = i % 4 == 0
        if toxic:
            text[5:5] = [rng.choice(["vileword", "scornword"])] * 2
        if i % 10 == 1:
            text[8:8] = passages[i % 3].split()
        if i % 10 == 3:
            text[2:2] = items[i % 5][1].split()
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    base = words(200)
    for i in range(200, 208):
        base = list(base)
        base[rng.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(base)))
    rows += [(300, rows[1][1]), (301, None), (302, ""), (303, rows[2][1]), (303, rows[2][1]), (304, passages[0])]
    docs = spark.createDataFrame(
        [(i, t, "en", rng.choice(["a", "b", "b", "b", None]), len(t or ""), "x") for i, t in rows], SCHEMA)
    path = tmp_path_factory.mktemp("sf")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_every_stage(spark, folder, tmp_path):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        out = stages[name](spark, docs, path)
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def texts(frame):
        return sorted((r.doc_id, r.text or "") for r in frame.collect())

    docs = run("toxicity", docs)
    want = [(i, t) for i, t in rows if "vileword" not in (t or "") and "scornword" not in (t or "")]
    assert docs.columns == columns and texts(docs) == sorted((i, t or "") for i, t in want)

    docs = run("near_dedup", docs)
    kept = {i for i, (_, _, keep) in plain_components(want, 85).items() if keep}
    want = sorted({(i, t) for i, t in want if i in kept}, key=lambda r: r[0])
    assert docs.columns == columns and texts(docs) == sorted((i, t or "") for i, t in want) and len(kept) < 125

    docs = run("suffix_dedup", docs)
    cut = plain_bytes(want, 50)
    want = [(i, cut[i][2].decode()) for i, _ in want if cut[i][1] == 0 or cut[i][1] < cut[i][0]]
    assert docs.columns == columns and texts(docs) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs = run("decontamination", docs)
    leaked = [folded_shingles(x) for _, x in items if x]
    want = [(i, t) for i, t in want if not any(100 * len(s & folded_shingles(t)) >= 80 * len(s) for s in leaked)]
    assert docs.columns == columns and texts(docs) == sorted(want)

    out = run("mixing", docs)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    assert {r.doc_id: (r.text, r.taken) for r in out.collect()} == {i: (t, taken[i]) for i, t in want if taken[i]}
    total, size = sum(taken.values()), sum(len(t.split()) for _, t in want)
    assert 1.5 * size - 200 <= total <= 1.5 * size
    whole = {r.doc_id: (r.text, r.taken) for r in corpus_pipeline.run(spark, path).collect()}
    assert whole == {r.doc_id: (r.text, r.taken) for r in out.collect()}


def test_stages_on_nothing(spark, folder):
    path, _, _ = folder
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).collect() == [], name


def test_near_copies_from_080(spark, folder):
    """Pairs of similarity 0.80 to 0.85, and chains held together only by such links, at the threshold itself too."""
    rng = random.Random(5)
    path, _, _ = folder
    rows = []
    for i in range(0, 60, 3):
        text = [f"v{rng.randrange(10**6)}" for _ in range(94)]  # 90 shingles
        rows.append((i, " ".join(text)))
        for j in (1, 2):  # two edits far apart change 10 of them: 80 equal of 100 different ones
            text = list(text)
            text[10 * j], text[10 * j + 40] = f"x{i}", f"y{i + j}"
            rows.append((i + j, " ".join(text)))
    want = {i for i, (_, _, keep) in plain_components(rows, 80).items() if keep}
    strict = {i for i, (_, _, keep) in plain_components(rows, 85).items() if keep}
    assert want == set(range(0, 60, 3)) and len(strict) == 60
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), "x") for i, t in rows], SCHEMA)
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, path)
    assert {r.doc_id for r in out.collect()} == want


def test_bands_follow_the_threshold():
    from cardspark.llm import near_dedup
    for percent in (50, 80, 85, 95, 100):
        bands = near_dedup.band_count(percent)
        assert (1 - (percent / 100) ** near_dedup.ROWS) ** bands <= near_dedup.MISS
    assert near_dedup.band_count(85) == 24 and near_dedup.band_count(80) == 36
