"""MinHash near-dedup with odd sketches.

1. Every document gets the fingerprint of its shingle set, MinHash bands, and
   an odd sketch: the smallest shingle of each of `BINS` hash ranges is a
   MinHash sample, and each sample flips one bit of a bitmap. The XOR of two
   bitmaps is the bitmap of the samples that differ, and its population count
   tells how many do, most exactly where few do. A second bitmap tells which
   ranges are occupied.
2. Equal sets are one node, whatever their number.
3. Nodes that share a band are candidates. Each is compared with the smallest
   node of each of its bands by sketch; the likeliest hub and the smallest one
   are confirmed on the full sets. Confirmed links give components.
4. In a band whose members are still in several components, pairs across the
   components are looked for by sketch, every pair of them once: the members
   outside the band's largest component against all, in blocks. Pairs whose
   sketches allow a link are confirmed, best first, in rounds of growing size,
   and pairs that have become connected meanwhile are left out.

Pairs inside a component are never listed, so a group of n copies costs about n
links. A pair is lost only if no band meets, or if its sketch errs by more than
`SIGMAS` standard deviations (docstring of `near_dedup`).
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.llm import exchange as ex
from cardspark.llm import kernels as k
from cardspark.llm.shingles import shingle_sets
from cardspark.operators.components import components
from cardspark.session import written

PERCENT = 85
ROWS = 5
MISS = 8e-7  # probability that no band of a pair at the threshold meets
BINS = 1024
BITS = 1024
WORDS = (BITS + BINS) // 64
SIGMAS = 4.0
BLOCK = 4096
_SIGNED_ROWS = 2048  # texts signed at a time, so that many short ones take no more memory than a few long ones


def band_count(percent: int, rows: int = ROWS) -> int:
    """Fewest bands of `rows` that miss a pair of similarity `percent` / 100 with a probability of at most `MISS`."""
    meets = (percent / 100) ** rows
    return 1 if meets >= 1 else math.ceil(math.log(MISS) / math.log1p(-meets))


@lru_cache
def _multipliers(n: int) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(7))
    return random.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(texts: pa.ChunkedArray | pa.Array, bands: int, rows: int = ROWS) -> dict[str, np.ndarray]:
    """n, f1, f2 (set fingerprint), m (samples), sketch (odd and occupied bits as uint64 words) and bands of each text."""
    values, first = shingle_sets(texts)
    n_docs = len(first) - 1
    n = np.diff(first)
    full = np.flatnonzero(n)
    at = first[:-1][full]
    f1, f2 = np.zeros(n_docs, np.uint64), np.zeros(n_docs, np.uint64)
    keys = np.zeros((n_docs, bands), np.uint64)
    m = np.zeros(n_docs, np.int64)
    sketch = np.zeros((n_docs, WORDS), np.uint64)
    if len(full):
        f1[full] = np.add.reduceat(k.mix(values), at)
        f2[full] = np.add.reduceat(k.mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
        multipliers = _multipliers(bands * rows)
        for band in range(bands):
            key = np.full(len(full), band, np.uint64)
            for row in range(rows):
                key = k.pair(key, np.minimum.reduceat(values * multipliers[band * rows + row], at))
            keys[full, band] = key
        of = np.repeat(np.arange(n_docs), n)
        bins = (values >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)
        least = np.ones(len(values), bool)  # sorted by document and value: the first of each bin is its smallest
        least[1:] = (bins[1:] != bins[:-1]) | (of[1:] != of[:-1])
        doc = of[least]
        m = np.bincount(doc, minlength=n_docs)
        bit = (k.mix(values[least] + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)).astype(np.int64)
        odd = np.bincount(doc * BITS + bit, minlength=n_docs * BITS) & 1
        sketch[:, : BITS // 64] = np.packbits(odd.astype(bool), bitorder="little").view("<u8").reshape(n_docs, -1)
        there = np.zeros(n_docs * BINS, bool)
        there[doc * BINS + bins[least]] = True
        sketch[:, BITS // 64 :] = np.packbits(there, bitorder="little").view("<u8").reshape(n_docs, -1)
    return {"n": n, "f1": f1, "f2": f2, "m": m, "sketch": sketch, "bands": keys}


_SIGNED = ("__row {id}, chunk long, n long, f1 long, f2 long, m int, sketch array<long>, bands array<long>")


def _longs(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(matrix).reshape(-1).view(np.int64))
    return pa.FixedSizeListArray.from_arrays(flat, matrix.shape[1]).cast(pa.list_(pa.int64()))


def _sign(docs: pa.Table, percent: int = PERCENT) -> pa.Table:
    parts = [docs.slice(i, _SIGNED_ROWS) for i in range(0, max(1, docs.num_rows), _SIGNED_ROWS)]
    return pa.concat_tables([_sign_part(p, band_count(percent)) for p in parts])


def _sign_part(docs: pa.Table, bands: int) -> pa.Table:
    s = signatures(docs.column("__text"), bands)
    return pa.table({
        "__row": docs.column("__row"), "chunk": docs.column("chunk"),
        "n": pa.array(s["n"], pa.int64()), "f1": pa.array(s["f1"].view(np.int64)), "f2": pa.array(s["f2"].view(np.int64)),
        "m": pa.array(s["m"], pa.int32()), "sketch": _longs(s["sketch"]), "bands": _longs(s["bands"]),
    })


def differing(flipped: np.ndarray) -> np.ndarray:
    """Estimated number of differing samples, from the set bits of the XOR of two odd sketches."""
    open_share = np.maximum(1 - 2 * flipped / BITS, 1 / BITS)
    return -BITS / 2 * np.log(open_share)


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m_a: np.ndarray, m_b: np.ndarray,
             percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(whether the sketches `a` and `b` allow a similarity of `percent`, estimated equal samples), row by row."""
    t, odd = percent / 100, BITS // 64
    flipped = np.bitwise_count(a[:, :odd] ^ b[:, :odd]).sum(1, dtype=np.int64)
    bins = np.bitwise_count(a[:, odd:] | b[:, odd:]).sum(1, dtype=np.int64)
    equal = (m_a + m_b - differing(flipped)) / 2
    # at the threshold: the occupied ranges are a sample of the union, drawn without replacement
    union = np.maximum((n_a + n_b) / (1 + t), bins)
    sampling = bins * t * (1 - t) * (union - bins) / np.maximum(union - 1, 1)
    d = 2 * bins * (1 - t)
    two, four = np.exp(d * np.log1p(-2 / BITS)), np.exp(d * np.log1p(-4 / BITS))
    read = np.maximum(BITS / 4 * (1 - four) + BITS**2 / 4 * (four - two**2), 0) / (4 * two**2)
    return equal >= t * bins - SIGMAS * np.sqrt(sampling + read) - 0.5, equal


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _matrix(rows: pa.Table, name: str) -> np.ndarray:
    """A column of equally long arrays of longs as a matrix."""
    return rows.column(name).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1)


def _sketch_test(pairs: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    return may_link(_matrix(pairs, "sketch_a"), _matrix(pairs, "sketch_b"),
                    *[_column(pairs, c) for c in ("n_a", "n_b", "m_a", "m_b")], percent)


def _confirm_batch(batch: pa.Table, percent: int) -> np.ndarray:
    a, at_a = shingle_sets(batch.column("text_a"))
    b, at_b = shingle_sets(batch.column("text_b"))
    out = np.zeros(batch.num_rows, bool)
    for i in range(batch.num_rows):
        left, right = a[at_a[i] : at_a[i + 1]], b[at_b[i] : at_b[i + 1]]
        same = len(np.intersect1d(left, right, assume_unique=True))
        out[i] = 0 < 100 * same >= percent * (len(left) + len(right) - same)
    return out


def _filter(test: object) -> object:
    """mapInArrow function that keeps the (a, b) of the rows passing `test`, with its second result as score."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                t = pa.Table.from_batches([batch.slice(start, 512)])
                passed, score = test(t)
                yield from pa.table(
                    {"a": t.column("a"), "b": t.column("b"), "score": pa.array(score, pa.float64())}, schema=schema
                ).filter(pa.array(passed)).to_batches()
    return run


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, score) of the pairs whose sketches allow a link."""
    side = nodes.select("node", "n", "m", "sketch")
    for s in ("a", "b"):
        pairs = pairs.join(side.toDF(s, *[f"{c}_{s}" for c in ("n", "m", "sketch")]), s)
    return pairs.mapInArrow(_filter(lambda t: _sketch_test(t, percent)), "a long, b long, score double")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have a Jaccard similarity of `percent` or more."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    there = texts.join(wanted, "node", "left_semi")
    for s in ("a", "b"):
        pairs = pairs.join(there.toDF(s, f"text_{s}"), s)

    def test(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        links = _confirm_batch(t, percent)
        return links, np.ones(len(links))
    return pairs.mapInArrow(_filter(test), "a long, b long, score double").select("a", "b")


def _across(cells: pa.Table, percent: int, low: int, high: int) -> pa.Table:
    """Likely pairs of unconnected nodes, those ranked low <= rank < high for the asking node.

    A pair that shares several bands is looked at in the first. If pairs of
    higher rank remain, a row (-1, -1) tells so.
    """
    cells = cells.sort_by([("key", "ascending"), ("x", "ascending"), ("q", "ascending"), ("target", "ascending"),
                           ("node", "ascending")])
    key, block, ask, node, start, now, band, n, m = (
        _column(cells, c) for c in ("key", "x", "q", "node", "start", "now", "band", "n", "m"))
    target, asking = (cells.column(c).to_numpy(zero_copy_only=False) for c in ("target", "asking"))
    sketch, bands = _matrix(cells, "sketch"), _matrix(cells, "bands")
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (ask[1:] != ask[:-1])
    edges = np.append(np.flatnonzero(new), len(key)).tolist()
    out: list[tuple[np.ndarray, np.ndarray]] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    more = False

    def flush() -> None:
        nonlocal more
        if not waiting:
            return
        q, x = (np.concatenate(side) for side in zip(*waiting, strict=True))
        waiting.clear()
        # a pair of two asking nodes is looked at from the larger one
        fit = np.flatnonzero((start[q] != start[x]) & ~(asking[x] & (node[x] >= node[q])))
        q, x = q[fit], x[fit]
        found = [(q[:0], x[:0], np.zeros(0))]
        for i in range(0, len(q), 1 << 14):
            a, b = q[i : i + (1 << 14)], x[i : i + (1 << 14)]
            before = np.arange(bands.shape[1])[None, :] < band[a][:, None]
            first = ~((bands[a] == bands[b]) & before).any(1)
            a, b = a[first], b[first]
            ok, equal = may_link(sketch[a], sketch[b], n[a], n[b], m[a], m[b], percent)
            found.append((a[ok], b[ok], equal[ok]))
        q, x, equal = (np.concatenate(part) for part in zip(*found, strict=True))
        order = np.lexsort((node[x], -equal, q))
        q, x = q[order], x[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        apart = now[q] != now[x]
        more = more or bool((apart & (rank >= high)).any())
        keep = apart & (rank >= low) & (rank < high)
        out.append((q[keep], x[keep]))

    held = 0
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        middle = a + int(np.searchsorted(target[a:b], True))
        askers, targets = np.arange(a, middle), np.arange(middle, b)
        step = max(1, (1 << 19) // max(1, len(targets)))
        for i in range(0, len(askers), step):
            some = askers[i : i + step]
            waiting.append((np.repeat(some, len(targets)), np.tile(targets, len(some))))
            held += len(some) * len(targets)
            if held >= 1 << 19:
                flush()
                held = 0
    flush()
    q = np.concatenate([np.zeros(0, np.int64), *[o[0] for o in out]])
    x = np.concatenate([np.zeros(0, np.int64), *[o[1] for o in out]])
    last = [-1] if more else []
    return pa.table({
        "a": pa.array(np.append(np.minimum(node[q], node[x]), last).astype(np.int64)),
        "b": pa.array(np.append(np.maximum(node[q], node[x]), last).astype(np.int64)),
    })


def _component_of(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes that are not the smallest of their component."""
    return components(edges.select(F.col("b").alias("hi"), F.col("a").alias("lo")))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """`found` after components are joined by further links."""
    ends = _placed(_placed(links, "a", found, "ca"), "b", found, "cb").filter("ca <> cb").select(
        F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
    up = written(_component_of(ends.distinct()), "joined")
    moved = found.join(up.toDF("component", "above"), "component", "left").select(
        "node", F.coalesce("above", "component").alias("component"))
    return written(moved.unionByName(up), "found")


def _placed(frame: DataFrame, node: str, found: DataFrame, name: str) -> DataFrame:
    return frame.join(found.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(
        name, F.coalesce(name, node))


def _blocks(count: Column, block: int) -> Column:
    return F.ceil(count / F.lit(block)).cast("int")


def linked_components(nodes: DataFrame, texts: DataFrame, n_tasks: int, percent: int = PERCENT,
                      block: int = BLOCK) -> DataFrame:
    """(node, component) for all nodes that are not the smallest of their component.

    `nodes` has node, n, m, sketch, bands; `texts` has node, text. The search
    across components is dealt to `n_tasks` groups of cells; a cell holds at most
    about `block` asking and `block` other members of a band.
    """
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = members.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    meeting = written(members.join(hubs, "key"), "bands")
    star = meeting.filter("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    likely = _likely(star, nodes, percent)
    chosen = likely.groupBy("b").agg(F.min("a").alias("a"), F.max_by("a", F.struct("score", -F.col("a"))).alias("best"))
    first = chosen.select(F.explode(F.array_distinct(F.array("a", "best"))).alias("a"), "b")
    tried = written(first, "pairs")
    links = written(confirmed(tried, texts, percent), "links")
    found = written(_component_of(links), "found")

    # members of the bands that hold several components, with the component they start from
    placed = _placed(meeting, "node", found, "start")
    shares = placed.groupBy("key", "start").agg(F.count("*").alias("share"))
    mixed = shares.groupBy("key").agg(
        F.max_by("start", F.struct("share", -F.col("start"))).alias("main"), F.count("*").alias("parts"),
        F.max("share").alias("main_share")).filter("parts > 1")
    asks = F.col("start") != F.col("main")
    blocks, ask_blocks = _blocks(F.col("size"), block), _blocks(F.col("size") - F.col("main_share"), block)
    hashed = F.xxhash64("node")
    as_target = F.transform(F.sequence(F.lit(0), ask_blocks - 1), lambda q: F.struct(
        F.lit(True).alias("target"), F.pmod(hashed, blocks).cast("int").alias("x"), q.alias("q")))
    as_asker = F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.struct(
        F.lit(False).alias("target"), x.alias("x"), F.pmod(hashed, ask_blocks).cast("int").alias("q")))
    cells = placed.join(mixed, "key").select(
        "key", "band", "node", "start", asks.alias("asking"),
        F.explode(F.when(asks, F.concat(as_target, as_asker)).otherwise(as_target)).alias("at"),
    ).select("key", "band", "node", "start", "asking", "at.target", "at.x", "at.q")
    cells = written(cells.join(nodes, "node").withColumn(
        "task", F.pmod(F.xxhash64("key", "x", "q"), F.lit(n_tasks))), "cells")
    low, high, more = 0, 3, not cells.isEmpty()
    while more:
        now = _placed(cells, "start", found, "now")
        pairs = written(now.groupBy("task").applyInArrow(
            ex.on_group(_across, percent=percent, low=low, high=high), "a long, b long").distinct(), "across")
        more = not pairs.filter("a < 0").isEmpty()
        links = written(confirmed(pairs.filter("a >= 0").join(tried, ["a", "b"], "left_anti"), texts, percent), "links")
        if not links.isEmpty():
            found = _merged(found, links)
        low, high = high, 8 * high
    return found


def near_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", percent: int = PERCENT,
               chunk_bytes: int = ex.CHUNK_BYTES) -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable over links) and kept.

    Documents are linked if their sets of distinct five-word shingles, of words
    lower-cased in A-Z, have a Jaccard similarity of `percent` / 100 or more. A
    text with fewer than five words has its word sequence as its only shingle;
    a null text or one without words has none and is linked with nothing. Rows
    with the same id count as one document that is linked as either is. A null
    id is never the id of a component of others. Other columns are ignored; no
    rows give no rows.

    Candidate bands, as many as `percent` needs, miss a pair at the threshold
    with probability `MISS` at most, and less above it: 24 bands of 5 at 0.85,
    36 at 0.80. The sketch test errs by more
    than 4 standard deviations for about 3 pairs in 100,000 at the threshold.
    """
    chunks = ex.chunk_count(docs, text_col, chunk_bytes)
    base = docs.select(F.col(f"`{id_col}`").alias("__row"), F.col(f"`{text_col}`").alias("__text"))
    kind = base.schema[0].dataType.simpleString()
    signed = written(
        base.select("*", ex.hashed_chunk(chunks, "__row", "__text")).groupBy("chunk").applyInArrow(
            ex.on_group(_sign, percent=percent), _SIGNED.format(id=kind)), "signed")
    sets = signed.filter(F.col("n") > 0)
    firsts = sets.groupBy("f1", "f2").agg(F.min("__row").cast("long").alias("node")).filter("node IS NOT NULL")
    nodes = written(
        firsts.join(sets.withColumn("node", F.col("__row").cast("long")).drop("__row"), ["node", "f1", "f2"])
        .dropDuplicates(["node"]).select("node", "n", "m", "sketch", "bands"), "nodes")
    texts = base.select(F.col("__row").cast("long").alias("node"), F.col("__text").alias("text"))
    found = linked_components(nodes, texts, chunks, percent)
    labels = _placed(firsts, "node", found, "component").select("f1", "f2", "component")
    label = F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("__row").cast("long"))
    return signed.select("__row", "n", "f1", "f2").join(labels, ["f1", "f2"], "left").select(
        F.col("__row").alias(id_col), F.col("n").alias("n_shingles"), label.alias("component_id"),
        F.col("__row").eqNullSafe(label).alias("kept"))
