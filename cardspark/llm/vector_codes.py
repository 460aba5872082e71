"""Product codes of vectors: per-part codebooks refined by rounds of nearest-entry assignment (Orchard's search).

A vector of integers is cut into `PARTS` equal consecutive parts; each part
position has its own codebook of at most `ENTRIES` entries. A round assigns
every part to its nearest entry and replaces each entry by the componentwise
floor of the mean of its parts. The codebooks are the only state that moves
between the driver and the executors: PARTS x ENTRIES x part width integers,
bounded by the parameters and not by the rows.

Nearest entries are found by Orchard's search: every entry keeps the list of
all entries sorted by their distance to it. A search starts at an entry c,
walks c's list and jumps to the first entry that is nearer to the query,
marking every entry it has measured. The walk of a list ends at the first
entry that lies more than twice the current distance away from c: by the
triangle inequality no entry beyond can be nearer than c. Distances are
squared Euclidean on integers, so the result is exact, ties included (the
lower index wins; every tied entry lies inside the final radius and is seen).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256


def integer_vectors(rows: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id",
                    label_col: str = "label") -> DataFrame:
    """(vec_id, label, v): rows whose vector is whole and finite, each component as floor(SCALE * x).

    Dropped: a null vector, a null component, NaN or an infinity. Other columns
    are not carried, so clashing names do not matter.
    """
    v = F.col(vector_col)
    whole = (v.isNotNull()
             & (F.size(F.filter(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))) == 0))
    label = F.col(label_col) if label_col in rows.columns else F.lit(None)
    return rows.filter(whole).select(
        F.col(id_col).alias("vec_id"), label.alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE)))).alias("v"))


def initial_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[np.ndarray, int]:
    """Codebooks from the `entries` smallest vec_ids (ascending; nulls last, equal ids by vector).

    Returns (codebooks of shape parts x k x width, dimension); k is below
    `entries` only when fewer rows are kept. Vectors are zero-padded to a
    multiple of `parts`; rows whose length differs from the first row's are
    left out of everything (see `encode`).
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), F.col("v")).limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), dtype=np.int64), 0
    dim = len(first[0].v)
    width = -(-dim // parts) if dim else 0
    rows = [r.v for r in first if len(r.v) == dim]
    books = np.zeros((len(rows), parts * width), dtype=np.int64)
    if dim:
        books[:, :dim] = np.array(rows, dtype=np.int64)
    return books.reshape(len(rows), parts, width).transpose(1, 0, 2).copy(), dim


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between the entries of one codebook and, per entry, all entries sorted by distance (then index)."""
    diff = book[:, None, :] - book[None, :, :]
    between = (diff * diff).sum(axis=2)
    k = len(book)
    order = np.lexsort((np.broadcast_to(np.arange(k), (k, k)), between), axis=1)
    return between, order


def orchard(queries: np.ndarray, book: np.ndarray, between: np.ndarray, order: np.ndarray,
            start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: lower index) and its squared distance for every query row, by Orchard's search.

    All queries walk at once: each step takes the next entry of the list of
    the query's current entry, skips it if measured, stops the query when the
    entry lies beyond twice the current distance (4x in squares), and jumps
    when it is nearer.
    """
    n, k = len(queries), len(book)
    if n == 0 or k == 0:
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    cur = np.zeros(n, dtype=np.int64) if start is None else start.astype(np.int64)
    diff = queries - book[cur]
    best = (diff * diff).sum(axis=1)
    seen = np.zeros((n, k), dtype=bool)
    seen[np.arange(n), cur] = True
    pos = np.zeros(n, dtype=np.int64)
    live = np.arange(n)
    while len(live):
        c, p = cur[live], pos[live]
        ended = p >= k
        e = order[c, np.minimum(p, k - 1)]
        ended |= between[c, e] > 4 * best[live]
        live, c, e = live[~ended], c[~ended], e[~ended]
        fresh = ~seen[live, e]
        pos[live[~fresh]] += 1
        live_f, c_f, e_f = live[fresh], c[fresh], e[fresh]
        seen[live_f, e_f] = True
        d = queries[live_f] - book[e_f]
        de = (d * d).sum(axis=1)
        better = (de < best[live_f]) | ((de == best[live_f]) & (e_f < c_f))
        moved = live_f[better]
        cur[moved], best[moved], pos[moved] = e_f[better], de[better], 0
        pos[live_f[~better]] += 1
    return cur, best


def _parts(values: pd.Series, dim: int, parts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = values.map(len).to_numpy()
    ok = lengths == dim
    flat = np.zeros((len(values), parts * width), dtype=np.int64)
    if ok.any() and dim:
        flat[ok, :dim] = np.stack(values[ok].to_numpy()).astype(np.int64)
    return flat.reshape(len(values), parts, width), ok


def _assign(frame: pd.DataFrame, books: np.ndarray, lists: list, dim: int) -> tuple[np.ndarray, ...]:
    parts, _, width = books.shape
    q, ok = _parts(frame["v"], dim, parts, width)
    codes = np.zeros((len(frame), parts), dtype=np.int64)
    dist = np.zeros((len(frame), parts), dtype=np.int64)
    for p in range(parts):
        codes[:, p], dist[:, p] = orchard(q[:, p, :], books[p], *lists[p])
    return q, codes, dist, ok


def round_sums(vectors: DataFrame, books: np.ndarray, dim: int) -> np.ndarray:
    """One round: every part to its nearest entry; entries become floor(sum / count) of their parts; unused stay."""
    parts, k, width = books.shape
    lists = [neighbour_lists(books[p]) for p in range(parts)]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((parts, k, width), dtype=np.int64)
        counts = np.zeros((parts, k), dtype=np.int64)
        for frame in frames:
            q, codes, _, ok = _assign(frame, books, lists, dim)
            for p in range(parts):
                np.add.at(sums[p], codes[ok, p], q[ok, p, :])
                np.add.at(counts[p], codes[ok, p], 1)
        used = np.argwhere(counts > 0)
        if len(used) == 0:
            return
        yield pd.DataFrame({"part": used[:, 0], "entry": used[:, 1], "n": counts[used[:, 0], used[:, 1]],
                            "s": [sums[p, e].tolist() for p, e in used]})

    # one row per used (part, entry) and task, summed on Spark: bounded by tasks x parts x entries
    rows = (vectors.select("v").mapInPandas(partial, "part int, entry int, n long, s array<long>")
            .select("part", "entry", "n", F.posexplode("s").alias("j", "x"))
            .groupBy("part", "entry", "j").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
            .collect())
    out = books.copy()
    for r in rows:
        out[r.part, r.entry, r.j] = r.x // r.n  # Python floor division: floors toward minus infinity
    return out


def fit(vectors: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> tuple[np.ndarray, int]:
    """Codebooks after `rounds` rounds, and the dimension of the vectors."""
    books, dim = initial_codebooks(vectors, parts, entries)
    if books.shape[1] == 0:
        return books, dim
    for _ in range(rounds):
        books = round_sums(vectors, books, dim)
    return books, dim


def codebooks_sha256(books: np.ndarray) -> str:
    """sha256 of all entries' integer components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, dim: int) -> DataFrame:
    """(vec_id, label, code, error) of every kept vector: final assignment of each part.

    code: two lowercase hex digits per part, in part order; error: squared
    distances summed over parts. Rows whose length differs from the
    dimension of the codebooks get a null code and error.
    """
    parts, k, width = books.shape
    lists = [neighbour_lists(books[p]) for p in range(parts)] if k else []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if k == 0:
                yield pd.DataFrame({"vec_id": frame["vec_id"], "label": frame["label"], "code": None, "error": None})
                continue
            _, codes, dist, ok = _assign(frame, books, lists, dim)
            code = ["".join(f"{c:02x}" for c in row) for row in codes]
            yield pd.DataFrame({
                "vec_id": frame["vec_id"], "label": frame["label"],
                "code": pd.Series(code, dtype=object).where(ok, None),
                "error": pd.Series(dist.sum(axis=1), dtype="Int64").where(ok, None)})

    return vectors.mapInPandas(run, "vec_id long, label int, code string, error long")


def compress(rows: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label",
             rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> DataFrame:
    """Codes of all whole vectors of `rows`, with errors, errors per label and the codebooks' digest.

    Returns vec_id, label, code, error, label_error (error summed over rows of
    an equal label, nulls together) and codebooks_sha256 (same in every row).
    Empty input: no rows. Fewer than `entries` kept rows: codebooks of that
    many entries. Repeated rows are encoded once each and count in every sum.
    """
    vectors = integer_vectors(rows, vector_col, id_col, label_col)
    books, dim = fit(vectors, rounds, parts, entries)
    digest = codebooks_sha256(books)
    coded = encode(vectors, books, dim)
    # sums per label are pre-aggregated before the shuffle; one row per label joins back (broadcast by AQE when small)
    per_label = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(per_label, F.col("label").eqNullSafe(F.col("__label")), "left")
            .select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))

