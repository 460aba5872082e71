"""Questions from chunks of documents to hash buckets, and the answers back.

A chunk is a bounded part of the documents. Each chunk sends every bucket one
row: the sorted distinct fingerprints that fall in the bucket's range. Having
met a fingerprint several times, a chunk sends it once, so a passage that a
third of all documents share costs one entry per chunk. The bucket answers
each row with one bit per entry and question, in the order of the entries;
the chunk finds its entries again from its text. Documents never travel to a
bucket, and positions never leave their chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
_ROW_BYTES = 64  # what a document counts beside its text

SENT = "chunk long, level int, bucket long, entries binary"
ANSWERS = "chunk long, level int, bucket long, bits binary"
SENT_SCHEMA = pa.schema([("chunk", pa.int64()), ("level", pa.int32()), ("bucket", pa.int64()), ("entries", pa.binary())])
ANSWER_SCHEMA = pa.schema([("chunk", pa.int64()), ("level", pa.int32()), ("bucket", pa.int64()), ("bits", pa.binary())])


def on_group(f: Callable[..., pa.Table], **fixed: object) -> Callable[[pa.Table], pa.Table]:
    """`f` with fixed arguments, in the form that applyInArrow of a grouping takes."""
    def run(rows: pa.Table) -> pa.Table:
        return f(rows, **fixed)
    return run


def on_pair(f: Callable[..., pa.Table], **fixed: object) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for the grouping of two frames."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return f(left, right, **fixed)
    return run


def chunk_count(docs: DataFrame, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> int:
    """How many chunks of about `chunk_bytes` the measured size of the texts makes."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(_ROW_BYTES))).first()[0] or 0
    return max(1, -(-size // chunk_bytes))


def hashed_chunk(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).alias("chunk")


def range_chunk(docs: DataFrame, column: str, n: int) -> Column:
    """Chunk number by ranges of `column`: every value of a chunk is below those of the next chunk.

    The bounds are quantiles from one aggregation, at most n longs; a row finds
    its range by binary search. Nulls go to the last chunk.
    """
    shares = [i / n for i in range(1, n)]
    bounds = sorted(set(docs.agg(
        F.percentile_approx(column, shares, max(1000, 20 * n)).alias("b")).first()[0] or [])) if shares else []
    if not bounds:
        return F.lit(0).cast("long").alias("chunk")
    table = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    low = F.lit(0)
    search = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), low,
        lambda at, s: F.when((at + s <= len(bounds)) & (F.try_element_at(table, at + s) < F.col(column)), at + s)
        .otherwise(at),
    )
    return F.coalesce(search, F.lit(len(bounds))).cast("long").alias("chunk")


def send(chunk: int, level: int, keys: np.ndarray, n_buckets: int, *payload: np.ndarray) -> list[tuple]:
    """Rows for the sorted distinct uint64 `keys`, cut where the bucket ranges end."""
    cuts = np.searchsorted(keys, bucket_starts(n_buckets))
    cuts = np.append(cuts, len(keys))
    return [
        (chunk, level, b, b"".join(x[cuts[b] : cuts[b + 1]].tobytes() for x in (keys, *payload)))
        for b in np.flatnonzero(np.diff(cuts)).tolist()
    ]


def bucket_starts(n: int) -> np.ndarray:
    """First key of each of n equal ranges of the 64-bit keys."""
    return np.array([(b << 64) // n for b in range(n)], np.uint64)


def sent_table(rows: list[tuple]) -> pa.Table:
    return _table(rows, SENT_SCHEMA)


def answer_table(rows: list[tuple]) -> pa.Table:
    return _table(rows, ANSWER_SCHEMA)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def entry_parts(table: pa.Table, width: int = 1) -> list[tuple[int, int, tuple[np.ndarray, ...]]]:
    """(chunk, level, arrays) of each row of a bucket, by ascending chunk."""
    out = []
    for chunk, level, data in zip(*(table.column(c).to_pylist() for c in ("chunk", "level", "entries")), strict=True):
        flat = np.frombuffer(data, np.uint64)
        n = len(flat) // width
        out.append((chunk, level, tuple(flat[i * n : (i + 1) * n] for i in range(width))))
    return sorted(out, key=lambda x: x[0])


def received(answers: pa.Table, level: int, n_bits: int, counts: np.ndarray) -> list[np.ndarray]:
    """The answers to the entries sent at `level`, one flag array per question.

    `counts` has the number of entries sent to each bucket.
    """
    levels = np.asarray(answers.column("level"))
    buckets = np.asarray(answers.column("bucket"))
    bits = answers.column("bits")
    at = np.concatenate([[0], np.cumsum(counts)])
    out = [np.zeros(at[-1], bool) for _ in range(n_bits)]
    for i in np.flatnonzero(levels == level).tolist():
        b = int(buckets[i])
        n = int(counts[b])
        flags = np.unpackbits(np.frombuffer(bits[i].as_py(), np.uint8), count=n_bits * n).astype(bool)
        for k in range(n_bits):
            out[k][at[b] : at[b] + n] = flags[k * n : (k + 1) * n]
    return out


def entry_counts(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return np.diff(np.append(np.searchsorted(keys, bucket_starts(n_buckets)), len(keys)))


def packed(*flags: np.ndarray) -> bytes:
    return np.packbits(np.concatenate(flags)).tobytes()
