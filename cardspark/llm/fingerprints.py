"""Document fingerprints: a homomorphic multiset hash of the paragraphs.

A text is a multiset of pieces: its sentences and lines, long ones cut every
`PIECE` characters. Every piece is hashed to a wide vector, and the fingerprint
is the sum of the vectors modulo powers of two, so the order of the pieces does
not matter and pieces are inserted or deleted by adding or subtracting vectors.

Lanes, from the first 30 hexadecimal digits of the piece's MD5 read as two
numbers of 60 bits: the number of pieces and the four 30-bit halves, summed
modulo 2^32; and each of the 120 bits, summed modulo 2^16. Bits read as signs
(+1, -1) make the last part a tug-of-war sketch: the squared length of the
difference of two vectors estimates the size of the multiset difference, from
which follows the likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardspark.llm import exchange as ex

PIECE = 160
PATTERN = rf"[^\n.!?]{{1,{PIECE}}}[\n.!?]*|[\n.!?]+"
HALF = 30
_PAIR = (1 << HALF) | 1
_LOW = (1 << HALF) - 1


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def piece_numbers(piece: Column) -> list[Column]:
    """Two numbers of 60 bits from the hash of a piece."""
    digest = F.md5(piece)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]


def summed(rows: DataFrame, keys: list[str], piece: str) -> DataFrame:
    """Per key the vector `lanes`: [pieces, four halves, 60 pairs of bit counts]; null pieces count as none.

    A pair holds two counts in one number, 30 bits apart.
    """
    a, b = piece_numbers(F.col(piece))
    numbered = rows.withColumns({"__a": a, "__b": b})
    low = F.lit(_LOW).cast("long")
    halves = [x for c in ("__a", "__b") for x in (F.shiftright(c, HALF), F.col(c).bitwiseAND(low))]
    pairs = [F.shiftright(c, j).bitwiseAND(F.lit(_PAIR).cast("long")) for c in ("__a", "__b") for j in range(HALF)]
    sums = [F.coalesce(F.sum(x), F.lit(0)).alias(f"__{i}") for i, x in enumerate([*halves, *pairs])]
    grouped = numbered.groupBy(*keys).agg(F.count("__a").alias("__n"), *sums)
    return grouped.select(*keys, F.array("__n", *[f"__{i}" for i in range(len(sums))]).alias("lanes"))


def _both(pair: Column) -> tuple[Column, Column]:
    return F.shiftright(pair, HALF), pair.bitwiseAND(F.lit(_LOW).cast("long"))


def _hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 8, "0"))


def fingerprint(lanes: Column) -> Column:
    """The vector as text: 8 digits for each of the first lanes, 4 for each bit count."""
    def pair(p: Column) -> Column:
        high, low = (x.bitwiseAND(F.lit(0xFFFF).cast("long")) for x in _both(p))
        return _hex(F.shiftleft(high, 16).bitwiseOR(low))
    wide = F.transform(F.slice(lanes, 1, 5), lambda x: _hex(x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))))
    return F.concat(F.array_join(wide, ""), F.array_join(F.transform(F.slice(lanes, 6, 2 * HALF), pair), ""))


def _centred(value: Column) -> Column:
    """The residue modulo 2^16 between -2^15 and 2^15."""
    return F.pmod(value + F.lit(1 << 15), F.lit(1 << 16)) - F.lit(1 << 15)


def _length(lanes: Column, other: Column | None = None) -> Column:
    """Squared length of the sign vector of `lanes`, or of its difference from `other`."""
    count = F.element_at(lanes, 1) - (F.element_at(other, 1) if other is not None else F.lit(0))

    def squares(high: Column, low: Column) -> Column:
        x, y = _centred(2 * high - count), _centred(2 * low - count)
        return x * x + y * y

    def alone(p: Column) -> Column:
        return squares(*_both(p))

    def apart(p: Column, q: Column) -> Column:
        (a, b), (c, d) = _both(p), _both(q)
        return squares(a - c, b - d)

    own = F.slice(lanes, 6, 2 * HALF)
    terms = F.transform(own, alone) if other is None else F.zip_with(own, F.slice(other, 6, 2 * HALF), apart)
    return F.aggregate(terms, F.lit(0).cast("long"), lambda total, x: total + x)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, about the share of common pieces otherwise, from 0 to 1."""
    both = _length(a) + _length(b)
    return F.when(both == 0, F.when(a == b, 1.0).otherwise(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - _length(a, b) / both)))


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_chars, fingerprint) of every text; null texts are empty, and empty texts have the zero vector."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    numbered = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = numbered.select("id", F.length("text").alias("n_chars"), "row", F.explode_outer(pieces(F.col("text"))).alias("piece"))
    return summed(rows, ["id", "n_chars", "row"], "piece").select(
        F.col("id").alias(id_col), "n_chars", fingerprint(F.col("lanes")).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                        chunk_bytes: int = ex.CHUNK_BYTES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    Edited text: the last third of the characters replaced by as many from the
    start of the next document by descending id; the last one's next is the
    first. Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text is empty; a null id counts as the
    largest; rows with equal ids follow each other in the order of a hash of
    their texts; a lone document is its own next. Other columns are ignored; no
    rows give no rows.

    The documents are shuffled once, by ranges of the id; the first document of
    each range goes to the range above as well, so that all neighbours meet.
    """
    base = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    n = ex.chunk_count(base, "text", chunk_bytes)
    ranged = base.select("id", "text", F.xxhash64("text").alias("tie"), ex.range_chunk(base, "id", n))
    tops = ranged.groupBy("chunk").agg(F.max(F.struct(F.col("id").isNull().alias("none"), "id", "tie")).alias("top"))
    up = Window.orderBy("chunk")  # one row per chunk
    guests = tops.select(
        "chunk", F.col("top.id").alias("top_id"), F.col("top.tie").alias("top_tie"),
        F.coalesce(F.lead("chunk").over(up), F.first("chunk").over(up)).alias("visits"))
    same = (ranged["chunk"] == guests["chunk"]) & ranged["id"].eqNullSafe(F.col("top_id")) & (F.col("tie") == F.col("top_tie"))
    placed = ranged.join(F.broadcast(guests), same, "left").select(
        "id", "text", "tie", F.explode(F.array_compact(F.array(
            F.struct(ranged["chunk"].alias("chunk"), F.lit(False).alias("guest")),
            F.when(F.col("visits").isNotNull(), F.struct(F.col("visits").alias("chunk"), F.lit(True).alias("guest"))),
        ))).alias("at")).select("id", "text", "tie", "at.chunk", "at.guest")
    down = Window.partitionBy("chunk").orderBy("guest", F.desc_nulls_first("id"), F.desc("tie"))
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    after = F.lead("text").over(down)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - third), F.substring(F.col("next"), F.lit(1), third))
    both = placed.withColumns({"next": after, "nth": F.row_number().over(down)}).withColumn(
        "edited", F.when(~F.col("guest"), edited))
    rows = both.select(
        "chunk", "nth", "guest", "id", size.alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array_compact(F.array(
            F.struct(F.lit(0).alias("which"), F.col("text").alias("whole")),
            F.when(~F.col("guest"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("whole"))),
        ))).alias("version"))
    keys = ["chunk", "nth", "guest", "id", "n_chars", "edited_sha256", "which"]
    split = rows.select(*keys[:-1], "version.which", F.explode_outer(pieces(F.col("version.whole"))).alias("piece"))
    order = Window.partitionBy("chunk").orderBy("nth", "which")
    lanes = summed(split, keys, "piece").withColumns({
        "edited_lanes": F.lead("lanes", 1).over(order), "next_lanes": F.lead("lanes", 2).over(order)})
    return lanes.filter("which = 0 AND NOT guest").select(
        F.col("id").alias(id_col), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        fingerprint(F.col("lanes")).alias("fingerprint"), fingerprint(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))
