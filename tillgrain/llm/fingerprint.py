"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A document is the multiset of its lines.  Each line is hashed to a wide vector, and the
vectors are added lane by lane: 16 lanes of its SHA-512 modulo 2**32, and 64 lanes that add
a sign per block of up to three words modulo 2**16.  The sum does not depend on the order of
the lines; lines are inserted or deleted by adding or subtracting their vectors.  Documents
with the same lines have the same fingerprint; the sign lanes estimate the likeness of
others (share of common blocks, standard error about 0.1).

A fingerprint is a string of 16 * 8 + 64 * 4 hexadecimal digits.  A null text counts as
empty: one empty line.  Rows that repeat an id follow each other in the order of their
texts' hashes, a null id comes first; rows that repeat id and text are one document in the
order, and each of them is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import texts

STRONG, SIGNS = 16, 64
STRONG_MOD, SIGN_MOD = 1 << 32, 1 << 16        # the powers
BLOCK = r"(?:\S{1,24}\s*){1,3}"      # up to three words; unspaced text goes by 24 characters


def _lane_sums() -> list[Column]:
    """The lanes of the lines of a group, over rows (line_sha, pos, block)."""
    whole = F.coalesce(F.col("pos"), F.lit(0)) == 0          # each line once
    strong = [F.sum(F.when(whole, F.conv(F.substring("line_sha", 8 * i + 1, 8), 16, 10).cast("long"))
                    .otherwise(F.lit(0))).alias(f"s{i}") for i in range(STRONG)]
    sign = F.col("block_hash")
    bits = [F.sum(F.shiftrightunsigned(sign, j).bitwiseAND(F.lit(1))).alias(f"b{j}")
            for j in range(SIGNS)]
    return [*strong, *bits, F.count("block_hash").alias("blocks")]


def _lanes() -> Column:
    signs = [2 * F.col(f"b{j}") - F.col("blocks") for j in range(SIGNS)]
    return F.array(*[F.col(f"s{i}") for i in range(STRONG)],
                   *[F.coalesce(s, F.lit(0).cast("long")) for s in signs])


def _blocks(lines: DataFrame, keep: list[str]) -> DataFrame:
    """One row per block of each `line`, and at least one per line."""
    return lines.withColumn("line_sha", F.sha2("line", 512)).select(
        *keep, "line_sha", F.posexplode_outer(
            F.regexp_extract_all("line", F.lit(BLOCK), F.lit(0))).alias("pos", "block")).select(
        *keep, "line_sha", "pos",
        F.when(F.col("block").isNotNull(), F.xxhash64(F.rtrim("block"))).alias("block_hash"))


def encode(lanes: Column) -> Column:
    """Lanes (16 strong, 64 signed) as the fingerprint string."""
    strong = F.transform(F.slice(lanes, 1, STRONG), lambda x: F.lpad(
        F.lower(F.hex(F.pmod(x, F.lit(STRONG_MOD)))), 8, "0"))
    signs = F.transform(F.slice(lanes, STRONG + 1, SIGNS), lambda x: F.lpad(
        F.lower(F.hex(F.pmod(x, F.lit(SIGN_MOD)))), 4, "0"))
    return F.concat(F.array_join(strong, ""), F.array_join(signs, ""))


def decode(fingerprint: Column) -> Column:
    strong = F.transform(F.sequence(F.lit(0), F.lit(STRONG - 1)), lambda i: F.conv(
        F.substr(fingerprint, 8 * i + 1, F.lit(8)), 16, 10).cast("long"))
    return F.concat(strong, signs_of(fingerprint))


def signs_of(fingerprint: Column) -> Column:
    """The sign lanes, centred around 0."""
    def lane(i):
        x = F.conv(F.substr(fingerprint, 8 * STRONG + 4 * i + 1, F.lit(4)), 16, 10).cast("long")
        return F.when(x >= SIGN_MOD // 2, x - SIGN_MOD).otherwise(x)
    return F.transform(F.sequence(F.lit(0), F.lit(SIGNS - 1)), lane)


def insert(fingerprint: Column, lines: Column) -> Column:
    """The fingerprint of both multisets together."""
    return encode(F.zip_with(decode(fingerprint), decode(lines), lambda a, b: a + b))


def delete(fingerprint: Column, lines: Column) -> Column:
    """The fingerprint without the lines of another one."""
    return encode(F.zip_with(decode(fingerprint), decode(lines), lambda a, b: a - b))


def _alike(equal: Column, a: Column, b: Column) -> Column:
    """Estimated share of common blocks from two arrays of sign lanes."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0),
                           lambda total, part: total + part)
    size = dot(a, a) + dot(b, b)
    share = F.when(size > 0, 2 * dot(a, b) / size).otherwise(F.lit(0.0))
    return F.when(equal, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share (0 to 1) of common blocks of two fingerprints; equal ones give 1."""
    return _alike(a == b, signs_of(a), signs_of(b))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_chars, fingerprint) of every row of (doc_id, text)."""
    rows = texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                              F.length("text").cast("long").alias("n_chars"), "text")
    keep = ["row", "doc_id", "n_chars"]
    lines = rows.select(*keep, F.explode(F.split("text", "\n")).alias("line"))
    return _blocks(lines, keep).groupBy(*keep).agg(*_lane_sums()).select(
        *keep, encode(_lanes()).alias("fingerprint"))


def _key() -> Column:
    """Text that names a distinct (doc_id, hash of the text)."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                       F.col("hash").cast("string"))


def _order(rows: DataFrame) -> DataFrame:
    """For each distinct (doc_id, hash) the key of the next one, and the last one's key and length.

    Ranges are ordered inside by one task each, and among each other by their ends.
    """
    place = F.struct("doc_id", "hash")
    ids = materialize(rows.groupBy("doc_id", "hash").agg(F.max("n_chars").alias("n_chars"))
                      .repartitionByRange("doc_id", "hash").select(
        F.spark_partition_id().alias("part"), place.alias("place"),
        F.struct(_key().alias("key"), "n_chars").alias("item"), "doc_id"), "ids")
    inside = Window.partitionBy("part").orderBy("place")
    across = Window.orderBy("edge_part")           # one row per range
    edges = ids.groupBy(F.col("part").alias("edge_part")).agg(
        F.min_by("item", "place").alias("head"), F.max_by("item", "place").alias("tail")).select(
        "edge_part", F.lead("head").over(across).alias("after"), F.lag("tail").over(across).alias("before"))
    ends = ids.agg(F.min_by("item", "place").alias("lowest"), F.max_by("item", "place").alias("highest"))
    return ids.select("part", F.col("item.key").alias("key"), "doc_id",
                      F.lead("item").over(inside).alias("after_inside"),
                      F.lag("item").over(inside).alias("before_inside")).join(
        F.broadcast(edges), F.col("part") == F.col("edge_part")).crossJoin(F.broadcast(ends)).select(
        "key", "doc_id", F.coalesce("after_inside", "after", "lowest").alias("next"),
        F.coalesce("before_inside", "before", "highest").alias("last")).select(
        "key", "doc_id", F.col("next.key").alias("next_key"), F.col("last.key").alias("last_key"),
        F.expr("last.n_chars div 4").alias("last_quarter"))


def _side(number: int, part: Column, there: Column | None = None) -> Column:
    return F.struct(F.lit(number).alias("side"), part.alias("part"),
                    (F.lit(True) if there is None else there).alias("there"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text, whose last quarter is the next one's beginning.

    The edit is not hashed anew: lines before the cut count for both texts, and only those
    after it are summed for either.  Returns (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next).
    """
    rows = texts(docs).withColumn("hash", F.xxhash64("text"))
    order = materialize(_order(rows.select("doc_id", "hash", F.length("text").cast("long").alias("n_chars"))),
                        "order")
    # Both uses shuffle the same two columns, so the texts are shuffled once.
    placed = rows.select(_key().alias("key"), "text").join(order, "key")
    heads = placed.select(F.col("last_key").alias("key"),
                          F.expr("left(text, last_quarter)").alias("head")).groupBy("key").agg(
        F.first("head").alias("head"))
    keep = ["key", "row", "doc_id", "n_chars", "next_key", "edited_sha256"]
    kept = F.expr("left(text, n_chars - n_chars div 4)")
    cut = placed.join(heads, "key").withColumns({
        "row": F.monotonically_increasing_id(), "n_chars": F.length("text").cast("long")}).withColumn(
        "kept", kept).withColumn(
        "open", F.substring_index("kept", "\n", -1)).withColumn(
        "common", F.expr("length(kept) - length(open)")).select(
        "key", "row", "doc_id", "n_chars", "next_key", F.sha2(F.concat("kept", "head"), 256).alias("edited_sha256"),
        F.explode(F.array(
            _side(0, F.expr("left(text, common - 1)"), F.col("common") > 0),
            _side(1, F.expr("substring(text, common + 1)")),
            _side(2, F.concat("open", "head")))).alias("piece")).filter("piece.there")
    lines = cut.select(*keep, F.col("piece.side").alias("side"),
                       F.explode(F.split("piece.part", "\n")).alias("line"))
    sides = _blocks(lines, [*keep, "side"]).groupBy(*keep, "side").agg(*_lane_sums()).select(
        *keep, F.struct("side", _lanes().alias("lanes")).alias("vector"))

    def total(vectors: Column, other: int) -> Column:
        mine = F.filter(vectors, lambda v: v["side"] != other)
        return F.aggregate(mine, F.array_repeat(F.lit(0).cast("long"), STRONG + SIGNS),
                           lambda s, v: F.zip_with(s, v["lanes"], lambda a, b: a + b))

    def signs(lanes: Column) -> Column:
        return F.slice(lanes, STRONG + 1, SIGNS).cast("array<int>")

    # Stored and shuffled as bytes, half the size of their digits.
    done = materialize(sides.groupBy(*keep).agg(F.collect_list("vector").alias("vectors")).select(
        *keep, total(F.col("vectors"), 2).alias("lanes"), total(F.col("vectors"), 1).alias("edited")).select(
        *keep, F.unhex(encode(F.col("lanes"))).alias("fingerprint"),
        F.unhex(encode(F.col("edited"))).alias("edited_fingerprint"),
        signs(F.col("lanes")).alias("signs"), signs(F.col("edited")).alias("edited_signs")).select(
        *keep, "fingerprint", "edited_fingerprint", "signs", _alike(
            F.col("fingerprint") == F.col("edited_fingerprint"), F.col("signs"),
            F.col("edited_signs")).alias("near_edited")), "fingerprints")
    following = done.groupBy(F.col("key").alias("next_key")).agg(
        F.max(F.struct("fingerprint", "signs")).alias("next"))
    digits = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return done.join(following, "next_key").select(
        "doc_id", "n_chars", "edited_sha256", *digits, "near_edited",
        _alike(F.col("fingerprint") == F.col("next.fingerprint"), F.col("signs"),
               F.col("next.signs")).alias("near_next"))
