"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

HOT_SHARE = 500      # a key is hot when it holds more than 1/500 of the rows
SPREAD = 4096        # slots over which the rows of hot keys are spread
BROADCAST_ROWS = 50_000   # lookups up to this (counted) size are broadcast whole, narrow ones up to as many bytes
ROW_BYTES = 2_500         # of a row when they are counted
PACKED_BYTES = 2_600      # of keys and values, for each of `BROADCAST_ROWS`, of a lookup that is sent packed
PACK = 32                 # keys of a packed row
SIEVE_WORDS = 2 ** 20     # rows of 64 bits of a sieve


def broadcast_rows(lookup: DataFrame) -> int:
    """How many rows of these columns are small enough to be sent to every executor."""
    width = 16 + sum(24 if kind in ("string", "binary") else 8 for _, kind in lookup.dtypes)
    return BROADCAST_ROWS * max(1, ROW_BYTES // width)


def _packed(lookup: DataFrame, key: str, payload: list[str], slots: int) -> DataFrame | None:
    """A lookup as `slots` rows of about `PACK` hashed keys with their values; None where two keys share a hash.

    So a key takes 8 bytes and 8 for each value, without a row of its own.
    """
    hashed = lookup.filter(F.col(f"`{key}`").isNotNull()).select(
        F.xxhash64(F.col(f"`{key}`").cast("string")).alias("h"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(payload)])
    packed = hashed.groupBy(F.pmod("h", F.lit(slots)).alias("_slot")).agg(
        F.collect_list(F.struct("h", *[f"v{i}" for i in range(len(payload))])).alias("_e"))
    packed = materialize(packed.select("_slot", F.col("_e.h").alias("_h"), *[
        F.col(f"_e.v{i}").alias(f"_v{i}") for i in range(len(payload))]), "packed")
    shared = packed.filter(F.size(F.array_distinct("_h")) < F.size("_h"))
    return None if not shared.isEmpty() else packed


def attach_whole(rows: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """`attach` where `lookup` has a row for every key that `rows` hold.

    Then a key is known by its hash, as long as no two keys share one, and numbers of millions of keys are small
    enough to be broadcast, packed; the rows are not shuffled.  Beyond that, it is `attach`.
    """
    payload = [c for c in lookup.columns if c not in (key, weight)]
    kinds = dict(lookup.dtypes)
    numbers = all(kinds[c] in ("double", "float", "bigint", "int", "date", "timestamp") for c in payload)
    n = lookup.count()
    if (n <= broadcast_rows(lookup.drop(weight)) or not numbers
            or 8 * n * (1 + len(payload)) > PACKED_BYTES * BROADCAST_ROWS):
        return attach(rows, lookup, key, weight)
    slots = max(1, math.ceil(n / PACK))
    packed = _packed(lookup, key, payload, slots)
    if packed is None:
        return attach(rows, lookup, key, weight)
    hashed = F.when(F.col(f"`{key}`").isNotNull(), F.xxhash64(F.col(f"`{key}`").cast("string")))
    joined = rows.withColumn("_hash", hashed).withColumn("_at", F.pmod("_hash", F.lit(slots))).join(
        F.broadcast(packed), F.col("_at") == F.col("_slot"), "left")
    place = F.array_position("_h", F.col("_hash")) - 1
    return joined.withColumn("_place", place.cast("int")).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        *[F.get(f"_v{i}", F.col("_place")).alias(c) for i, c in enumerate(payload)])


def sieved(rows: DataFrame, wanted: DataFrame, key: list[Column], wanted_key: list[Column]) -> DataFrame:
    """Rows whose key is among the wanted ones, and few others: a filter that is broadcast, of bounded size.

    The hashes of the wanted keys set bits; a row whose bit is not set has no wanted key.
    """
    def word(h):
        return F.pmod(F.shiftrightunsigned(h, 6), F.lit(SIEVE_WORDS))

    bits = wanted.select(F.xxhash64(*wanted_key).alias("h")).groupBy(word(F.col("h")).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("_bits"))
    hashed = rows.withColumn("_h", F.xxhash64(*key)).withColumn("_at", word(F.col("_h")))
    found = hashed.join(F.broadcast(materialize(bits, "sieve")), F.col("_at") == F.col("_word"))
    return found.filter(F.expr("shiftrightunsigned(_bits, cast(_h & 63 as int)) & 1 = 1")).select(
        *[F.col(f"`{c}`") for c in rows.columns])


def attach(rows: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """Left join of per-key columns onto rows, safe against hot keys.

    `lookup` is a stored table with one row per `key`; `weight` is its column with
    the number of rows of that key.  A lookup of few rows is counted and broadcast.
    Beyond that, fewer than `HOT_SHARE` keys can hold more than
    1/HOT_SHARE of the rows, so the hot part is broadcast whatever the data size.
    All other rows meet their key in an ordinary equi-join, where the rows of hot
    keys carry a spread slot and are shuffled evenly.  That join looks keys up by hash, so the
    rows, which are many more than the keys, are not sorted.
    """
    payload = [c for c in lookup.columns if c not in (key, weight)]
    if lookup.count() <= broadcast_rows(lookup.drop(weight)):
        return rows.join(F.broadcast(lookup.drop(weight)), key, "left").select(
            *[F.col(f"`{c}`") for c in [*rows.columns, *payload]])
    total = lookup.agg(F.sum(weight).alias("t")).scalar()
    is_hot = F.col(weight) * HOT_SHARE > total
    hot = lookup.filter(is_hot).select(
        F.col(f"`{key}`").alias("_hot_key"),
        F.struct(*[F.col(f"`{c}`") for c in payload]).alias("_hot"))
    cold = lookup.filter(~is_hot).select(
        F.col(f"`{key}`").alias("_cold_key"), F.lit(0).alias("_cold_slot"),
        F.struct(*[F.col(f"`{c}`") for c in payload]).alias("_cold")).hint("shuffle_hash")
    marked = rows.join(F.broadcast(hot), F.col(f"`{key}`") == F.col("_hot_key"), "left")
    spread = 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(SPREAD))
    slot = F.when(F.col("_hot_key").isNotNull() | F.col(f"`{key}`").isNull(),
                  spread.cast("int")).otherwise(F.lit(0))
    joined = marked.withColumn("_slot", slot).join(
        cold, (F.col(f"`{key}`") == F.col("_cold_key")) & (F.col("_slot") == F.col("_cold_slot")),
        "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        *[F.coalesce(F.col("_hot")[c], F.col("_cold")[c]).alias(c) for c in payload])
