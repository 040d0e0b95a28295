"""Sequences of a fixed length from documents, as a cutting-stock problem.

Full sequences are cut off long documents first.  What remains of each (shorter than a
sequence) falls into one of 256 size classes; the histogram of the classes is the demand of
a linear program over patterns (which pieces share a sequence).  Column generation solves
it: the duals price the classes, a knapsack over the capacity finds the best new pattern.
The solution is rounded down; the pieces of each class are ranked and dealt to the patterns.
What rounding leaves, at most one sequence per pattern, is laid end to end and cut freely;
its last rest is cut into powers of two, which need no padding.

Null and empty texts are documents of the end id alone.  Every input row is a document of
its own, also where rows or ids repeat.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import running_start, small_table, texts
from .tokenize import encoder

LENGTH = 2048
CLASSES = 256
END_ID = 1
ROUNDS = 600       # of pricing
GAP = 0.002        # distance from the best solution at which pricing ends
PIVOTS = 12        # patterns that may enter in a round
SPREAD = 64        # ranks of a class are counted in so many slots


def knapsack(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each class c + 1 the best pattern with a piece of it, and the pattern's price.

    One dynamic program over the room that is left gives them all.
    """
    size = len(price)
    best, held = np.zeros(size + 1), np.zeros((size + 1, size), np.int32)
    for room in range(1, size + 1):
        gain = price[:room] + best[room - 1::-1][:room]
        c = int(gain.argmax())
        if gain[c] > best[room - 1] + 1e-12:
            best[room] = gain[c]
            held[room] = held[room - 1 - c]
            held[room, c] += 1
        else:
            best[room], held[room] = best[room - 1], held[room - 1]
    room = size - 1 - np.arange(size)
    patterns = held[room]
    patterns[np.arange(size), np.arange(size)] += 1
    return patterns, price + best[room]


def solve_patterns(demand: np.ndarray, rounds: int = ROUNDS, gap: float = GAP
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, how often each is used, a fraction) of the linear program.

    Each round prices new patterns by the duals and enters those that shorten the solution
    most.  It ends within `gap` of the best (Farley's bound), or at `rounds` with a feasible
    solution that is a little longer.
    """
    used = np.flatnonzero(demand)
    size, n = len(demand), len(used)
    patterns = np.zeros((n, size), np.int64)
    patterns[np.arange(n), used] = size // (used + 1)
    inverse = np.diag(1.0 / (size // (used + 1))) if n else np.zeros((0, 0))
    need = demand[used].astype(float)
    amount = inverse @ need
    for _ in range(rounds if n else 0):
        price = np.zeros(size)
        price[used] = np.maximum(inverse.sum(axis=0), 0)
        made, value = knapsack(price)
        if value.max() <= 1 + gap:
            break
        pool = made[(value > 1 + 1e-7) & (demand > 0)].astype(float)[:, used]
        for _ in range(PIVOTS):
            reduced = pool @ inverse.sum(axis=0) - 1
            columns = inverse @ pool.T
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(columns > 1e-9, amount[:, None] / columns, np.inf)
            gain = np.where(reduced > 1e-9, reduced * ratio.min(axis=0), -1.0)
            j = int(gain.argmax())
            if gain[j] <= 1e-12 * amount.sum():
                j = int(reduced.argmax())          # no shortening: a degenerate step
                if reduced[j] <= 1e-9:
                    break
            column, out = columns[:, j], int(ratio[:, j].argmin())
            inverse[out] /= column[out]
            rest = np.arange(n) != out
            inverse[rest] -= np.outer(column[rest], inverse[out])
            patterns[out] = 0
            patterns[out, used] = pool[j].astype(np.int64)
            amount = np.maximum(inverse @ need, 0)
    return patterns, amount


def _pieces(tokenizer: str, length: int, end_id: int):
    def run(frames):
        for frame in frames:
            out = []
            for row, doc, ids in zip(frame["row"], frame["doc_id"],
                                     encoder(tokenizer).encode(frame["text"].tolist())):
                ids = np.append(ids, end_id).astype("<u4")
                for a in range(0, len(ids), length):
                    part = ids[a:a + length]
                    out.append((row, doc, a, len(part), zlib.crc32(part.tobytes()), len(ids)))
            made = pd.DataFrame(out, columns=["row", "doc_id", "start", "length", "ids_crc32",
                                              "doc_tokens"])
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made
    return run


def _recut(tokenizer: str, end_id: int):
    def run(frames):
        for frame in frames:
            ids = [np.append(x, end_id).astype("<u4")
                   for x in encoder(tokenizer).encode(frame["text"].tolist())]
            frame["ids_crc32"] = [zlib.crc32(x[a:a + n].tobytes()) for x, a, n in
                                  zip(ids, frame["start"], frame["length"])]
            yield frame.drop(columns=["text"])
    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    spark = docs.sparkSession
    unit = -(-length // CLASSES)
    rows = texts(docs).select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    pieces = materialize(rows.mapInPandas(
        _pieces(tokenizer, length, end_id),
        "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
        .withColumns({"kind": F.ceil(F.col("length") / unit).cast("int"),
                      "slot": F.pmod(F.col("row"), F.lit(SPREAD)).cast("int"),
                      "key": F.monotonically_increasing_id()}), "pieces")

    full = pieces.filter(F.col("length") == length)
    full = running_start(full.withColumns({"one": F.lit(1), "part": F.shiftright("key", 33)}),
                         "part", ["key"], "one", "sequence_id")
    n_full = full.count()

    rest = pieces.filter(F.col("length") < length)
    counts = rest.groupBy("kind", "slot").agg(F.count("*").alias("n"))
    by_class = counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()     # 256 rows at most
    demand = np.zeros(CLASSES, np.int64)
    for kind, n in by_class:
        demand[kind - 1] = n
    patterns, amount = solve_patterns(demand)
    times = np.floor(amount + 1e-6).astype(np.int64)
    deals, left, sequence = [], demand.copy(), n_full
    for pattern, use in zip(patterns, times):
        # A use may not need more pieces of a class than there are left.
        holds = np.flatnonzero(pattern)
        use = int(min([use, *(left[holds] // pattern[holds])])) if len(holds) else 0
        if use <= 0:
            continue
        for c in holds.tolist():
            each = int(pattern[c])
            taken = int(demand[c] - left[c])
            deals.append((c + 1, taken, taken + use * each, each, sequence))
            left[c] -= use * each
        sequence += use
    deals = small_table(spark, deals, ["d_kind", "low", "high", "each", "base"])      # patterns x classes

    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("kind").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).select(F.col("kind").alias("b_kind"), F.col("slot").alias("b_slot"), "before")
    inside = F.row_number().over(Window.partitionBy("kind", "slot").orderBy("key")) - 1
    ranked = materialize(rest.withColumn("inside", inside).join(
        F.broadcast(before), (F.col("kind") == F.col("b_kind")) & (F.col("slot") == F.col("b_slot")))
        .withColumn("rank", F.col("before") + F.col("inside")).join(
        F.broadcast(deals), (F.col("kind") == F.col("d_kind")) & (F.col("rank") >= F.col("low"))
        & (F.col("rank") < F.col("high")), "left")
        .withColumn("sequence_id", F.expr("base + (rank - low) div each"))
        .select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "key", "sequence_id"),
        "ranked")
    in_sequence = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "key")
    packed = ranked.filter("sequence_id is not null").withColumn(
        "offset", F.coalesce(F.sum("length").over(
            in_sequence.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    spare = _cut_freely(ranked.filter("sequence_id is null"), rows, sequence, tokenizer, length,
                        end_id)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return full.withColumn("offset", F.lit(0).cast("long")).select(*names).unionByName(
        packed.select(*names)).unionByName(spare.select(*names))


def _cut_freely(spare: DataFrame, rows: DataFrame, base: int, tokenizer: str, length: int,
                end_id: int) -> DataFrame:
    """The few pieces that rounding left (CLASSES patterns of CLASSES pieces at most)."""
    spark = spare.sparkSession
    found = spare.orderBy("key").collect()
    total = sum(p["length"] for p in found)
    bounds, tail = list(range(0, total - total % length + 1, length)), total % length
    for power in reversed(range(length.bit_length())):
        if tail >> power & 1:
            bounds.append(bounds[-1] + (1 << power))
    cuts, at, sequence = [], 0, 0
    for p in found:
        begin, stop = at, at + p["length"]
        while at < stop:
            while bounds[sequence + 1] <= at:
                sequence += 1
            end = min(stop, bounds[sequence + 1])
            cuts.append((p["row"], p["doc_id"], p["start"] + at - begin, end - at, p["doc_tokens"],
                         p["key"], base + sequence, at - bounds[sequence]))
            at = end
    names = ["doc_id", "start", "length", "doc_tokens", "key", "sequence_id", "offset"]
    fields = ", ".join(f"{n} long" for n in names)
    cuts = small_table(spark, cuts, ["c_row", *names])
    # One text per row hash: rows that repeat a document repeat its text.
    text = rows.join(F.broadcast(cuts.select(F.col("c_row").alias("row")).distinct()), "row",
                     "left_semi").select("row", "text").groupBy("row").agg(F.first("text").alias("text"))
    return cuts.join(text, F.col("c_row") == F.col("row")).drop("c_row", "row").mapInPandas(
        _recut(tokenizer, end_id), f"{fields}, ids_crc32 long")
