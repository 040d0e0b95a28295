"""Rounds of questions between chunks of documents and shards of a hash space.

A chunk holds the whole texts of some ids and works on them as arrays.  It sends each shard
one row of packed entries, and gets back one row of bits, an answer per entry.  The texts
are shuffled to their chunks once; every round recomputes a chunk's entries from them, so
nothing but entries and bits moves, and lost tasks are simply run again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .arrays import U, groups
from .common import parts_for, total_bytes

CHUNK_BYTES = 4 << 20       # text of a chunk
SHARD_BYTES = 16 << 20      # text whose entries meet in a shard
REPLY = "chunk int, shard int, round int, bits binary"


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = SHARD_BYTES
            ) -> tuple[DataFrame, int]:
    """((doc_id, known, text, chunk), number of shards).

    All rows of an id share a chunk; rows without an id are spread by their text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    size = total_bytes(rows)
    chunks = parts_for(size, chunk_bytes)
    spread = F.coalesce(F.xxhash64("doc_id", F.col("doc_id").isNull()), F.lit(0))
    place = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(spread)
    return rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                       F.col("doc_id").isNotNull().alias("known"), "text",
                       F.pmod(place, F.lit(chunks)).cast("int").alias("chunk")), parts_for(size, shard_bytes)


class Entries:
    """The distinct hashes among `values`, in the order of their first places, by shard."""

    def __init__(self, values: np.ndarray, shards: int):
        order, group, first = groups(values)
        heads = order[first]                                  # first place of each group
        rank = np.empty(len(heads), np.int64)
        self.place = np.sort(heads)
        rank[np.argsort(heads, kind="stable")] = np.arange(len(heads))
        self.of = np.empty(len(values), np.int64)             # entry of each place
        self.of[order] = rank[group]
        last = order[np.append(first[1:], len(values)) - 1] if len(values) else heads
        self.last = np.empty_like(heads)
        self.last[rank] = last
        self.values = values[self.place]
        shard = ((self.values >> U(32)) % U(shards)).astype(np.uint16 if shards < 65536 else np.int64)
        self.order = np.argsort(shard, kind="stable")
        self.shards, cut = np.unique(shard[self.order], return_index=True)
        self.cut = np.append(cut, len(shard))

    def parts(self):
        """(shard, entries that belong to it) in ascending order of their places."""
        for k, shard in enumerate(self.shards.tolist()):
            yield shard, self.order[self.cut[k]:self.cut[k + 1]]

    def answers(self, replies: pd.DataFrame, number: int, width: int = 1) -> np.ndarray:
        """The bits of round `number` for each entry, `width` of them."""
        out = np.zeros((len(self.values), width), bool)
        bits = {s: b for s, b, r in zip(replies["shard"], replies["bits"], replies["round"]) if r == number}
        for shard, some in self.parts():
            out[some] = np.unpackbits(np.frombuffer(bits[shard], np.uint8),
                                      count=width * len(some)).reshape(-1, width).astype(bool)
        return out


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids as differences, which compress well where neighbours are equal."""
    step = np.diff(ids, prepend=np.int64(0))
    small = np.abs(step).max(initial=0) < 1 << 31
    return (b"4" + step.astype("<i4").tobytes()) if small else (b"8" + step.astype("<i8").tobytes())


def unpack_ids(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i4" if raw[:1] == b"4" else "<i8", offset=1).astype(np.int64))


def replies(frame: pd.DataFrame, number: int, bits: np.ndarray, sizes: list[int]) -> pd.DataFrame:
    cut = np.cumsum([0, *sizes])
    return pd.DataFrame({"chunk": frame["chunk"], "shard": frame["shard"], "round": number,
                         "bits": [np.packbits(bits[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])]})


FIRST = "shard int, chunk int, hash binary, doc binary"


def first_entries(entries: Entries, ids: np.ndarray, chunk: int) -> pd.DataFrame:
    """Rows that ask, for each entry, whether a smaller id has its hash; `ids` per entry."""
    rows = [(shard, chunk, entries.values[some].astype("<u8").tobytes(), pack_ids(ids[some]))
            for shard, some in entries.parts()]
    return pd.DataFrame(rows, columns=["shard", "chunk", "hash", "doc"])


def first_replies(number: int):
    """Answers first_entries: a bit for each entry whose hash a smaller id has, too."""
    def run(frame):
        hashes = [np.frombuffer(x, "<u8") for x in frame["hash"]]
        value, doc = np.concatenate(hashes), np.concatenate([unpack_ids(x) for x in frame["doc"]])
        order = np.argsort(value, kind="stable")
        new = np.ones(len(value), bool)
        new[1:] = value[order][1:] != value[order][:-1]
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(value) else doc
        later = np.empty(len(value), bool)
        later[order] = doc[order] > least[np.cumsum(new) - 1]
        return replies(frame, number, later, [len(x) for x in hashes])
    return run
