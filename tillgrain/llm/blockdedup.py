"""Exact repeats of word windows across documents, by fixed-block anchors.

Every document is cut into blocks of 7 words that do not overlap; any 13 words in a row hold
a whole block.  The blocks are the index, and every rolling window of 7 words of every
document probes it: a probe hits when another document's block with a smaller id has its
hash, and a block is alive when a later document probes it.  Hits are extended to 13 words:
a window around a hit or a live block is removed when the same 13 words start in a document
with a smaller id.  Overlapping windows add up to maximal repeats.

Words and windows are compared by 64-bit hashes.  Hashes that repeat within a chunk of
documents are sent once, so a passage that a third of all documents share costs one entry
per chunk.

Null and empty texts have no words.  Rows with one id are one document for comparisons (they
do not remove each other's words).  Rows without an id stay whole and remove nothing.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .arrays import joined, span_hash, window_hash, words
from .exchange import FIRST, REPLY, Entries, chunked, first_entries, first_replies, pack_ids, replies, unpack_ids

WINDOW, BLOCK = 13, 7         # any WINDOW words hold a block: WINDOW >= 2 * BLOCK - 1
PROBES = "shard int, chunk int, hash binary, doc binary, more binary, block binary"


class Chunk:
    """The words of a chunk's documents in ascending order of the ids."""

    def __init__(self, frame: pd.DataFrame, shards: int):
        frame = frame.sort_values(["doc_id", "text"], kind="stable")
        self.frame, self.shards = frame, shards
        self.texts = [t.encode() for t in frame["text"]]
        data, starts = joined(self.texts)
        begin, end = words(data)
        self.doc = np.searchsorted(starts, begin, side="right") - 1
        self.hash = span_hash(data, begin, end)
        self.first = np.searchsorted(self.doc, np.arange(len(frame) + 1))
        self.ids = frame["doc_id"].to_numpy()[self.doc] if len(self.doc) else np.empty(0, np.int64)
        self.known = frame["known"].to_numpy(bool)[self.doc] if len(self.doc) else np.empty(0, bool)

    def windows(self, width: int) -> np.ndarray:
        """Where windows of `width` words start that stay in one document."""
        n = max(0, len(self.doc) - width + 1)
        return np.flatnonzero((self.doc[:n] == self.doc[width - 1:][:n]) & self.known[:n])

    def probes(self) -> tuple[np.ndarray, Entries]:
        at = self.windows(BLOCK)
        return at, Entries(window_hash(self.hash, BLOCK)[at], self.shards)

    def candidates(self, answers: pd.DataFrame) -> tuple[np.ndarray, Entries]:
        """Windows of 13 words around hits and live blocks."""
        at, entries = self.probes()
        hit = np.zeros(len(self.doc) + 1, np.int64)
        hit[at] = entries.answers(answers, 1)[entries.of, 0]
        before = np.concatenate([[0], np.cumsum(hit)])
        start = self.windows(WINDOW)
        start = start[before[start + WINDOW - BLOCK + 1] > before[start]]
        return start, Entries(window_hash(self.hash, WINDOW, 3)[start] if len(start) else
                              np.empty(0, np.uint64), self.shards)


def _probe(shards: int):
    def run(key, frame):
        chunk = Chunk(frame, shards)
        at, entries = chunk.probes()
        block = np.zeros(len(entries.values), bool)
        block[entries.of[(at - chunk.first[chunk.doc[at]]) % BLOCK == 0]] = True
        low, high = chunk.ids[at[entries.place]], chunk.ids[at[entries.last]]
        rows = [(shard, key[0], entries.values[some].astype("<u4").tobytes(), pack_ids(low[some]),
                 pack_ids(high[some] - low[some]), np.packbits(block[some]).tobytes())
                for shard, some in entries.parts()]
        return pd.DataFrame(rows, columns=["shard", "chunk", "hash", "doc", "more", "block"])
    return run


def _meet(frame):
    """For each entry: does a smaller id's block have its hash, or does a greater id probe its block."""
    hashes = [np.frombuffer(x, "<u4") for x in frame["hash"]]
    sizes = [len(x) for x in hashes]
    value = np.concatenate(hashes).astype(np.uint64)
    low = np.concatenate([unpack_ids(x) for x in frame["doc"]])
    high = low + np.concatenate([unpack_ids(x) for x in frame["more"]])
    block = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n)
                            for x, n in zip(frame["block"], sizes)]).astype(bool)
    packed = (value << np.uint64(32)) | np.arange(len(value), dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(order), bool)
    new[1:] = (packed[1:] >> np.uint64(32)) != (packed[:-1] >> np.uint64(32))
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    least_block = np.minimum.reduceat(np.where(block, low, np.iinfo(np.int64).max)[order], first)
    most_probe = np.maximum.reduceat(high[order], first)
    hit = np.empty(len(order), bool)
    hit[order] = (least_block[of] < high[order]) | (block[order] & (most_probe[of] > low[order]))
    return replies(frame, 1, hit, sizes)


def _extend(shards: int):
    def run(key, frame, answers):
        chunk = Chunk(frame, shards)
        start, entries = chunk.candidates(answers)
        return first_entries(entries, chunk.ids[start[entries.place]] if len(start) else
                             np.empty(0, np.int64), key[0])
    return run


def _cut(shards: int):
    def run(key, frame, answers):
        chunk = Chunk(frame, shards)
        start, entries = chunk.candidates(answers)
        edge = np.zeros(len(chunk.doc) + 1, np.int64)
        if len(start):
            elsewhere = entries.answers(answers, 2)[:, 0]
            low = chunk.ids[start[entries.place]]
            gone = start[elsewhere[entries.of] | (chunk.ids[start] > low[entries.of])]
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + WINDOW, -1)
        keep = np.cumsum(edge)[:-1] == 0
        kept, removed = [], []
        for k, text in enumerate(chunk.texts):
            mine = keep[chunk.first[k]:chunk.first[k + 1]]
            removed.append(int(len(mine) - mine.sum()))
            kept.append(b" ".join(itertools.compress(text.split(), mine) if removed[-1] else text.split()))
        return pd.DataFrame({"doc_id": chunk.frame["doc_id"], "known": chunk.frame["known"],
                             "n_words": np.diff(chunk.first), "n_removed": removed,
                             "kept": [k.decode() for k in kept]})
    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; `kept` joins the words that stay."""
    rows, shards = chunked(docs)
    by_chunk = rows.groupBy("chunk")
    hits = by_chunk.applyInPandas(_probe(shards), PROBES).groupBy("shard").applyInPandas(_meet, REPLY)
    found = by_chunk.cogroup(hits.groupBy("chunk")).applyInPandas(_extend(shards), FIRST) \
        .groupBy("shard").applyInPandas(first_replies(2), REPLY)
    done = by_chunk.cogroup(hits.unionByName(found).groupBy("chunk")).applyInPandas(
        _cut(shards), "doc_id long, known boolean, n_words long, n_removed long, kept string")
    return done.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", "kept")
