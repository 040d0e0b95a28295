"""Exact repeats of byte strings by a logarithmic family of suffix arrays.

Any WINDOW bytes hold many SEED-byte strings; the one with the least hash (the leftmost of
equal ones) is the window's anchor, the same wherever the window occurs.  All windows of a
document that share an anchor form a run; the suffix that begins at the anchor, with the
bytes of its run around it, is what is indexed.

Suffixes go to shards by their seed's hash.  A shard takes them in batches by ascending
doc_id.  Each batch gets a suffix array (sorted by the hash of the seed, then of the whole
run), which is merge-scanned against the levels that exist: runs found there repeat as a
whole.  What is new becomes a level, and levels of like size merge, so that there are only
logarithmically many.  Runs that share a seed but not the bytes around it are compared
window by window in a second round, since they may agree on some windows only.

Order within a seed is by hash, not by bytes: only equality of long strings matters, and
shards keep it exact.  Equal 64-bit hashes count as equal strings.  Runs that repeat within
a chunk of documents are sent once, so a passage in a third of all documents costs one entry
per chunk.

Texts are UTF-8 bytes; matches never cross rows.  Null and empty texts have no bytes.  Rows
with one id follow each other in the order of their texts.  Rows without an id stay whole
and remove nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .arrays import U, _byte, _down, _up, mix, seeded, joined
from .exchange import FIRST, REPLY, Entries, chunked, first_entries, first_replies, pack_ids, replies, unpack_ids

WINDOW, SEED = 100, 50
SLICE = 1 << 19
BATCHES = 8              # a shard takes its suffixes in so many batches
RUNS = "shard int, chunk int, seed binary, run binary, doc binary"


class Slice:
    """The runs of the windows that start in data[at:at + SLICE]."""

    def __init__(self, data: np.ndarray, at: int, valid: np.ndarray):
        piece = data[at:at + SLICE + WINDOW - 1]
        n = len(piece) - WINDOW + 1
        self.at = at
        self.sums = np.zeros(len(piece) + 1, U)
        np.cumsum(_byte[piece] * _up[:len(piece)], out=self.sums[1:])
        m = n + WINDOW - SEED
        seeds = mix((self.sums[SEED:SEED + m] - self.sums[:m]) * _down[:m])
        bits = U(21)
        low = (seeds >> bits << bits) | np.arange(m, dtype=U)
        span, wide = 1, WINDOW - SEED + 1
        while 2 * span <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[:len(low) - (wide - span)], low[wide - span:])
        anchor = (low & U((1 << 21) - 1)).astype(np.int64)[:n]
        valid = valid[at:at + n]
        start = valid.copy()
        start[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        stop = valid.copy()
        stop[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        self.low, self.high = np.flatnonzero(start), np.flatnonzero(stop)
        where = anchor[self.low]
        self.seed = seeds[where]
        shape = (self.high - self.low) * 64 + (where - self.low)
        self.run = mix((self.sums[self.high + WINDOW] - self.sums[self.low]) * _down[self.low]
                       + mix(shape.astype(U)))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start in the data, hash) of each window of the chosen runs."""
        low, size = self.low[which], self.high[which] - self.low[which] + 1
        upto = np.cumsum(size) - size
        at = np.repeat(low - upto, size) + np.arange(size.sum())
        return self.at + at, seeded((self.sums[at + WINDOW] - self.sums[at]) * _down[at], 31)


class Chunk:
    """The bytes of a chunk's documents in ascending order of the ids."""

    def __init__(self, frame: pd.DataFrame, shards: int):
        frame = frame.sort_values(["doc_id", "text"], kind="stable")
        self.frame, self.shards = frame, shards
        self.data, self.starts = joined([t.encode() for t in frame["text"]])
        known = frame["known"].to_numpy(bool)
        self.ids = frame["doc_id"].to_numpy()
        valid = np.zeros(len(self.data), bool)
        for a, b, here in zip(self.starts[:-1], self.starts[1:], known):
            if here and b - 1 - a >= WINDOW:
                valid[a:b - WINDOW] = True
        self.slices = [Slice(self.data, a, valid) for a in range(0, len(self.data) - WINDOW + 1, SLICE)]
        self.low = self._all(lambda s: s.at + s.low, np.int64)
        self.high = self._all(lambda s: s.at + s.high, np.int64)
        self.seed = self._all(lambda s: s.seed, U)
        self.entries = Entries(self._all(lambda s: s.run, U), shards)
        # Runs of one seed must meet, so the shard is that of the seed.
        shard = (self.seed[self.entries.place] >> U(32)) % U(shards)
        self.entries.order = np.argsort(shard.astype(np.int64), kind="stable")
        self.entries.shards, cut = np.unique(shard[self.entries.order], return_index=True)
        self.entries.cut = np.append(cut, len(shard))

    def _all(self, of, kind):
        return np.concatenate([of(s) for s in self.slices]) if self.slices else np.empty(0, kind)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.starts, at, side="right") - 1] if len(at) else \
            np.empty(0, np.int64)

    def open_windows(self, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, Entries]:
        """(covered runs, starts of the windows that are compared one by one, their entries)."""
        found = self.entries.answers(answers, 1, 2)
        first = np.zeros(len(self.low), bool)
        first[self.entries.place] = True
        covered = found[self.entries.of, 0] | ~first
        chosen = first & found[self.entries.of, 1]
        at, hashes, done = [np.empty(0, np.int64)], [np.empty(0, U)], 0
        for s in self.slices:
            a, h = s.windows(np.flatnonzero(chosen[done:done + len(s.low)]))
            at.append(a)
            hashes.append(h)
            done += len(s.low)
        return covered, np.concatenate(at), Entries(np.concatenate(hashes), self.shards)


class Levels:
    """A shard's family of suffix arrays; sizes fall geometrically."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Takes a batch, in the order of its places; tells which suffixes occurred before."""
        order = np.argsort(key, kind="stable")                    # the batch's suffix array
        key, run = key[order], run[order]
        seen = np.zeros(len(key), bool)
        seen[1:] = (key[1:] == key[:-1]) & (run[1:] == run[:-1])
        for known, runs in self.levels:                           # merge-scan
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            seen |= (known[at] == key) & (runs[at] == run)
        new = (key[~seen], run[~seen])
        while self.levels and len(self.levels[-1][0]) <= 2 * len(new[0]):
            old = self.levels.pop()
            both = np.concatenate([old[0], new[0]])
            place = np.argsort(both, kind="stable")
            new = (both[place], np.concatenate([old[1], new[1]])[place])
        if len(new[0]):
            self.levels.append(new)
        out = np.empty(len(key), bool)
        out[order] = seen
        return out


def _send(shards: int):
    def run(key, frame):
        chunk = Chunk(frame, shards)
        place = chunk.entries.place
        seed, doc = chunk.seed[place], chunk.doc_of(chunk.low[place])
        rows = [(shard, key[0], seed[some].astype("<u4").tobytes(),
                 chunk.entries.values[some].astype("<u8").tobytes(), pack_ids(doc[some]))
                for shard, some in chunk.entries.parts()]
        return pd.DataFrame(rows, columns=["shard", "chunk", "seed", "run", "doc"])
    return run


def _meet(frame):
    """Two bits per suffix: it occurred before; it is new, but others share its seed."""
    runs = [np.frombuffer(x, "<u8") for x in frame["run"]]
    run = np.concatenate(runs)
    seed = np.concatenate([np.frombuffer(x, "<u4") for x in frame["seed"]]).astype(U)
    doc = np.concatenate([unpack_ids(x) for x in frame["doc"]])
    key = (seed << U(32)) | (run & U(0xFFFFFFFF))
    order = np.argsort(doc, kind="stable")           # one id's suffixes are in one row, in order
    family, before = Levels(), np.empty(len(run), bool)
    for some in np.array_split(order, BATCHES):
        before[some] = family.add(key[some], run[some])
    kinds, at = np.unique(seed, return_inverse=True)
    several = np.bincount(at[~before], minlength=len(kinds))[at] > 1
    bits = np.stack([before, ~before & several], axis=1).ravel()
    return replies(frame, 1, bits, [2 * len(x) for x in runs])


def _compare(shards: int):
    def run(key, frame, answers):
        chunk = Chunk(frame, shards)
        _, at, entries = chunk.open_windows(answers)
        return first_entries(entries, chunk.doc_of(at[entries.place]), key[0])
    return run


def _cut(shards: int):
    def run(key, frame, answers):
        chunk = Chunk(frame, shards)
        covered, at, entries = chunk.open_windows(answers)
        edge = np.zeros(len(chunk.data) + WINDOW + 1, np.int32)
        np.add.at(edge, chunk.low[covered], 1)
        np.add.at(edge, chunk.high[covered] + WINDOW, -1)
        if len(at):
            first = np.zeros(len(at), bool)
            first[entries.place] = True
            gone = at[entries.answers(answers, 2)[entries.of, 0] | ~first]
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + WINDOW, -1)
        removed = np.cumsum(edge)[:len(chunk.data)] > 0
        out = []
        for a, b, doc, known in zip(chunk.starts[:-1], chunk.starts[1:] - 1, chunk.ids, chunk.frame["known"]):
            mine = removed[a:b]
            spans = int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum())
            out.append((doc, known, b - a, int(mine.sum()), spans, chunk.data[a:b][~mine].tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "known", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; `kept` holds the bytes that stay."""
    rows, shards = chunked(docs)
    by_chunk = rows.groupBy("chunk")
    met = by_chunk.applyInPandas(_send(shards), RUNS).groupBy("shard").applyInPandas(_meet, REPLY)
    found = by_chunk.cogroup(met.groupBy("chunk")).applyInPandas(_compare(shards), FIRST) \
        .groupBy("shard").applyInPandas(first_replies(2), REPLY)
    done = by_chunk.cogroup(met.unionByName(found).groupBy("chunk")).applyInPandas(
        _cut(shards), "doc_id long, known boolean, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "n_bytes",
                       "n_removed", "n_spans", "kept")
