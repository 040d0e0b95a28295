"""Quality scores: logistic regression on hashed word n-grams, trained with FTRL.

Words are runs of letters, of digits or of one kind of other signs; pairs of neighbours are
features too (a word beside itself counts as one common feature).  A document is a sparse
vector of shares, and its score the logistic of a sparse dot product.  Follow the
regularised leader (proximal, per coordinate) fits the weights on a bounded sample of the
labelled rows, TRAIN_DOCS of them at most, chosen by a hash of the id.

Null and empty texts are scored by the bias alone.  Rows that repeat are scored alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import U, joined, seeded, span_hash
from .common import texts

BITS = 18
TRAIN_DOCS = 6000       # bound of the training sample
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SCALE = 4.0             # the vectors' length
CUT = 0.3

_kind = np.full(256, 3, np.uint8)
_kind[[0x20, *range(0x09, 0x0E)]] = 0
_kind[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_kind[list(range(0x30, 0x3A))] = 2


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each n-gram, where each text's n-grams begin, and the end)."""
    data, starts = joined([t.encode() for t in texts])
    kind = _kind[data]
    # Punctuation runs end where the sign changes; other runs where the kind does.
    change = (kind[1:] != kind[:-1]) | ((kind[1:] == 3) & (data[1:] != data[:-1]))
    edge = np.concatenate([[0], np.flatnonzero(change) + 1, [len(data)]])
    begin, end = edge[:-1], edge[1:]
    word = kind[begin] > 0
    begin, end = begin[word], end[word]
    one = span_hash(data, begin, end)
    # The length of a run of signs says little: "***" and "****" are one word.
    one = np.where(kind[begin] == 3, seeded(data[begin].astype(U), 7), one)
    two = np.zeros(len(one), U)
    two[1:] = seeded(one[1:] * U(0x9E3779B97F4A7C15) + one[:-1], 2)
    two[1:][one[1:] == one[:-1]] = U(0x123456789ABCDEF1)
    first = np.searchsorted(begin, starts)
    out = np.empty(2 * len(one), np.int64)
    out[0::2] = (seeded(one, 1) >> U(64 - BITS)).astype(np.int64)
    out[1::2] = (two >> U(64 - BITS)).astype(np.int64)
    if len(one):      # the first word of a text has no neighbour before it
        lead = first[:-1][first[:-1] < first[1:]]
        out[2 * lead + 1] = out[2 * lead]
    return out, 2 * first


def vector(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features and their values, of length SCALE."""
    at, count = np.unique(grams, return_counts=True)
    value = np.sqrt(count.astype(float))
    return at, SCALE * value / max(1e-9, np.sqrt((value ** 2).sum()))


def train(vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 5
          ) -> np.ndarray:
    """FTRL-proximal weights; the last one is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) > L1, w, 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(labels)):
            at, value = vectors[k]
            at, value = np.append(at, 1 << BITS), np.append(value, 1.0)
            w = weights(at)
            slope = (1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - labels[k]) * value
            sigma = (np.sqrt(n[at] + slope ** 2) - np.sqrt(n[at])) / ALPHA
            z[at] += slope - sigma * w
            n[at] += slope ** 2
    return weights(np.arange((1 << BITS) + 1)).astype(np.float32)


def _vectors(frames):
    for frame in frames:
        grams, cut = features(frame["text"].tolist())
        rows = [vector(grams[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        yield pd.DataFrame({"place": frame["place"], "label": frame["label"], "slot": 0,
                            "at": [a.astype("<i4").tobytes() for a, _ in rows],
                            "value": [v.astype("<f4").tobytes() for _, v in rows]})


def _train(frame):
    frame = frame.sort_values("place")
    rows = [(np.frombuffer(a, "<i4"), np.frombuffer(v, "<f4").astype(float))
            for a, v in zip(frame["at"], frame["value"])]
    return pd.DataFrame({"weights": [train(rows, frame["label"].tolist()).tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> np.ndarray:
    """Weights from (doc_id, text) and the rows (doc_id, label) to learn from.

    The sample is chosen among the labels, so that only its ids (`train_docs` at most) meet
    the texts.
    """
    place = F.xxhash64("doc_id")
    known = labels.filter("label is not null and doc_id is not null").select(
        "doc_id", F.col("label").cast("int").alias("label"), place.alias("place"))
    chosen = known.orderBy("place", "label").limit(train_docs)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id").select("place", "label", "text")
    one = sample.mapInPandas(_vectors, "place long, label int, slot int, at binary, value binary") \
        .groupBy("slot").applyInPandas(_train, "weights binary").first()
    return np.frombuffer(one[0], np.float32) if one else np.zeros((1 << BITS) + 1, np.float32)


def score_texts(texts: list[str], weights: np.ndarray) -> np.ndarray:
    out, k = np.full(len(texts), float(weights[-1])), 0
    while k < len(texts):                    # a few million characters at a time
        stop, size = k, 0
        while stop < len(texts) and (stop == k or size + len(texts[stop]) < 2_000_000):
            size += len(texts[stop])
            stop += 1
        grams, cut = features(texts[k:stop])
        of = np.repeat(np.arange(stop - k), np.diff(cut))
        # Counts by (text, feature): a packed sort instead of a table per text.
        pair, count = np.unique((of << BITS) | grams, return_counts=True)
        doc, at = pair >> BITS, pair & ((1 << BITS) - 1)
        value = np.sqrt(count)
        dot = np.bincount(doc, weights[at] * value, stop - k)
        length = np.sqrt(np.bincount(doc, count, stop - k))
        out[k:stop] += SCALE * dot / np.maximum(length, 1e-9)
        k = stop
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def scores(text: Column, weights: np.ndarray) -> Column:
    """Score of each text, higher for label 1.  The weights have a fixed size."""
    shared = np.array(weights)

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return pd.Series(score_texts(column.tolist(), shared))
    return score(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, weights: np.ndarray, cut: float = CUT) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    return texts(docs).select("doc_id", scores(F.col("text"), weights).alias("score")).select(
        "doc_id", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
