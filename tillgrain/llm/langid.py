"""Language of whole texts by interpolated Kneser-Ney character models.

Texts are lower-cased runs of letters joined by single spaces.  Each language has a model of
order 4; the models of all languages share one sorted array of n-gram hashes per order, with
a row of log probabilities (or back-off weights) per entry.  The language with the lowest
cross-entropy per character wins.

The models are learned from a bounded sample: about FIT_CHARS characters per language
from whole texts, chosen by a hash of the id.  Another bounded sample
(CHECK_DOCS per language) calibrates the score (a logistic of the log-likelihood margin)
and the rejection: a text whose cross-entropy lies far above that of its language's known
texts, or that has no letter, is rejected.

A null text, or one without letters, is `und` with score 0.  Without labelled rows all are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import U, mix

ORDER = 4
FIT_CHARS = 2_000_000
CHECK_DOCS = 400
SHARES = 1_000_003
REJECT = 12.0            # standard deviations
CHARS = 200_000          # characters counted or scored at once, some 100 bytes of arrays each
UNKNOWN = "und"

_fold = np.arange(1 << 16, dtype=np.uint16)
_is_letter = np.array([chr(i).isalpha() for i in range(1 << 16)])


def runs(texts: list[str]):
    """(begin, end) of runs of whole texts with at most CHARS characters; a longer text is a run of its own."""
    begin = chars = 0
    for k, text in enumerate(texts):
        if k > begin and chars + len(text) > CHARS:
            yield begin, k
            begin, chars = k, 0
        chars += len(text)
    if texts:
        yield begin, len(texts)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit symbols, where each text begins, and the end): three gaps, then words and gaps."""
    parts, sizes = [], []
    for text in texts:
        code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        high = code >> 16
        low = (code & 0xFFFF).astype(np.uint16) ^ (high * 0x9E37).astype(np.uint16)
        letter = np.where(high == 0, _is_letter[code & 0xFFFF], False)
        if high.any():
            far, of = np.unique(code[high > 0], return_inverse=True)
            letter[high > 0] = np.array([chr(c).isalpha() for c in far.tolist()])[of]
        low = np.where(letter, np.where(low == 32, 33, low), 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]                     # the first gap after a letter
        low = low[keep]
        parts += [np.full(ORDER - 1, 32, np.uint16), low.astype(np.uint16)]
        sizes.append(len(low) + ORDER - 1)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint16),
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def grams(code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending at each scored place, the text of that place)."""
    wide = code.astype(U)
    n = max(0, len(wide) - ORDER + 1)
    key = np.zeros(n, U)
    for j in range(ORDER):
        key = (key << U(16)) | wide[j:j + n]
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.ones(len(code), bool)
    for j in range(ORDER - 1):
        inside[np.minimum(starts[:-1] + j, len(code) - 1)] = False
    inside = inside[ORDER - 1:]
    return key[inside], of[ORDER - 1:][inside]


def _count(frames):
    """Distinct n-grams of a partition with their counts, by language."""
    held: dict[str, list] = {}
    for frame in frames:
        for lang, some in frame.groupby("lang"):
            texts = some["text"].tolist()
            for a, b in runs(texts):
                key, _ = grams(*symbols(texts[a:b]))
                held.setdefault(lang, []).append(np.unique(key, return_counts=True))
    for lang, pairs in held.items():
        key, of = np.unique(np.concatenate([k for k, _ in pairs]), return_inverse=True)
        count = np.bincount(of, np.concatenate([c for _, c in pairs])).astype(np.int64)
        yield pd.DataFrame({"lang": lang, "key": key.view(np.int64), "n": count})


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> list[dict]:
    """Per order (1 first): n-grams with log probabilities, contexts with log back-off weights."""
    levels, key, count = [], keys, counts.astype(float)
    for order in range(ORDER, 0, -1):
        levels.append((order, key, count))
        # The next order counts how many different symbols stand before an n-gram.
        key, count = np.unique(key & U((1 << 16 * (order - 1)) - 1), return_counts=True)
        count = count.astype(float)
    out, lower, lower_p = [], None, None
    for order, key, count in reversed(levels):
        once, twice = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
        context = key >> U(16)
        ctx, of = np.unique(context, return_inverse=True)
        total = np.bincount(of, count)
        weight = discount * np.bincount(of) / total
        if lower is None:
            base = np.full(len(key), 1.0 / (len(key) + 1))
        else:
            base = lower_p[np.searchsorted(lower, key & U((1 << 16 * (order - 1)) - 1))]
        p = np.maximum(count - discount, 0) / total[of] + weight[of] * base
        out.append({"gram": key, "p": np.log(p), "ctx": ctx, "w": np.log(weight),
                    "unseen": -np.log(len(key) + 1.0)})
        lower, lower_p = key, p
    return out


class Models:
    """The models of all languages in shared sorted hash arrays."""

    def __init__(self, langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        each = [kneser_ney(*counts[lang]) for lang in langs]
        self.unseen = np.array([m[0]["unseen"] for m in each])
        self.grams, self.ctx = [], []
        for order in range(ORDER):
            for store, name, value in ((self.ctx, "ctx", "w"), (self.grams, "gram", "p")):
                key = np.unique(np.concatenate([m[order][name] for m in each]))
                rows = np.zeros((len(key), len(langs)), np.float32)
                for c, m in enumerate(each):
                    known = m[order]
                    at = np.minimum(np.searchsorted(known[name], key), len(known[name]) - 1)
                    hit = known[name][at] == key
                    if name == "ctx":
                        rows[:, c] = np.where(hit, known[value][at], 0.0)
                    else:       # not seen in this language: back off inside it
                        rows[:, c] = np.where(hit, known[value][at], self._lower(order, key, c))
                place = np.argsort(mix(key))
                store.append((mix(key)[place], rows[place]))

    def _lower(self, order, key, c):
        if order == 0:
            w, hit = self._find(self.ctx[0], key >> U(16))
            return np.where(hit, w[:, c], 0.0) + self.unseen[c]
        w, hit = self._find(self.ctx[order], key >> U(16))
        back = np.where(hit, w[:, c], 0.0)
        return back + self._score(order - 1, key & U((1 << 16 * order) - 1))[:, c]

    @staticmethod
    def _find(table, key):
        known, rows = table
        hashed = mix(key)
        at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
        return rows[at], known[at] == hashed

    def _score(self, order, key):
        found, hit = self._find(self.grams[order], key)
        if not hit.all():
            miss = np.flatnonzero(~hit)
            w, seen = self._find(self.ctx[order], key[miss] >> U(16))
            back = np.where(seen[:, None], w, np.float32(0))
            found[miss] = back + (self.unseen if order == 0 else
                                  self._score(order - 1, key[miss] & U((1 << 16 * order) - 1)))
        return found

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character of each text and language, scored characters)."""
        out = np.zeros((len(texts), len(self.langs)))
        size = np.zeros(len(texts), np.int64)
        for k, stop in runs(texts):
            key, of = grams(*symbols(texts[k:stop]))
            kinds, at = np.unique(key, return_inverse=True)
            logp = self._score(ORDER - 1, kinds)
            for c in range(len(self.langs)):
                out[k:stop, c] = -np.bincount(of, logp[at, c], stop - k)
            size[k:stop] = np.bincount(of, minlength=stop - k)
        return out / np.maximum(size, 1)[:, None], size


class Detector:
    def __init__(self, models: Models | None, scale: float = 1.0, level: np.ndarray | None = None,
                 spread: np.ndarray | None = None):
        self.models, self.scale, self.level, self.spread = models, scale, level, spread

    def predict(self, texts: list[str]) -> pd.DataFrame:
        """(lang_pred, score, rejected) of each text."""
        if self.models is None:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True})
        entropy, size = self.models.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(texts)), best]
        margin = _margin(entropy) * size
        score = 1 / (1 + np.exp(-np.minimum(self.scale * margin, 40)))
        limit = self.level[best] + REJECT * np.sqrt(self.spread[0] + self.spread[1] / np.maximum(size, 1))
        none = size == 0
        langs = np.array(self.models.langs, object)
        return pd.DataFrame({"lang_pred": np.where(none, UNKNOWN, langs[best]),
                             "score": np.where(none, 0.0, score), "rejected": none | (low > limit)})


def _margin(entropy: np.ndarray) -> np.ndarray:
    if entropy.shape[1] == 1:
        return np.full(len(entropy), 1.0)
    two = np.partition(entropy, 1, axis=1)
    return two[:, 1] - two[:, 0]


def fit(labelled: DataFrame) -> Detector:
    """A detector from (doc_id, text, lang); rows without a language or text are not used."""
    rows = labelled.select(F.xxhash64("doc_id").alias("place"), "lang", "text").filter(
        "lang is not null and text is not null")
    place = F.pmod(F.col("place"), F.lit(SHARES))
    sizes = rows.groupBy("lang").agg(
        F.sum(F.length("text")).alias("chars"), F.count("*").alias("n"))
    bounds = sizes.select(
        F.col("lang").alias("b_lang"),
        (SHARES * F.least(F.lit(0.8), FIT_CHARS / F.greatest("chars", F.lit(1)))).alias("fit"),
        (SHARES * (1 - F.least(F.lit(0.2), CHECK_DOCS / F.col("n")))).alias("check"))
    chosen = rows.join(F.broadcast(bounds), F.col("lang") == F.col("b_lang")).select(
        "lang", "text",
        (place < F.col("fit")).alias("fits"), (place >= F.col("check")).alias("checks"))
    found = chosen.filter("fits").select("lang", "text").mapInPandas(
        _count, "lang string, key long, n long").groupBy("lang", "key").agg(
        F.sum("n").alias("n")).toPandas()
    if found.empty:
        return Detector(None)
    counts = {}
    for lang, some in found.groupby("lang"):
        some = some.sort_values("key")
        key = some["key"].to_numpy().view(U)
        order = np.argsort(key)
        counts[lang] = (key[order], some["n"].to_numpy()[order])
    models = Models(sorted(counts), counts)
    return _calibrate(models, chosen.filter("checks").select("lang", "text"))


def _calibrate(models: Models, known: DataFrame) -> Detector:
    def measure(frames):
        for frame in frames:
            entropy, size = models.entropies(frame["text"].tolist())
            best = entropy.argmin(axis=1)
            yield pd.DataFrame({
                "best": best, "right": [models.langs[b] == x for b, x in zip(best, frame["lang"])],
                "low": entropy.min(axis=1), "margin": _margin(entropy) * size, "size": size})

    seen = known.mapInPandas(measure, "best int, right boolean, low double, margin double, size long") \
        .filter("size > 0").toPandas()
    if seen.empty:
        return Detector(models, 1.0, np.full(len(models.langs), np.inf), np.zeros(2))
    scales = np.array([1, 0.5, 0.2, 0.1, 0.05, 0.02])
    sure = 1 / (1 + np.exp(-np.minimum(np.outer(scales, seen["margin"]), 40)))
    fits = np.where(seen["right"], np.log(sure), np.log1p(-np.minimum(sure, 1 - 1e-12))).sum(axis=1)
    middle = float(seen["low"].median())
    level = np.array([seen["low"][seen["best"] == c].median() if (seen["best"] == c).any() else middle
                      for c in range(len(models.langs))])
    # Variance of the entropy: a part of its own, and a part that falls with the length.
    off = (seen["low"] - level[seen["best"]]) ** 2
    long = seen["size"] >= seen["size"].median()
    per_char = float((off * seen["size"])[~long].mean()) if (~long).any() else float((off * seen["size"]).mean())
    return Detector(models, float(scales[fits.argmax()]), level,
                    np.array([float(off[long].mean()), max(per_char, 1.0)]))


def detect(text: Column, detector: Detector) -> Column:
    """A struct (lang_pred, score, rejected) for each text."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(column: pd.Series) -> pd.DataFrame:
        return detector.predict(column.tolist())
    return run(F.coalesce(text, F.lit("")))
