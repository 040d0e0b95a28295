"""A recurrent network over short sequences, trained by all tasks together.

One recurrent layer with input, forget and output gates reads a sequence; its last state corrects a
linear map of the sequence, in units of that map's error.  Training is full-batch: in every epoch each partition of the stored
rows adds up the gradients of its rows, Spark adds up the partitions, and the next weights travel
with the next epoch's tasks.  So what the driver holds is the weights and one sum per weight, whatever
the number of rows.  Batches of rows add to the sums as whole numbers of a small unit, so the sums do not
depend on the order in which tasks end, and a run over the same stored rows can be repeated.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Executors need not have this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 2.0 ** -32       # of the sums of gradients
BATCH = 4096            # sequences that a task works on at once


def shapes(hidden: int) -> dict[str, tuple[int, ...]]:
    """The weights by name: gates are in the order input, forget, candidate, output."""
    return {"enter": (4 * hidden,), "recur": (hidden, 4 * hidden), "bias": (4 * hidden,), "leave": (hidden,),
            "level": (1,)}


def unpacked(flat: np.ndarray, hidden: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(hidden).items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(w: dict, x: np.ndarray, hidden: int) -> tuple[np.ndarray, list]:
    """The correction for each sequence (row, values around 0 to 1), and what the way back needs."""
    h, c, kept = np.zeros((len(x), hidden)), np.zeros((len(x), hidden)), []
    for t in range(x.shape[1]):
        z = (4 * x[:, t, None] - 2) * w["enter"] + h @ w["recur"] + w["bias"]
        i, f, o = (_sigmoid(z[:, k * hidden:(k + 1) * hidden]) for k in (0, 1, 3))
        g = np.tanh(z[:, 2 * hidden:3 * hidden])
        after = f * c + i * g
        shown = np.tanh(after)
        kept.append((h, c, i, f, g, o, shown))
        h, c = o * shown, after
    return h @ w["leave"] + w["level"][0], [*kept, h]


def gradients(w: dict, x: np.ndarray, y: np.ndarray, hidden: int) -> tuple[dict, float]:
    """Sums over the rows: of the gradient of half the squared error, and of the squared error."""
    made, kept = forward(w, x, hidden)
    error = made - y
    out = {name: np.zeros_like(v) for name, v in w.items()}
    out["leave"], out["level"] = kept[-1].T @ error, np.array([error.sum()])
    dh, dc = error[:, None] * w["leave"], np.zeros((len(x), hidden))
    for t in reversed(range(x.shape[1])):
        h, c, i, f, g, o, shown = kept[t]
        dc = dc + dh * o * (1 - shown ** 2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dc * i * (1 - g ** 2),
                             dh * shown * o * (1 - o)], axis=1)
        out["enter"] += (4 * x[:, t] - 2) @ dz
        out["recur"] += h.T @ dz
        out["bias"] += dz.sum(0)
        dh, dc = dz @ w["recur"].T, dc * f
    return out, float((error ** 2).sum())


class RecurrentModel:
    """The linear map, the weights that correct it, and the mean squared error that each epoch began with."""

    def __init__(self, skip: np.ndarray, level: float, unit: float, flat: np.ndarray, hidden: int,
                 losses: list[float] | None = None):
        self.skip, self.level, self.unit = np.asarray(skip, float), float(level), float(unit)
        self.flat, self.hidden, self.losses = flat, hidden, losses or []

    def linear(self, x: np.ndarray) -> np.ndarray:
        return x @ self.skip + self.level

    def predict(self, lags: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def run(column: pd.Series) -> pd.Series:
            w = unpacked(model.flat, model.hidden)
            x = np.array(column.tolist(), float).reshape(len(column), len(model.skip))
            return pd.Series(np.concatenate([
                model.linear(part) + model.unit * forward(w, part, model.hidden)[0]
                for part in (x[k:k + BATCH] for k in range(0, len(x), BATCH))] or [np.empty(0)]))
        return run(lags)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(
            [(self.skip.tolist(), self.level, self.unit, self.flat.tolist(), self.hidden, self.losses)],
            "skip array<double>, level double, unit double, weights array<double>, hidden int, losses array<double>") \
            .write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> RecurrentModel:
        row = spark.read.parquet(path).first()
        return RecurrentModel(np.array(row["skip"]), row["level"], row["unit"], np.array(row["weights"]),
                              row["hidden"], list(row["losses"]))


def _summed(rows: DataFrame, model: RecurrentModel) -> tuple[np.ndarray, float, int]:
    """Gradient and squared error (in units) over all rows, and their number."""
    def run(batches):
        w = unpacked(model.flat, model.hidden)
        total = np.zeros(len(model.flat) + 2, np.int64)
        for batch in batches:
            for k in range(0, len(batch), BATCH):
                part = batch.iloc[k:k + BATCH]
                x = np.array(part["lags"].tolist(), float).reshape(len(part), len(model.skip))
                rest = (part["target"].to_numpy(float) - model.linear(x)) / model.unit
                made, loss = gradients(w, x, rest, model.hidden)
                total += np.rint(np.concatenate([*(made[n].ravel() for n in w), [loss, len(part)]]) / UNIT).astype(np.int64)
        yield pd.DataFrame({"place": np.arange(len(total)), "value": total})

    found = rows.mapInPandas(run, "place long, value long").groupBy("place").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()        # one row per weight
    total = np.zeros(len(model.flat) + 2)
    for r in found:
        total[r["place"]] = float(r["value"]) * UNIT
    return total[:-2], float(total[-2]), int(round(total[-1]))


def fit_recurrent(rows: DataFrame, skip: np.ndarray, level: float, hidden: int, epochs: int, rate: float,
                  seed: int) -> RecurrentModel:
    """Train on the stored `rows` (lags array<double>, target double).

    The network starts as the linear map (`skip`, `level`) that it corrects.  The weights of the
    epoch with the least error are kept, so the result is never worse on its rows than that map.
    """
    draw = np.random.default_rng(seed)
    start = {"enter": draw.normal(0, 1, 4 * hidden), "recur": draw.normal(0, hidden ** -0.5, (hidden, 4 * hidden)),
             "bias": np.repeat([0.0, 1.0, 0.0, 0.0], hidden), "leave": np.zeros(hidden), "level": np.zeros(1)}
    model = RecurrentModel(skip, level, 1.0, np.concatenate([start[n].ravel() for n in shapes(hidden)]), hidden)
    _, loss, n = _summed(rows, model)
    if not n:
        return model
    model.unit = max((loss / n) ** 0.5, 1e-6)
    best, mean, square = model.flat, np.zeros_like(model.flat), np.zeros_like(model.flat)
    for epoch in range(1, epochs + 2):
        slope, loss, _ = _summed(rows, model)
        model.losses.append(loss / n * model.unit ** 2)
        if model.losses[-1] <= min(model.losses):
            best = model.flat
        if epoch > epochs:
            break
        slope = slope / n
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        step = (mean / (1 - 0.9 ** epoch)) / (np.sqrt(square / (1 - 0.99 ** epoch)) + 1e-9)
        model.flat = model.flat - rate * min(1.0, 2 * (1 - (epoch - 1) / epochs)) * step
    model.flat = best
    return model
