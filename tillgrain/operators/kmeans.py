"""K-means from many starts at once.

Every step of all starts is one pass over the stored points: a task finds the nearest centre of each start
for its points and adds them up per (start, cluster); Spark adds up the tasks.  Starts that have
come to rest leave the next passes.  Coordinates are added as whole numbers of a small unit, so
the sums, and with them the centres, are the same in any order of tasks.

Starts are drawn from a bounded sample of the points (smallest hashes), each centre far from those
before it: with a chance in proportion to the squared distance.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize

# Executors need not have this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 10_000         # points from which starts are drawn
STEPS = 300
UNIT = 1e-9             # of the sums of coordinates, the digits that scaled values have
REST = 1e-9             # a start rests when no centre moves farther


class Centres:
    """The centres of one start, in the order of `columns`, and its cost (sum of squared distances)."""

    def __init__(self, points: np.ndarray, columns: list[str], cost: float, costs: list[float], steps: int):
        self.points, self.columns, self.cost, self.costs, self.steps = points, columns, cost, costs, steps

    def distances(self) -> list[Column]:
        out = []
        for centre in self.points.tolist():
            total = F.lit(0.0)
            for column, at in zip(self.columns, centre):
                away = F.col(f"`{column}`") - F.lit(at)
                total = total + away * away
            out.append(total)
        return out

    def assign(self, rows: DataFrame, name: str = "cluster") -> DataFrame:
        """The number of the nearest centre; ties go to the smaller number."""
        nearest = F.array_min(F.array(*[F.struct(d.alias("away"), F.lit(k).alias("at"))
                                        for k, d in enumerate(self.distances())]))
        return rows.withColumn(name, nearest["at"])

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.columns, self.points.tolist(), self.cost, self.costs, self.steps)],
                              "columns array<string>, points array<array<double>>, cost double, "
                              "costs array<double>, steps int").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Centres:
        row = spark.read.parquet(path).first()
        return Centres(np.array(row["points"]), list(row["columns"]), row["cost"], list(row["costs"]), row["steps"])


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    away = ((points[:, None, :] - centres[None]) ** 2).sum(2)
    best = away.argmin(1)
    return best, away[np.arange(len(points)), best]


def _spread(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k points of the sample, far from each other."""
    draw = np.random.default_rng(seed)
    chosen = [sample[draw.integers(len(sample))]]
    while len(chosen) < k:
        away = _nearest(sample, np.array(chosen))[1]
        total = away.sum()
        chosen.append(sample[draw.choice(len(sample), p=away / total)] if total > 0 else sample[0])
    return np.array(chosen)


def _step(points: DataFrame, columns: list[str], active: dict[int, np.ndarray]) -> pd.DataFrame:
    """(start, cluster, n, cost, sums): one row per start and cluster that has points."""
    starts, k = list(active), len(next(iter(active.values())))
    centres, first = np.concatenate([active[i] for i in starts]), np.arange(len(starts)) * k

    def run(batches):
        held = np.zeros((2 + len(columns), len(centres)), np.int64)
        for batch in batches:
            x = batch[columns].to_numpy(float)
            away = np.zeros((len(x), len(centres)))
            for j in range(len(columns)):
                gap = x[:, j, None] - centres[None, :, j]
                away += gap * gap
            away = away.reshape(len(x), len(starts), k)
            best = away.argmin(2)
            cost = np.rint(np.take_along_axis(away, best[:, :, None], 2) / UNIT).astype(np.int64)
            at = (best + first).ravel()
            held[0] += np.bincount(at, minlength=len(centres))
            np.add.at(held[1], at, cost.ravel())
            for j, whole in enumerate(np.rint(x / UNIT).astype(np.int64).T):
                np.add.at(held[2 + j], at, np.repeat(whole, len(starts)))
        found = np.flatnonzero(held[0])
        if len(found):
            yield pd.DataFrame([(starts[c // k], int(c % k), held[:, c].tolist()) for c in found],
                               columns=["start", "cluster", "sums"])

    partial = points.mapInPandas(run, "start int, cluster int, sums array<long>")
    width = 2 + len(columns)
    return partial.groupBy("start", "cluster").agg(*[
        F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]).toPandas()


def fit_starts(rows: DataFrame, columns: list[str], k: int, starts: int, seed: int, key: str) -> Centres:
    """The best of several starts by cost, all found together; `key` names the rows for the sample."""
    points = materialize(rows.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns],
                                     F.xxhash64(F.col(f"`{key}`")).alias("_place")), "points")
    sample = np.array([tuple(r)[:-1] for r in points.orderBy("_place", *columns).limit(SAMPLE).collect()], float)
    points = points.drop("_place")
    if not len(sample):
        raise ValueError("no points to cluster")
    centres = {i: _spread(sample, k, seed + i) for i in range(starts)}
    costs, active, steps = {}, set(centres), 0
    while active and steps < STEPS:
        steps += 1
        found = _step(points, columns, {i: centres[i] for i in active})
        for i, some in found.groupby("start"):
            old, new = centres[i], centres[i].copy()
            costs[i] = float(sum(some["s1"])) * UNIT
            for row in some.itertuples(index=False):
                new[row.cluster] = [float(getattr(row, f"s{2 + j}")) * UNIT / float(row.s0)
                                    for j in range(len(columns))]
            centres[i] = new
            if np.abs(new - old).max() <= REST:
                active.discard(i)
    best = min(costs, key=lambda i: (costs[i], i))
    return Centres(centres[best], list(columns), costs[best], [costs[i] for i in sorted(costs)], steps)
