"""Exact Shapley attribution of boosted trees (path-dependent expectations)."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

# Executors need not have this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def leaf_rules(model) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Every leaf of the ensemble as its value and one condition per feature on its path.

    A condition is (feature, low, high, cover): the leaf is reached when
    low < x <= high, and `cover` is the share of training rows that pass the
    feature's splits.  The model is small next to the data and lives on the driver.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    # Stored trees: (tree, metadata, weight) rows, and one row per node.
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    trees: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    leaves = []
    for tree, nodes in trees.items():
        stack = [(0, {})]
        while stack:
            at, path_rules = stack.pop()
            node = nodes[at]
            if node["leftChild"] < 0:
                leaves.append((weights[tree] * node["prediction"],
                               [(f, low, high, cover) for f, (low, high, cover) in path_rules.items()]))
                continue
            feature = node["split"]["featureIndex"]
            cut = node["split"]["leftCategoriesOrThreshold"][0]
            low, high, cover = path_rules.get(feature, (-math.inf, math.inf, 1.0))
            for child, bounds in ((node["leftChild"], (low, min(high, cut))),
                                  (node["rightChild"], (max(low, cut), high))):
                share = nodes[child]["rawCount"] / node["rawCount"]
                stack.append((child, {**path_rules, feature: (*bounds, cover * share)}))
    return leaves


def shapley_values(x: np.ndarray, leaves, n_features: int) -> tuple[np.ndarray, float]:
    """Shapley values of rows `x`, and the base value they add up from.

    The worth of a feature set at one leaf is the product, over the path features,
    of 'the row passes' (inside the set) or the training share (outside).  Products
    split per feature, so a polynomial in the set size sums over all sets at once.
    """
    phi = np.zeros((len(x), n_features))
    base = 0.0
    for value, rules in leaves:
        d = len(rules)
        base += value * math.prod(r[3] for r in rules)
        passes = [((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, low, high, _ in rules]
        share = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
        for i, (feature, _, _, cover) in enumerate(rules):
            poly = np.zeros((len(x), d))
            poly[:, 0] = 1.0
            for j, rule in enumerate(rules):
                if j != i:
                    grown = poly * rule[3]
                    grown[:, 1:] += poly[:, :-1] * passes[j][:, None]
                    poly = grown
            phi[:, feature] += value * (passes[i] - cover) * (poly @ np.array(share))
    return phi, base


def attribute(model, rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per row: the contribution of each input to the margin, `base` and `margin`.

    The leaf rules are broadcast; partitions are handled batch by batch.
    """
    leaves = rows.sparkSession.sparkContext.broadcast(leaf_rules(model))

    def work(batches):
        for pdf in batches:
            x = pdf[columns].to_numpy(dtype=float)
            phi, base = shapley_values(x, leaves.value, len(columns))
            out = pd.DataFrame(phi, columns=columns)
            out.insert(0, key, pdf[key].to_numpy())
            out["base"] = base
            out["margin"] = base + phi.sum(axis=1)
            yield out

    schema = f"`{key}` string, " + ", ".join(f"`{c}` double" for c in columns) + ", base double, margin double"
    inputs = rows.select(F.col(f"`{key}`").cast("string").alias(key),
                         *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return inputs.mapInPandas(work, schema)


def importance(contributions: DataFrame, columns: list[str]) -> DataFrame:
    """Mean absolute contribution per input, strongest first."""
    means = contributions.agg(*[F.avg(F.abs(F.col(f"`{c}`"))).alias(c) for c in columns])
    long = means.unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "importance")
    return long.orderBy(F.desc("importance"), "feature")
