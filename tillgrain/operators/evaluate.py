"""Splits and scores of classifiers, exact at any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import DEFAULTS
from ..session import materialize
from .ranking import SMALL, rank_at_most, running_totals, select_ranks_by


def stratified_split(df: DataFrame, label: str, key: str, share: float = DEFAULTS.churn_test_share,
                     seed: int = DEFAULTS.seed, limit: int = SMALL) -> DataFrame:
    """Mark `share` of every label (rounded up) as test, by a salted hash of the key.

    The hash standing at the cut of each label is selected; rows compare with it.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(f"`{key}`").cast("string"))))
    hashed = hashed.withColumn("_label", F.col(label).cast("string"))
    sizes = {r["_label"]: r["n"] for r in hashed.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    cuts = select_ranks_by(hashed, "_label", ["_h", key],
                           {g: [math.ceil(share * n)] for g, n in sizes.items() if g is not None},
                           limit=limit)
    test = F.lit(False)
    for g, found in cuts.items():
        h, k = found[0]["key"]
        inside = (F.col("_h") < h) | ((F.col("_h") == h) & (F.col(f"`{key}`") <= F.lit(k)))
        test = test | ((F.col("_label") == g) & inside)
    return hashed.withColumn("part", F.when(test, "test").otherwise("train")).drop("_h", "_label")


def roc_auc(df: DataFrame, label: str, score: str, limit: int = SMALL) -> DataFrame:
    """Area under the ROC curve: the share of (1, 0) pairs in the right order, ties half."""
    positive = (F.col(label) == 1).cast("long")
    steps = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    steps = running_totals(materialize(steps, "scores"), "score", ["neg"], limit=limit)
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2)
    return steps.agg((F.sum(won.cast("decimal(38,1)")).cast("double")
                      / F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("roc_auc"))


def precision(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """Share of predicted positives that are positive; 0 without any."""
    hits = F.count_if(predicted & (F.col(label) == 1))
    return df.agg(F.coalesce(F.try_divide(hits, F.count_if(predicted)), F.lit(0.0)).alias("precision"))


def precision_at_top(df: DataFrame, label: str, score: str, key: str, share: float = 0.2,
                     limit: int = SMALL) -> DataFrame:
    """Mean label of the rows with the highest scores (at least one row)."""
    n = df.count()
    k = max(1, int(n * share))
    ranked = df.withColumn("_minus", -F.col(score))
    top = ranked.filter(rank_at_most(ranked, ["_minus", key], min(k, n), limit))
    return top.agg(F.avg(F.col(label).cast("double")).alias("precision_at_top"))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    cells = df.groupBy(F.col(label).cast("int").alias("a"), F.col(predicted).cast("int").alias("p")).agg(
        F.count("*").alias("n"))
    rows = []
    for c in (0, 1):
        hit = F.sum(F.when((F.col("a") == c) & (F.col("p") == c), F.col("n")).otherwise(0))
        called = F.sum(F.when(F.col("p") == c, F.col("n")).otherwise(0))
        support = F.sum(F.when(F.col("a") == c, F.col("n")).otherwise(0))
        rows.append((hit, called, support))
    zero = F.lit(0.0)
    facts = cells.agg(*[x.cast("double").alias(f"{n}{c}") for c, r in enumerate(rows)
                        for n, x in zip(("hit", "called", "support"), r)])
    for c in (0, 1):
        p = F.coalesce(F.try_divide(F.col(f"hit{c}"), F.col(f"called{c}")), zero)
        r = F.coalesce(F.try_divide(F.col(f"hit{c}"), F.col(f"support{c}")), zero)
        facts = facts.withColumns({f"p{c}": p, f"r{c}": r})
        facts = facts.withColumn(f"f{c}", F.coalesce(F.try_divide(
            2 * F.col(f"p{c}") * F.col(f"r{c}"), F.col(f"p{c}") + F.col(f"r{c}")), zero))
    total = F.col("support0") + F.col("support1")
    accuracy = F.try_divide(F.col("hit0") + F.col("hit1"), total)

    def row(name, p, r, f, support):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.alias("support"))

    def mean(n):
        return (F.col(f"{n}0") + F.col(f"{n}1")) / 2

    def weighted(n):
        return F.try_divide(F.col(f"{n}0") * F.col("support0") + F.col(f"{n}1") * F.col("support1"), total)

    report = [row(str(c), F.col(f"p{c}"), F.col(f"r{c}"), F.col(f"f{c}"), F.col(f"support{c}")) for c in (0, 1)]
    report.append(row("accuracy", accuracy, accuracy, accuracy, total))
    report.append(row("macro avg", mean("p"), mean("r"), mean("f"), total))
    report.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), total))
    return facts.select(F.explode(F.array(*report)).alias("r")).select("r.*")
