"""Churn: customer set, boosted-tree model, search, scoring."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..errors import ModelError
from ..functions.scalars import available, churn_risk, fill_model_inputs
from ..schema import CHURN_FEATURES, DEFAULTS, Settings
from ..session import materialize
from .evaluate import classification_report, precision, precision_at_top, roc_auc, stratified_split
from .features import first_per_key

# The churn flag is a threshold on this column, so a model that sees it knows the answer.
LEAKY = ["DaysSinceLastPurchase"]
ONE_TASK = 10_000       # rows of a search that one task holds, so that sums are added in one order


def churn_set(features: DataFrame) -> DataFrame:
    """One row per customer: first feature values, nulls as 0, and the flag."""
    columns = available(features, CHURN_FEATURES)
    rows = first_per_key(features, "Customer ID", [*columns, "ChurnFlag"])
    return fill_model_inputs(rows, columns)


def model_inputs(df: DataFrame, exclude_leaky: bool = False) -> list[str]:
    return [c for c in available(df, CHURN_FEATURES) if not (exclude_leaky and c in LEAKY)]


def _assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def fit_churn(train: DataFrame, settings: Settings = DEFAULTS, exclude_leaky: bool = False,
              subsample: float = 1.0, feature_share: float | None = None) -> GBTClassificationModel:
    """Boosted trees; churned customers weigh `churn_positive_weight`."""
    weight = F.when(F.col("ChurnFlag") == 1, settings.churn_positive_weight).otherwise(1.0)
    rows = _assembled(train, model_inputs(train, exclude_leaky)).withColumn("_weight", weight)
    learner = GBTClassifier(labelCol="ChurnFlag", weightCol="_weight", maxIter=settings.churn_trees,
                            maxDepth=settings.churn_depth, stepSize=settings.churn_rate,
                            subsamplingRate=subsample, seed=settings.seed)
    if feature_share is not None:
        learner = learner.setFeatureSubsetStrategy(str(feature_share))
    return learner.fit(rows)


def score_churn(model: GBTClassificationModel, rows: DataFrame, exclude_leaky: bool = False) -> DataFrame:
    """Add `churn_probability`; works on any frame with the inputs, also a stream."""
    columns = model_inputs(rows, exclude_leaky)
    scored = model.transform(_assembled(fill_model_inputs(rows, columns), columns))
    return (scored.withColumn("churn_probability", vector_to_array("probability")[1])
            .drop("features", "rawPrediction", "probability", "prediction"))


def score_requests(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """Probability and risk band of supplied feature rows."""
    scored = score_churn(model, rows)
    return scored.withColumn("churn_risk", churn_risk(F.col("churn_probability")))


def evaluate_churn(scored: DataFrame, key: str = "Customer ID") -> dict[str, float]:
    """ROC area, precision at 0.5 and precision in the top fifth, as driver scalars."""
    called = F.col("churn_probability") >= 0.5
    return {
        "roc_auc": roc_auc(scored, "ChurnFlag", "churn_probability").first()[0],
        "precision": precision(scored, "ChurnFlag", called).first()[0],
        "precision_at_top_20pct": precision_at_top(scored, "ChurnFlag", "churn_probability", key).first()[0],
    }


def churn_report(scored: DataFrame) -> DataFrame:
    called = scored.withColumn("_called", (F.col("churn_probability") >= 0.5).cast("int"))
    return classification_report(called, "ChurnFlag", "_called")


def search_trials(settings: Settings, trials: int, trees: tuple[int, int]) -> list[dict]:
    """The parameters of all trials, drawn before any is run."""
    draw = random.Random(settings.seed)
    low, high = 0.01, 0.2
    return [{"trial": k, "trees": draw.randint(*trees), "depth": draw.randint(3, 8),
             "rate": low * (high / low) ** draw.random(),
             "subsample": draw.uniform(0.6, 1.0), "feature_share": draw.uniform(0.6, 1.0),
             "positive_weight": draw.uniform(1.0, 4.0)} for k in range(trials)]


def search_churn(train: DataFrame, settings: Settings = DEFAULTS, trials: int | None = None,
                 trees: tuple[int, int] = (200, 600), exclude_leaky: bool = False, parallel: int = 4) -> list[dict]:
    """Seeded random search, scored by ROC area on an inner stratified split.

    `parallel` trials run at once, as Spark jobs of their own pools over one stored split.  Returns all
    trials, best first; each holds its parameters and `roc_auc`.  The trials are drawn before any is run, so
    they are the same however many run at once.  So are the scores up to `ONE_TASK` rows; beyond, they agree as
    far as Spark's floating-point sums, which it adds in the order of arriving blocks, decide no tie between splits.
    """
    spark = train.sparkSession
    split = stratified_split(train.drop("part"), "ChurnFlag", "Customer ID", settings.churn_test_share, settings.seed)
    inner = materialize(split.coalesce(1) if train.count() <= ONE_TASK else split, "search-split")
    fit_rows, check_rows = inner.filter("part = 'train'"), inner.filter("part = 'test'")

    def run(trial: dict) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial['trial'] % parallel}")
        chosen = replace(settings, churn_trees=trial["trees"], churn_depth=trial["depth"],
                         churn_rate=trial["rate"], churn_positive_weight=trial["positive_weight"])
        model = fit_churn(fit_rows, chosen, exclude_leaky, trial["subsample"], trial["feature_share"])
        scored = materialize(score_churn(model, check_rows, exclude_leaky), "search-scores")
        return trial | {"roc_auc": roc_auc(scored, "ChurnFlag", "churn_probability").first()[0]}

    drawn = search_trials(settings, trials or settings.search_trials, trees)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        found = list(pool.map(inheritable_thread_target(run), drawn))
    return sorted(found, key=lambda t: (-t["roc_auc"], t["trial"]))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_churn(path: str) -> GBTClassificationModel:
    try:
        return GBTClassificationModel.load(path)
    except Exception as error:
        raise ModelError(f"no churn model at {path}: train and save one first") from error
