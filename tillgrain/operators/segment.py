"""Customer segmentation on the log RFM matrix."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..schema import DEFAULTS, Settings
from .kmeans import Centres, fit_starts

RFM = ["recency", "frequency", "monetary"]
SCALE_DIGITS = 9

# Segment name of each numbered cluster.
SEGMENT_NAMES = {
    0: "Budget Shoppers",
    1: "Loyal Regulars",
    2: "High Rollers",
    3: "Occasional Buyers",
    4: "New Prospects",
    5: "At-Risk Valuable",
}


def scales(df: DataFrame, columns: list[str] = RFM) -> DataFrame:
    """(column, mean, deviation): a row per column; a constant column has deviation 1."""
    facts = df.agg(*[F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c)
                     for c in columns])
    return facts.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select(
        "s.column", "s.mean", F.when(F.col("s.sd") > 0, F.col("s.sd")).otherwise(F.lit(1.0)).alias("deviation"))


def scale_by(df: DataFrame, known: DataFrame, suffix: str = "_scaled") -> DataFrame:
    """(value - mean) / deviation by stored `scales`."""
    out = df
    for r in known.collect():                           # a row per column
        scaled = (F.col(r["column"]) - F.lit(r["mean"])) / F.lit(r["deviation"])
        out = out.withColumn(f"{r['column']}{suffix}", F.round(scaled, SCALE_DIGITS))
    return out


def standard_scale(df: DataFrame, columns: list[str] = RFM, suffix: str = "_scaled") -> DataFrame:
    """(value - mean) / population deviation; a constant column becomes 0."""
    return scale_by(df, scales(df, columns), suffix)


def fit_kmeans(scaled: DataFrame, settings: Settings = DEFAULTS, starts: int | None = None,
               key: str = "Customer ID") -> Centres:
    """The best of several starts by cost; all starts share every pass over the rows."""
    return fit_starts(scaled, [f"{c}_scaled" for c in RFM], settings.kmeans_clusters,
                      starts or settings.kmeans_starts, settings.seed, key)


def assign_kmeans(model: Centres, scaled: DataFrame) -> DataFrame:
    return model.assign(scaled)


def silhouette(assigned: DataFrame) -> float:
    """Mean silhouette under squared Euclidean distance (linear in the rows)."""
    rows = VectorAssembler(inputCols=[f"{c}_scaled" for c in RFM], outputCol="features").transform(assigned)
    return ClusteringEvaluator(predictionCol="cluster").evaluate(rows)


def segment_name(number: Column) -> Column:
    """Fixed name of a cluster number; null beyond the named ones."""
    names = F.create_map(*[F.lit(x) for pair in SEGMENT_NAMES.items() for x in pair])
    return F.try_element_at(names, number.cast("int"))


def name_clusters(assigned: DataFrame, cluster: str = "cluster", by: str = "monetary") -> DataFrame:
    """Number clusters 0.. by their mean `by` and name them.

    Raw cluster ids are arbitrary; ordering them makes the names repeatable.
    """
    means = assigned.groupBy(cluster).agg(F.avg(by).alias("_mean"))
    # One row per cluster.
    numbered = means.withColumn("KMeansSegment", F.row_number().over(W.orderBy("_mean", cluster)) - 1)
    return (assigned.join(F.broadcast(numbered.drop("_mean")), cluster)
            .withColumn("SegmentLabel", segment_name(F.col("KMeansSegment"))))
