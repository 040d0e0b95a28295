"""Distribution drift between a reference and a current set of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import DEFAULTS, DRIFT_FEATURES
from ..session import materialize
from .ranking import SMALL, running_totals

DISTANCE_LIMIT = 0.1    # a column has drifted from this distance on
SPREAD_FLOOR = 0.001


def seeded_sample(df: DataFrame, key: list[str], n: int, seed: int = DEFAULTS.seed) -> DataFrame:
    """A fixed sample of at most n rows: the smallest salted hashes of the key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in key])
    return df.orderBy(F.md5(text), *[F.col(f"`{c}`") for c in key]).limit(n)


def value_profile(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """(column, value, n): how often each value stands in each column, nulls left out.

    Profiles add up: that of a month is the sum of its days' (`by` gives one per day).  All that
    drift needs of a set of rows follows from its profile.
    """
    keys = [by] if by else []
    names = F.array(*[F.lit(c) for c in columns])
    # Numbers as keys, so that rows are counted in the map tasks before they are shuffled.
    counted = df.select(*keys, F.posexplode(F.array(*[
        F.col(f"`{c}`").cast("double") for c in columns])).alias("_c", "value")).filter(
        "value is not null").groupBy(*keys, "_c", "value").agg(F.count("*").alias("n"))
    return counted.select(*keys, F.get(names, F.col("_c")).alias("column"), "value", "n")


def merged_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows behind several."""
    rows = profiles[0].select("column", "value", "n")
    for more in profiles[1:]:
        rows = rows.unionAll(more.select("column", "value", "n"))
    return rows.groupBy("column", "value").agg(F.sum("n").alias("n"))


def add_profile(df: DataFrame, path: str, day: str, columns: list[str] | None = None) -> None:
    """Store the profiles of the days in `df` under `path`; a day that is there is replaced.

    `df` holds whole days; only they are read and written.
    """
    names = [c for c in columns or DRIFT_FEATURES if c in df.columns]
    rows = value_profile(df.withColumn("day", F.date_format(F.col(f"`{day}`"), "yyyy-MM-dd")), names, "day")
    rows.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "day").parquet(path)


def stored_profile(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The profile of the stored days from `first` to `last`; other days are not read."""
    rows = spark.read.schema("column string, value double, n long, day string").parquet(path)
    if first is not None:
        rows = rows.filter(F.col("day") >= first)
    if last is not None:
        rows = rows.filter(F.col("day") <= last)
    return merged_profiles(rows)


def profile_drift(reference: DataFrame, current: DataFrame, limit: int = SMALL) -> DataFrame:
    """Kolmogorov-Smirnov gap and normalised Wasserstein distance per column of two profiles.

    Both come from the two distribution functions over the merged distinct values.  A column has
    drifted when the distance, in units of the reference spread, reaches `DISTANCE_LIMIT`.
    Columns without a value on either side have no row.
    """
    none = F.lit(0).cast("long")
    merged = materialize(
        reference.select("column", "value", F.col("n").alias("n_ref"), none.alias("n_cur")).unionAll(
            current.select("column", "value", none.alias("n_ref"), F.col("n").alias("n_cur")))
        .groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")), "drift-values")
    mean = F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref"))
    totals = materialize(merged.groupBy("column").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"), mean.alias("mean")), "drift-totals")
    small = F.broadcast(totals.filter("t_ref > 0 AND t_cur > 0"))      # one row per column
    steps = running_totals(merged, "value", ["n_ref", "n_cur"], group="column", limit=limit).join(small, "column")
    gap = F.abs((F.col("n_ref_before") + F.col("n_ref")) / F.col("t_ref")
                - (F.col("n_cur_before") + F.col("n_cur")) / F.col("t_cur"))
    away = F.col("value") - F.col("mean")
    scored = steps.groupBy("column").agg(
        F.max(gap).alias("ks"), F.sum(gap * (F.col("next_value") - F.col("value"))).alias("wasserstein"),
        F.sqrt(F.sum(away * away * F.col("n_ref")) / F.max("t_ref")).alias("spread"))
    scored = scored.withColumn("distance", F.coalesce("wasserstein", F.lit(0.0))
                               / F.greatest("spread", F.lit(SPREAD_FLOOR)))
    return scored.select("column", "ks", "distance",
                         (F.col("distance") >= DISTANCE_LIMIT).alias("drifted"))


def drift_scores(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                 limit: int = SMALL) -> DataFrame:
    """`profile_drift` of the profiles of two sets of rows; all rows count.

    Each side is read once; a sample can be passed in instead.
    """
    wanted = columns or DRIFT_FEATURES
    names = [c for c in wanted if c in reference.columns and c in current.columns]
    return profile_drift(value_profile(reference, names), value_profile(current, names), limit)


def drift_alert(scores: DataFrame, threshold: float = DEFAULTS.drift_threshold) -> DataFrame:
    """Share of drifted columns, and whether it calls for an alert."""
    return scores.agg(F.avg(F.col("drifted").cast("double")).alias("drift_share")).withColumn(
        "alert", F.coalesce(F.col("drift_share") > threshold, F.lit(False)))
