"""Validation gates on top of one-pass profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..errors import DataContractError
from ..schema import ENGINEERED_REQUIRED


def profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls and null share, in a single aggregate."""
    nulls = df.agg(F.count("*").alias("_rows"),
                   *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = nulls.unpivot("_rows", [F.col(f"`{c}`") for c in df.columns], "column", "nulls")
    return long.select("column", F.col("_rows").alias("n"), "nulls",
                       F.when(F.col("_rows") > 0, F.col("nulls") / F.col("_rows")).alias("null_pct"))


def gate_report(df: DataFrame, max_null_share: float = 0.5) -> DataFrame:
    """One row per raw gate with its measure and whether it passed."""
    facts = profile(df).agg(
        F.max("n").alias("rows"),
        F.max(F.when(F.col("column") == "InvoiceDate", F.col("n") - F.col("nulls"))).alias("dates"),
        F.max("null_pct").alias("worst"))
    return facts.select(F.explode(F.array(
        F.struct(F.lit("not_empty").alias("gate"), F.col("rows").cast("double").alias("measure"),
                 (F.col("rows") > 0).alias("passed")),
        F.struct(F.lit("some_dates").alias("gate"), F.col("dates").cast("double").alias("measure"),
                 (F.col("dates") > 0).alias("passed")),
        F.struct(F.lit("null_share").alias("gate"), F.col("worst").alias("measure"),
                 (F.coalesce("worst", F.lit(0.0)) <= max_null_share).alias("passed")))).alias("g")
    ).select("g.*")


def assert_raw(df: DataFrame, max_null_share: float = 0.5) -> None:
    """Raise when the raw lines are empty, undated or mostly null in a column."""
    rows = profile(df).collect()  # one row per column
    if not rows or rows[0]["n"] == 0:
        raise DataContractError("the dataset is empty")
    by_name = {r["column"]: r for r in rows}
    dates = by_name.get("InvoiceDate")
    if dates and dates["nulls"] == dates["n"]:
        raise DataContractError("every InvoiceDate is null")
    worst = max(rows, key=lambda r: r["null_pct"])
    if worst["null_pct"] > max_null_share:
        raise DataContractError(
            f"column {worst['column']} is {worst['null_pct']:.2%} null, allowed {max_null_share:.0%}")


def missing_features(df: DataFrame, required: list[str] = ENGINEERED_REQUIRED) -> list[str]:
    return [c for c in required if c not in df.columns]


def assert_features(df: DataFrame, max_null_share: float = 0.1) -> None:
    """Raise when an engineered column is missing or the line amount is mostly null."""
    missing = missing_features(df)
    if missing:
        raise DataContractError(f"missing engineered features: {missing}")
    facts = df.agg(F.count("*").alias("n"),
                   F.count_if(F.col("TotalAmount").isNull()).alias("nulls")).first()
    if facts["nulls"] > facts["n"] * max_null_share:
        raise DataContractError("TotalAmount has too many nulls")
