"""Sinks and small stored results: parquet, CSV tables, metrics, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import SMALL, split_rules
from ..schema import ROW_ORDER
from ..session import session_setting
from .ingest import path_exists

OPEN_FILES = 120        # months that a task writes side by side
METRIC_SCHEMA = "model string, metric string, value double"


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_feature_store(features: DataFrame, path: str) -> None:
    """The feature table by year and month of the invoice date.

    Rows are not moved: each task writes the months it meets, a file of each, so a month with most of the
    sales is written by all tasks.  A task holds `OPEN_FILES` of them open and sorts the rows of any further ones.
    """
    spark = features.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = features.withColumns({"year": F.year("InvoiceDate"), "month": F.month("InvoiceDate")})
    with session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        parted.coalesce(width).write.mode("overwrite").partitionBy("year", "month").parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A headered CSV table; `single_file` is for small aggregates only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(
        header=True, escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long (model, metric, value) rows as JSON lines."""
    metrics.selectExpr("model", "metric", "cast(value as double) value").write.mode(
        "overwrite").json(path)


def read_metrics(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Metrics of every model that has been written; missing ones are skipped."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], METRIC_SCHEMA)
    return spark.read.schema(METRIC_SCHEMA).json(found)


def metrics_frame(spark: SparkSession, metrics: dict[str, dict[str, float]]) -> DataFrame:
    """Driver-side metric scalars as long rows."""
    rows = [(model, name, float(value)) for model, values in metrics.items()
            for name, value in values.items()]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def first_rows(df: DataFrame, order: list, limit: int) -> DataFrame:
    """The first `limit` rows in an explicit order, with their count on each row."""
    rows = df.orderBy(*order).limit(limit)
    return rows.withColumn("count", F.least(df.agg(F.count("*")).scalar(), F.lit(limit)))


def half_split(df: DataFrame, order: list[str] = ROW_ORDER, limit: int = SMALL
               ) -> tuple[DataFrame, DataFrame]:
    """First half and rest of the rows, in row order.

    The split is a range of the leading column (the date), which reaches the file scan;
    only rows at its very end are compared by their whole keys.  Nothing is sorted as a whole.
    """
    first, rest = split_rules(df, order, df.count() // 2, limit)
    return df.filter(first), df.filter(rest)


def reference_snapshot(features: DataFrame, path: str) -> DataFrame:
    """The drift reference: stored once as the first half of the rows, then reused."""
    spark = features.sparkSession
    if not path_exists(spark, path):
        first, _ = half_split(features)
        first.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
