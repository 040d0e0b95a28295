"""Continuous request metrics. Each works on a batch or a streaming frame of requests.

A request has (ts, method, endpoint, status, seconds).  Aggregates keep one small
state per window and endpoint: counters only, never the requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch, scratch_path
from .upsert import Keyed, Store

WATERMARK = "10 minutes"

# Upper bounds of the latency buckets in seconds.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def requests_from_events(events: DataFrame) -> DataFrame:
    """The events table as a request log; an `error` event is a failed request."""
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit("GET").alias("method"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        F.col("value").alias("seconds"))


def request_counts(requests: DataFrame) -> DataFrame:
    """Requests by method, endpoint and status since the start."""
    return requests.groupBy("method", "endpoint", "status").agg(F.count("*").alias("requests"))


def _bucket_counts(bounds: list[float]) -> list[Column]:
    return [F.count_if(F.col("seconds") <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]


def latency_histogram(requests: DataFrame, bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative counts per latency bound, count and sum, by method and endpoint."""
    wide = requests.groupBy("method", "endpoint").agg(
        *_bucket_counts(bounds), F.count("*").alias("requests"),
        F.sum(F.col("seconds").cast("decimal(18,6)")).cast("double").alias("total_seconds"))
    buckets = F.array(*[F.struct(F.lit(str(b)).alias("le"), F.col(f"le_{i}").alias("n"))
                        for i, b in enumerate(bounds)],
                      F.struct(F.lit("+Inf").alias("le"), F.col("requests").alias("n")))
    return wide.select("method", "endpoint", F.explode(buckets).alias("b"), "total_seconds").select(
        "method", "endpoint", "b.le", "b.n", "total_seconds")


def request_rate(requests: DataFrame) -> DataFrame:
    """Requests per second in each minute, by endpoint."""
    return (requests.withWatermark("ts", WATERMARK)
            .groupBy(F.window("ts", "1 minute"), "endpoint").agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("start"), "endpoint", (F.col("n") / 60).alias("rate")))


def latency_quantile(requests: DataFrame, q: float = 0.95,
                     bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """Latency quantile of the last five minutes, every minute, by endpoint.

    Interpolated inside the latency bucket that holds the quantile; beyond the last
    bound it is that bound.  The state is one counter per bucket.
    """
    counted = (requests.withWatermark("ts", WATERMARK)
               .groupBy(F.window("ts", "5 minutes", "1 minute"), "endpoint")
               .agg(*_bucket_counts(bounds), F.count("*").alias("n")))
    target = F.col("n") * F.lit(q)
    value = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = bounds[i - 1] if i else 0.0
        under = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"le_{i}") - under
        # An empty bucket is never the first one that reaches the target.
        point = F.lit(low) + (bounds[i] - low) * F.try_divide(target - under, inside)
        value = F.when(F.col(f"le_{i}") >= target, point).otherwise(value)
    return counted.select(F.col("window.start").alias("start"), "endpoint", value.alias("quantile"))


def error_ratio(requests: DataFrame) -> DataFrame:
    """Failures over requests of the last five minutes, every minute.

    `error_ratio` divides counts.  `panel_ratio` divides rates per second, the total
    rate being at least 1, so it stays small while traffic is low.
    """
    counted = (requests.withWatermark("ts", WATERMARK)
               .groupBy(F.window("ts", "5 minutes", "1 minute"))
               .agg(F.count_if(F.col("status").startswith("5")).alias("failures"),
                    F.count("*").alias("requests")))
    return counted.select(
        F.col("window.start").alias("start"), "failures", "requests",
        (F.col("failures") / F.greatest("requests", F.lit(1))).alias("error_ratio"),
        ((F.col("failures") / 300) / F.greatest(F.col("requests") / 300, F.lit(1.0))).alias("panel_ratio"))


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Latest value per (model, metric) of a (model, metric, value, ts) stream."""
    latest = F.max(F.struct(F.col("ts"), F.col("value")))
    return metrics.groupBy("model", "metric").agg(latest.alias("_l")).select(
        "model", "metric", F.col("_l.value").alias("value"))


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a streaming aggregate over all data available now; return its final state.

    Every batch overwrites one stored table with the complete result, so a repeated
    batch after a failure changes nothing and nothing passes through the driver.  This is
    for results of a few rows without windows; windows go through `run_windows`.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-progress")

    def keep(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = (stream.writeStream.outputMode("complete").foreachBatch(keep)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def window_table(keys: list[str], values: list[str]) -> Keyed:
    """The stored results of a windowed aggregate, a bucket per day of `start`."""
    # Of two results for a window the later one counts: its batch saw more requests.
    def latest(column):
        return F.max_by(column, "batch")
    return Keyed("windows", keys, F.date_format("start", "yyyy-MM-dd"),
                 {**{v: latest for v in values}, "batch": F.max})


def start_windows(stream: DataFrame, keys: list[str], root: str):
    """Write a windowed aggregate in update mode to a store under `root`.

    A batch brings only the windows it has changed; these replace their earlier results, by key,
    and all others are left as they are.  A repeated batch starts from the version before it, so it
    changes nothing.  The state of the stream ends with the watermark, the store keeps all windows.
    """
    table = window_table(keys, [c for c in stream.columns if c not in keys])

    def merge(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, root)
        update = store.begin(batch_id)
        with scratch(batch.sparkSession):
            update.upsert(table, batch.withColumn("batch", F.lit(batch_id).cast("long")))
        update.commit()
        store.vacuum()

    return (stream.writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start())


def stored_windows(spark: SparkSession, root: str, stream: DataFrame) -> DataFrame:
    """The newest result of every window."""
    found = Store(spark, root).read("windows")
    return spark.createDataFrame([], stream.schema) if found is None else found.select(*stream.columns)


def run_windows(stream: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run a windowed aggregate over all data available now; return its windows."""
    spark = stream.sparkSession
    root = scratch_path(spark, label)
    start_windows(stream, keys, root).awaitTermination()
    return stored_windows(spark, root, stream)
