"""Gap-free calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def fill_calendar(daily: DataFrame, day: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Every day from first to last of each series; missing days hold 0."""
    keys = keys or []
    span = daily.groupBy(*keys).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    calendar = (span.filter("_a is not null")
                .select(*keys, F.explode(F.sequence("_a", "_b")).alias(day)))
    return (calendar.join(daily.select(*keys, day, value), [*keys, day], "left")
            .withColumn(value, F.coalesce(value, F.lit(0.0))))
