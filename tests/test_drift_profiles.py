"""Drift from stored profiles: sums of days, single days, empty and constant sides."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrain.operators import drift
from tillgrain.session import scratch_path


def made(spark, days=4, n=300):
    draw = np.random.default_rng(2)
    rows = [(datetime.datetime(2024, 1, 1 + d, 5), float(round(x, 1)), float(d) if k % 7 else None)
            for d in range(days) for k, x in enumerate(draw.normal(d, 2, n))]
    return spark.createDataFrame(rows, "InvoiceDate timestamp, Price double, Quantity double")


def plain(a, b):
    a, b = np.sort(a), np.sort(b)
    values = np.unique(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(a, values, "right") / len(a) - np.searchsorted(b, values, "right") / len(b))
    return gap.max(), (gap[:-1] * np.diff(values)).sum() / max(a.std(), drift.SPREAD_FLOOR)


def scores(frame):
    return {r["column"]: (r["ks"], r["distance"]) for r in frame.collect()}


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_days_add_up_to_the_whole(spark, limit):
    df, path = made(spark), scratch_path(spark, "profiles")
    early, late = df.filter("InvoiceDate < '2024-01-03'"), df.filter("InvoiceDate >= '2024-01-03'")
    for day in (1, 2, 3, 4):                                   # one day at a time
        drift.add_profile(df.filter(F.dayofmonth("InvoiceDate") == day), path, "InvoiceDate")
    drift.add_profile(df.filter(F.dayofmonth("InvoiceDate") == 2), path, "InvoiceDate")      # again
    reference, current = (drift.stored_profile(spark, path, last="2024-01-02"),
                          drift.stored_profile(spark, path, first="2024-01-03"))
    found = scores(drift.profile_drift(reference, current, limit))
    whole = scores(drift.drift_scores(early, late, ["Price", "Quantity"], limit))
    for column in ("Price", "Quantity"):
        a, b = ([r[0] for r in side.select(column).collect() if r[0] is not None] for side in (early, late))
        assert found[column] == pytest.approx(plain(a, b)) and whole[column] == pytest.approx(plain(a, b))


def test_a_day_is_read_alone(spark):
    df, path = made(spark), scratch_path(spark, "profiles")
    drift.add_profile(df, path, "InvoiceDate")
    one = drift.stored_profile(spark, path, "2024-01-02", "2024-01-02")
    plan = one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(day" in plan
    assert one.filter("column = 'Price'").agg(F.sum("n")).first()[0] == 300


def test_edges(spark):
    df = made(spark)
    nothing = df.limit(0)
    assert drift.drift_scores(df, nothing).count() == drift.drift_scores(nothing, df).count() == 0
    alert = drift.drift_alert(drift.drift_scores(nothing, df)).first()
    assert alert["drift_share"] is None and alert["alert"] is False
    constant = df.withColumn("Price", F.lit(5.0)).withColumn("Quantity", F.lit(None).cast("double"))
    assert scores(drift.drift_scores(constant, constant)) == {"Price": (0.0, 0.0)}
    total = drift.merged_profiles(drift.value_profile(df, ["Price"]), drift.value_profile(df, ["Price"]))
    assert total.agg(F.sum("n")).first()[0] == 2 * df.count()
