"""Joins, first values and ranks that do not sort every line."""

import datetime

from pyspark.sql import functions as F

from tillgrain.operators import features as ft, joins, ranking as rk
from tillgrain.session import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_lookups_are_hashed_not_sorted(spark, monkeypatch):
    rows = materialize(spark.range(1000).select((F.col("id") % 700).cast("string").alias("k"), "id"))
    lookup = materialize(rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    spread = joins.attach(rows, lookup, "k", "n")
    assert "ShuffledHashJoin" in plan(spread) and "SortMergeJoin" not in plan(spread)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 20)
    whole = joins.attach(rows, lookup, "k", "n")               # narrow rows: more of them fit
    assert "ShuffledHashJoin" not in plan(whole)
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, whole.collect()))


def test_first_values_by_time(spark):
    day = [datetime.datetime(2021, 1, d) for d in range(1, 5)]
    rows = materialize(spark.createDataFrame([
        ("a", day[1], 2, None, "x"), ("a", day[1], 1, 5, "y"), ("a", day[0], 9, None, None), ("b", day[3], 1, None, "z"),
        ("b", None, 7, 4, None), (None, day[2], 1, 1, "n"), (None, day[1], 1, 2, None)],
        "c string, t timestamp, o int, v int, CustomerSegment string"))
    found = ft.first_per_key(rows, "c", ["v", "CustomerSegment"], ["t", "o"])
    assert any("/heads-" in f for f in found.inputFiles())
    want = {"a": (5, "y"), "b": (4, "z"), None: (2, "n")}
    assert {r["c"]: (r["v"], r["CustomerSegment"]) for r in found.collect()} == want


def test_row_ranks_come_from_the_sort(spark):
    df = materialize(spark.range(500).select((F.col("id") * 7 % 500).alias("v"), "id"))
    ranked = rk.with_row_rank(df, ["v"], "n", limit=10)
    assert plan(ranked).split("Initial Plan")[-1].count("Exchange rangepartitioning") == 0
    assert "row_number" not in plan(ranked)
    assert ranked.filter("n <> v + 1").isEmpty() and ranked.count() == 500
