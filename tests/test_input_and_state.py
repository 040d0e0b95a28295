"""What the lines are read from and stored in: one pass over the tables, one shuffle per rewritten bucket."""

import pytest
from pyspark.sql import functions as F

from tillgrain.catalog.fixtures import dirty_transactions
from tillgrain.operators import clean as cl
from tillgrain.streaming import incremental as inc
from tillgrain.streaming.upsert import Keyed

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_joined_once(spark):
    made = dirty_transactions(spark, SF, "copy")
    assert plan(made).count("l_linenumber#") > 0 and plan(made).count("Union") == 0
    twice = made.filter("copy = 1").drop("copy")
    assert twice.filter("cast(Invoice as long) % 100 <> 0").isEmpty()
    plain = dirty_transactions(spark, SF)
    first = made.filter("copy = 0").drop("copy")
    assert plain.count() == first.count() + twice.count() and first.exceptAll(plain).isEmpty()


def test_a_merge_shuffles_once(spark):
    table = Keyed("sums", ["k"], F.pmod(F.col("k"), F.lit(3)).cast("string"), {"n": F.sum})
    merged = table.merged(table.placed(spark.createDataFrame([(1, 2), (1, 3), (None, 1), (None, 4)], "k long, n long")))
    assert plan(merged).count("Exchange") == 1
    assert {r["k"]: r["n"] for r in merged.collect()} == {1: 5, None: 5}


def test_buckets_grow_with_the_lines():
    assert inc.Layout.sized(1000, 80) == inc.Layout(1, 4)
    assert inc.Layout.sized(216_000_000, 80) == inc.Layout(3, 216)


@pytest.mark.parametrize("repeated", [0, 10])
def test_only_repeated_lines_are_ordered(spark, monkeypatch, repeated):
    monkeypatch.setattr(cl, "REPEATED", repeated)
    rows = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (None, 1, "c"), (2, 2, "d"), (2, 2, None)], "x int, y int, o string")
    got = {(r["x"], r["y"], r["o"]) for r in cl.dedupe_lines(rows, ["x", "y"], ["o"]).collect()}
    assert got == {(1, None, "a"), (None, 1, "c"), (2, 2, None)}
    alone = rows.filter("o in ('d')")
    assert "Window" not in plan(cl.dedupe_lines(alone, ["x", "y"], ["o"]))
