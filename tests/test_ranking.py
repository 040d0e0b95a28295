import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillgrain.operators import joins, ranking as rk
from tillgrain.operators.joins import attach
from tillgrain.session import materialize

rng = np.random.default_rng(3)


def skewed(n=3000):
    """A third of the rows share one value."""
    values = np.round(rng.normal(size=n), 2)
    values[: n // 3] = 0.5
    return pd.DataFrame({"v": rng.permutation(values), "k": [f"k{i:05d}" for i in range(n)]})


@pytest.mark.parametrize("limit", [1_000_000, 200])
def test_select_ranks(spark, limit):
    pdf = skewed()
    ordered = pdf.sort_values(["v", "k"]).reset_index(drop=True)
    df = spark.createDataFrame(pdf)
    ranks = [1, 777, 1500, 2999, 3000]
    by_value = rk.select_ranks(df, ["v"], ranks, limit=limit)
    by_both = rk.select_ranks(df, ["v", "k"], ranks, limit=limit)
    for rank, one, both in zip(ranks, by_value, by_both):
        value = ordered["v"][rank - 1]
        assert one["key"] == (value,)
        assert one["before"] == (pdf["v"] < value).sum() and one["equal"] == (pdf["v"] == value).sum()
        assert both["key"] == (value, ordered["k"][rank - 1]) and both["before"] == rank - 1


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_exact_quantiles(spark, limit):
    pdf = skewed()
    pdf["w"] = rng.integers(0, 10, len(pdf)).astype(float)
    got = rk.exact_quantiles(spark.createDataFrame(pdf), {"v": [0.1, 0.5, 0.995], "w": [0.25]}, limit)
    assert got["v"] == pytest.approx(np.quantile(pdf["v"], [0.1, 0.5, 0.995]), abs=1e-12)
    assert got["w"] == pytest.approx([np.quantile(pdf["w"], 0.25)])
    empty = spark.createDataFrame([], "v double")
    assert rk.exact_quantiles(empty, {"v": [0.5]}) == {"v": [None]}


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_average_and_row_ranks(spark, limit):
    pdf = skewed(1200)
    df = materialize(spark.createDataFrame(pdf))
    got = rk.with_average_rank(df, "v", "r", limit=limit)
    got = rk.with_average_rank(materialize(got), "v", "p", descending=True, percent=True, limit=limit)
    got = rk.with_row_rank(got, ["v", "k"], "n", limit=limit).toPandas().sort_values("k")
    assert got["r"].to_numpy() == pytest.approx(pdf["v"].rank().to_numpy())
    assert got["p"].to_numpy() == pytest.approx(pdf["v"].rank(ascending=False, pct=True).to_numpy())
    assert sorted(got["n"]) == list(range(1, 1201))
    assert got.sort_values("n")["k"].tolist() == pdf.sort_values(["v", "k"])["k"].tolist()


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_running_totals_by_group(spark, limit):
    pdf = pd.DataFrame({"g": ["a"] * 300 + ["b"] * 100, "v": list(range(300)) + list(range(100))})
    pdf["n"] = rng.integers(1, 5, len(pdf))
    got = rk.running_totals(spark.createDataFrame(pdf), "v", ["n"], group="g", limit=limit).toPandas()
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    expected = pdf.groupby("g")["n"].cumsum() - pdf["n"]
    assert got["n_before"].tolist() == expected.tolist()
    following = pdf.groupby("g")["v"].shift(-1)
    assert got["next_value"].fillna(-1).tolist() == following.fillna(-1).tolist()


def test_rank_at_most(spark):
    df = spark.createDataFrame(skewed(500))
    assert df.filter(rk.rank_at_most(df, ["v", "k"], 123)).count() == 123
    assert df.filter(rk.rank_at_most(df, ["v", "k"], 0)).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 50_000])
def test_attach_keeps_hot_null_and_unknown_keys(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast_rows)
    rows = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 50 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("k"), F.col("id") % 1500)))
    lookup = materialize(rows.filter("key is not null and key <> 'k7'").groupBy("key").agg(
        F.count("*").alias("n")).withColumn("size", F.col("n")))
    got = attach(rows, lookup, "key", "n")
    assert got.columns == ["id", "key", "size"] and got.count() == 3000
    plain = rows.join(lookup.select("key", "size"), "key", "left").select("id", "key", "size")
    assert got.exceptAll(plain).count() == 0
    assert got.filter("key = 'hot'").select("size").distinct().collect()[0][0] == 1000


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_half_split_by_a_range_of_the_leading_column(spark, limit):
    from tillgrain.sources.store import half_split
    pdf = skewed(1001)                       # the middle value is that of a third of the rows
    df = materialize(spark.createDataFrame(pdf))
    first, rest = half_split(df, ["v", "k"], limit)
    ordered = pdf.sort_values(["v", "k"])["k"].tolist()
    assert sorted(r["k"] for r in first.collect()) == sorted(ordered[:500])
    assert sorted(r["k"] for r in rest.collect()) == sorted(ordered[500:])
    for part in (first, rest):
        plan = part._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "PushedFilters: [" in plan and "ThanOrEqual(v," in plan.replace("LessThan(v", "")
    unknown = spark.createDataFrame([(None, f"n{k}") for k in range(5)] + [(1.0, "a"), (2.0, "b"), (2.0, "c")],
                                    "v double, k string")
    first, rest = half_split(unknown, ["v", "k"], limit)
    assert sorted(r["k"] for r in first.collect()) == ["n0", "n1", "n2", "n3"] and rest.count() == 4
    first, rest = half_split(unknown.filter("k in ('n0', 'a', 'b', 'c')"), ["v", "k"], limit)
    assert sorted(r["k"] for r in first.collect()) == ["a", "n0"]
    first, rest = half_split(unknown.limit(0), ["v", "k"], limit)
    assert first.count() == rest.count() == 0


def test_plans_do_not_grow_with_the_ranges(spark):
    sizes = set()
    for n in (400, 4000):
        df = materialize(spark.createDataFrame(skewed(n)))
        plan = rk.with_row_rank(df, ["v", "k"], "n", limit=10)._jdf.queryExecution().optimizedPlan().toString()
        sizes.add(plan.count("0.5") + plan.count("array("))
    assert sizes == {0}
