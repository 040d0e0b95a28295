import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillgrain.operators import attribution, churn, dbscan, drift, evaluate, forecast as fc, joins, segment as sg
from tillgrain.operators.components import connected_components
from tillgrain.schema import CHURN_FEATURES, Settings
from tillgrain.session import materialize

rng = np.random.default_rng(5)


def brute_dbscan(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label = -np.ones(len(x), int)
    found = 0
    for i in np.where(core)[0]:
        if label[i] < 0:
            todo = [i]
            label[i] = found
            while todo:
                for v in np.where(near[todo.pop()] & core)[0]:
                    if label[v] < 0:
                        label[v] = found
                        todo.append(v)
            found += 1
    out = label.copy()
    for i in np.where(~core)[0]:
        reach = label[near[i] & core]
        out[i] = reach.min() if len(reach) else -1
    return out


@pytest.mark.parametrize("direct", [dbscan.DIRECT_PAIRS, 0])
def test_dbscan_matches_brute_force(spark, monkeypatch, direct):
    monkeypatch.setattr(dbscan, "SLOT_ROWS", 40)     # several slots per full cell
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0 if direct else joins.BROADCAST_ROWS)
    x = np.round(np.concatenate([rng.normal(size=(150, 3)) * 2, rng.normal(size=(150, 3)) * 0.2 + 3,
                                 np.zeros((60, 3))]), 6)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["id"] = [f"{i:05d}" for i in range(len(x))]
    got = dbscan.dbscan(spark.createDataFrame(pdf), "id", ["a", "b", "c"], 0.8, 5, direct).toPandas()
    assert got.sort_values("id")["cluster"].tolist() == brute_dbscan(x, 0.8, 5).tolist()


def test_connected_components(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    star = [("z0", f"z{i}") for i in range(1, 9)]
    got = dict(connected_components(spark.createDataFrame(chain + star, "a string, b string")).collect())
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert {got[f"z{i}"] for i in range(9)} == {"z0"}


def churn_frame(spark, n=400):
    pdf = pd.DataFrame(rng.normal(size=(n, len(CHURN_FEATURES))), columns=CHURN_FEATURES)
    pdf["Customer ID"] = [f"c{i:04d}" for i in range(n)]
    pdf["ChurnFlag"] = ((pdf["AvgOrderValue"] + pdf["SeasonalIndex"] > 0.3)).astype(int)
    return materialize(spark.createDataFrame(pdf))


def test_churn_model_and_exact_attribution(spark):
    rows = evaluate.stratified_split(churn_frame(spark), "ChurnFlag", "Customer ID")
    rows = materialize(rows)
    model = churn.fit_churn(rows.filter("part = 'train'"), Settings(churn_trees=6, churn_depth=3, churn_rate=0.3))
    scored = churn.score_churn(model, rows)
    assert evaluate.roc_auc(scored.filter("part = 'test'"), "ChurnFlag", "churn_probability").first()[0] > 0.8
    inputs = churn.model_inputs(rows)
    parts = attribution.attribute(model, rows, "Customer ID", inputs)
    from pyspark.ml.feature import VectorAssembler
    raw = model.transform(VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)).select(
        "Customer ID", vector_to_array("rawPrediction")[1].alias("raw"))
    gap = parts.join(raw, "Customer ID").agg(F.max(F.abs(F.col("margin") - F.col("raw")))).first()[0]
    assert gap < 1e-9 or parts.join(raw, "Customer ID").agg(
        F.max(F.abs(2 * F.col("margin") - F.col("raw")))).first()[0] < 1e-9


def test_shapley_against_all_orders():
    leaves = [(1.0, [(0, -math.inf, 0.0, 0.4), (1, -math.inf, 1.0, 0.5)]), (3.0, [(0, 0.0, math.inf, 0.6)]),
              (-2.0, [(0, -math.inf, 0.0, 0.4), (1, 1.0, math.inf, 0.5)]), (0.5, [(2, 0.0, 2.0, 0.3)])]
    x = np.array([[-1.0, 0.5, 1.0], [1.0, 2.0, -1.0], [-1.0, 2.0, 3.0]])

    def worth(row, inside):
        return sum(value * math.prod((float(lo < row[f] <= hi) if f in inside else cover)
                                     for f, lo, hi, cover in rules) for value, rules in leaves)

    phi, base = attribution.shapley_values(x, leaves, 3)
    for row, got in zip(x, phi):
        expected = np.zeros(3)
        for order in itertools.permutations(range(3)):
            seen = set()
            for f in order:
                expected[f] += (worth(row, seen | {f}) - worth(row, seen)) / 6
                seen.add(f)
        assert got == pytest.approx(expected)
        assert base + got.sum() == pytest.approx(worth(row, {0, 1, 2}))


@pytest.mark.parametrize("limit", [1_000_000, 30])
def test_scores(spark, limit):
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 300), "s": rng.integers(0, 60, 300) / 10.0,
                        "id": [f"{i:03d}" for i in range(300)]})
    df = materialize(spark.createDataFrame(pdf))
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    pairs = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    assert evaluate.roc_auc(df, "y", "s", limit).first()[0] == pytest.approx(pairs)
    top = pdf.sort_values(["s", "id"], ascending=[False, True]).head(60).y.mean()
    assert evaluate.precision_at_top(df, "y", "s", "id", limit=limit).first()[0] == pytest.approx(top)
    parts = evaluate.stratified_split(df, "y", "id", limit=limit).groupBy("y", "part").count().collect()
    for r in parts:
        n = int((pdf.y == r["y"]).sum())
        assert r["count"] == (math.ceil(0.2 * n) if r["part"] == "test" else n - math.ceil(0.2 * n))


def test_precision_without_positives_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    assert evaluate.precision(df, "y", F.col("p") == 1).first()[0] == 0.0
    report = {r["class"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert report["1"]["precision"] == 0.0 and report["accuracy"]["f1"] == 1.0


def test_kmeans_and_names(spark):
    pdf = pd.DataFrame({"Customer ID": [str(i) for i in range(90)]})
    for i, c in enumerate(sg.RFM):
        pdf[c] = np.repeat([0.0, 5.0, 10.0], 30) + rng.normal(size=90) * 0.1 + i
    scaled = materialize(sg.standard_scale(spark.createDataFrame(pdf)))
    settings = Settings(kmeans_clusters=3)
    costs = [sg.fit_kmeans(scaled, settings, starts=s).cost for s in (1, 3)]
    assert costs[1] <= costs[0] + 1e-9
    named = sg.name_clusters(sg.assign_kmeans(sg.fit_kmeans(scaled, settings, starts=2), scaled)).toPandas()
    assert named.groupby("KMeansSegment").size().tolist() == [30, 30, 30]
    assert named.sort_values("monetary")["SegmentLabel"].iloc[0] == "Budget Shoppers"


def test_forecast_frames(spark):
    days = pd.date_range("2021-01-01", periods=120)
    pdf = pd.DataFrame({"series": "a", "ds": days.date, "y": 100 + np.arange(120) + 10 * np.sin(np.arange(120) * 2 * np.pi / 7)})
    series = materialize(spark.createDataFrame(pdf, "series string, ds date, y double"))
    sup = fc.supervised_frame(series).toPandas()
    assert len(sup) == 106 and sup["lag_14"].iloc[0] == pytest.approx(pdf["y"].iloc[0])
    assert sup["rolling_7"].iloc[0] == pytest.approx(pdf["y"].iloc[7:14].mean(), abs=1e-5)
    parts = fc.chronological_split(series)
    assert parts.filter("part = 'train'").count() == 102
    test = parts.filter("part = 'test'")
    got = fc.trend_season_forecast(parts.filter("part = 'train'"), test).join(test, ["series", "ds"])
    assert fc.guarded_errors(got, ["series"]).first()["mape"] < 5
    ahead = fc.future_forecast(series, 10).toPandas()
    assert len(ahead) == 10 and str(ahead["ds"].min()) == "2021-05-01"
    with pytest.raises(ValueError):
        fc.future_days(series, 91)
    padded = fc.align_predictions(test, test.filter("ds > '2021-04-20'").withColumn("yhat", F.col("y")).select(
        "series", "ds", "yhat")).orderBy("ds").toPandas()
    assert padded["yhat"].iloc[0] == pytest.approx(pdf["y"].iloc[110])


def test_drift(spark):
    same = spark.range(500).select(F.col("id").cast("double").alias("Quantity"), (F.col("id") % 7).alias("Price"))
    moved = same.withColumn("Price", F.col("Price") + 3)
    scores = {r["column"]: r for r in drift.drift_scores(same, moved, limit=100).collect()}
    assert scores["Quantity"]["ks"] == 0 and not scores["Quantity"]["drifted"]
    assert scores["Price"]["drifted"] and scores["Price"]["distance"] == pytest.approx(3 / 2.0, rel=0.01)
    alert = drift.drift_alert(drift.drift_scores(same, moved)).first()
    assert alert["drift_share"] == 0.5 and alert["alert"]


def test_models_without_predictions_get_no_weight(spark):
    from tillgrain.operators.forecast import blend, ensemble_weights

    errors = spark.createDataFrame([("s", "a", 10.0), ("s", "b", None)], "series string, model string, mape double")
    weights = ensemble_weights(errors)
    assert [(r["model"], r["weight"]) for r in weights.collect()] == [("a", 1.0)]
    predictions = spark.createDataFrame([("s", "2021-01-01", "a", 100.0)],
                                        "series string, ds string, model string, yhat double")
    assert blend(predictions, weights).first()["yhat"] == 100.0


def test_a_search_does_not_depend_on_how_many_trials_run_at_once(spark):
    pdf = pd.DataFrame({"Customer ID": [f"{i:03d}" for i in range(240)], "CustomerLifetimeValue": rng.normal(size=240),
                        "PurchaseFrequency": rng.normal(size=240)})
    pdf["ChurnFlag"] = (pdf["CustomerLifetimeValue"] + 0.5 * rng.normal(size=240) > 0).astype(int)
    train = materialize(spark.createDataFrame(pdf))
    one, four = (churn.search_churn(train, trials=4, trees=(2, 4), parallel=n) for n in (1, 4))
    assert [t["roc_auc"] for t in one] == sorted((t["roc_auc"] for t in one), reverse=True)
    same = {t["trial"]: t for t in four}
    for trial in one:
        other = same[trial["trial"]]
        assert other.pop("roc_auc") == pytest.approx(trial["roc_auc"], abs=0.03)
        assert other == {k: v for k, v in trial.items() if k != "roc_auc"}
    assert sorted(t["trial"] for t in one) == [0, 1, 2, 3] and one[0]["roc_auc"] > 0.8
    assert len(churn.search_trials(Settings(), 30, (200, 600))) == 30


def test_box_of_a_column_without_values(spark):
    from tillgrain.operators.reports import box_summary
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None)], "a double, b double")
    found = {r["column"]: r for r in box_summary(df, ["a", "b"]).collect()}
    assert found["a"]["median"] == 2.0 and found["b"]["median"] is None and found["b"]["outliers"] == 0


def test_the_registered_churn_models_are_fitted_with_all_trees(spark, monkeypatch):
    from tillgrain.catalog import model_queries as queries
    rows, fitted = churn_frame(spark, 40).withColumn("part", F.lit("train")), []
    monkeypatch.setattr(queries, "churn_rows", lambda s, d: rows)
    monkeypatch.setattr(churn, "fit_churn", lambda train, settings, exclude_leaky=False: fitted.append(
        (train.count(), settings, exclude_leaky)))
    queries.churn_model(spark, "all-trees"), queries.honest_model(spark, "all-trees")
    assert [(n, s.churn_trees, s.churn_depth, s.churn_rate, x) for n, s, x in fitted] == [
        (40, 400, 5, 0.03, False), (40, 400, 5, 0.03, True)]
