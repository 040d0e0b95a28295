"""Forecasting, segmentation, churn, attribution and drift."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window, functions as F

from ..operators.kmeans import Centres
from ..operators import (attribution, churn, dbscan, drift, evaluate, features as ft, forecast as fc,
                         segment as sg)
from ..plans import training
from ..schema import DEFAULTS, DRIFT_FEATURES
from ..session import materialize, scratch_path
from ..sources import store
from .base_queries import lines
from .base_sql import ORDER, money
from .data import features, remembered, stored
from .spec import Query

# The forecast's boosted trees are registered with 15 trees instead of the default 300 and the search with few
# trials, which take minutes on one machine (README); the churn models and all other settings are whole.
TREES = replace(DEFAULTS, boost_trees=15, boost_depth=4, boost_rate=0.2)
SEARCH = {"trials": 6, "trees": (5, 12)}


# ---- forecasting -----------------------------------------------------------------

def series_all(spark, sf):
    return stored(spark, sf, "series-all", lambda: fc.daily_series(lines(spark, sf)))


def series_by_country(spark, sf):
    return stored(spark, sf, "series-country", lambda: fc.daily_series(lines(spark, sf), "Country"))


def split_days(spark, sf):
    return fc.chronological_split(series_by_country(spark, sf))


def given_predictions(spark, sf):
    """Three simple predictions of each test day: the values 1, 7 and 14 days before."""
    frame = fc.supervised_frame(series_by_country(spark, sf))
    test = split_days(spark, sf).filter("part = 'test'").select("series", "ds")
    rows = frame.join(test, ["series", "ds"])
    return rows.unpivot(["series", "ds", "y"], ["lag_1", "lag_7", "lag_14"], "model", "yhat")


def given_errors(spark, sf):
    return fc.guarded_errors(given_predictions(spark, sf), ["series", "model"])


def given_blend(spark, sf):
    weights = fc.ensemble_weights(given_errors(spark, sf))
    return fc.blend(given_predictions(spark, sf), weights)


def alignment(spark, sf):
    """Predictions that miss the first days of the test window are padded."""
    test = split_days(spark, sf).filter("part = 'test'").select("series", "ds")
    some = given_predictions(spark, sf).filter("model = 'lag_1'").filter(F.dayofmonth("ds") > 12)
    return fc.align_predictions(test, some.select("series", "ds", "yhat"))


def trend_forecast(spark, sf):
    parts = split_days(spark, sf)
    return fc.trend_season_forecast(parts.filter("part = 'train'"), parts.filter("part = 'test'"))


def hybrid(spark, sf):
    return remembered(spark, sf, "hybrid", lambda: training.fit_forecaster(series_by_country(spark, sf), TREES))


def saved_trend(spark, sf):
    """Days to come, and those where a stored and reread model says something else than a fresh fit."""
    series = series_by_country(spark, sf)
    path = scratch_path(spark, "trend")
    store.write_parquet(fc.trend_models(series), path)
    days = fc.future_days(series, 30)
    fresh = fc.trend_season_forecast(series, days).withColumnsRenamed({"yhat": "a", "yhat_lower": "b"})
    again = fc.trend_predict(spark.read.parquet(path), days)
    return fresh.join(again, ["series", "ds"]).agg(F.count("*").alias("days"), F.count_if(
        (F.abs(F.col("yhat") - F.col("a")) > 1e-6) | (F.abs(F.col("yhat_lower") - F.col("b")) > 1e-6)).alias("other"))


def boosted_dates(spark, sf):
    """Answered days where one series is too short for any lag on its test days."""
    series = series_by_country(spark, sf)
    first = series.agg(F.min("series")).scalar()
    place = F.row_number().over(Window.partitionBy("series").orderBy("ds"))
    cut = materialize(series.withColumn("_first", F.col("series") == first).withColumn("_k", place).filter(
        "not _first OR _k <= 30"), "cut")
    days = cut.filter("_first AND _k > 25").select("series", "ds").unionByName(
        test_days(spark, sf).filter(F.col("series") != first))
    # Its last days have no lags: the rows of these days are taken away.
    frame = materialize(fc.supervised_frame(cut.select("series", "ds", "y")).join(
        cut.filter("_first AND _k > 25").select("series", "ds"), ["series", "ds"], "left_anti"), "supervised")
    found = fc.boosted_lag_forecast(frame, days, hybrid(spark, sf).boosted)
    return found.groupBy("series", "ds").agg(F.count("yhat").alias("answers"))


def recurrent_facts(spark, sf):
    losses = hybrid(spark, sf).sequence.losses
    return spark.createDataFrame([("sequence", "training error", int(min(losses) <= losses[0]))],
                                 "model string, metric string, not_worse int")


SERIES_SQL = """fday AS (SELECT KEY AS series, sales_date AS ds, CAST(sum(CAST("TotalAmount" AS DECIMAL(18,6))) AS DOUBLE) AS v
    FROM lines GROUP BY ALL),
  fcal AS (SELECT series, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds
    FROM (SELECT series, min(ds) AS a, max(ds) AS b FROM fday GROUP BY series)),
  ffill AS (SELECT c.series, c.ds, coalesce(v, 0.0) AS v FROM fcal c LEFT JOIN fday f ON c.series = f.series AND c.ds = f.ds),
  fser AS (SELECT series, ds, CAST(sum(CAST(v AS DECIMAL(18,6))) OVER w AS DOUBLE) / count(*) OVER w AS y FROM ffill
    WINDOW w AS (PARTITION BY series ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""
ALL_SQL = SERIES_SQL.replace("KEY", "'all'")
COUNTRY_SQL = SERIES_SQL.replace("KEY", '"Country"')


def _supervised_sql(first, last):
    return f"""fsup AS (SELECT * FROM (SELECT series, ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7, lag(y, 14) OVER w AS lag_14,
      CAST(sum(CAST(y AS DECIMAL(18,6))) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN {6 + first} PRECEDING AND {last}) AS DOUBLE)
        / count(*) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN {6 + first} PRECEDING AND {last}) AS rolling_7,
      CAST(sum(CAST(y AS DECIMAL(18,6))) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN {29 + first} PRECEDING AND {last}) AS DOUBLE)
        / count(*) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN {29 + first} PRECEDING AND {last}) AS rolling_30,
      isodow(ds) - 1 AS day_of_week, month(ds) AS month FROM fser WINDOW w AS (PARTITION BY series ORDER BY ds))
    WHERE lag_14 IS NOT NULL)"""


SPLIT_SQL = """fsplit AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY ds)
      <= floor(count(*) OVER (PARTITION BY series) * CAST(0.85 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM fser)"""
GIVEN_SQL = f"""WITH {COUNTRY_SQL}, {_supervised_sql(1, '1 PRECEDING')}, {SPLIT_SQL},
  fgiven AS (SELECT s.series, s.ds, s.y, m.model, CASE m.model WHEN 'lag_1' THEN lag_1 WHEN 'lag_7' THEN lag_7 ELSE lag_14 END AS yhat
    FROM fsup s JOIN fsplit p ON s.series = p.series AND s.ds = p.ds AND p.part = 'test'
    CROSS JOIN (VALUES ('lag_1'), ('lag_7'), ('lag_14')) AS m(model)),
  ferr AS (SELECT series, model, avg(abs(y - yhat) / greatest(abs(y), p5)) * 100 AS mape, avg(abs(y - yhat)) AS mae
    FROM (SELECT *, quantile_cont(y, 0.05) OVER (PARTITION BY series, model) AS p5 FROM fgiven) GROUP BY ALL),
  fweight AS (SELECT series, model, mape, (1 / greatest(mape, 1)) / sum(1 / greatest(mape, 1)) OVER (PARTITION BY series) AS weight FROM ferr)
RESULT
"""
SUPERVISED = "series:s, ds:d, y:2, lag_1:2, lag_7:2, lag_14:2, rolling_7:2, rolling_30:2, day_of_week:i, month:i"


# ---- segmentation -----------------------------------------------------------------

def scaled_rfm(spark, sf):
    return stored(spark, sf, "scaled-rfm", lambda: sg.standard_scale(
        materialize(ft.rfm_matrix(lines(spark, sf)), "rfm")))


SCALED = [f"{c}_scaled" for c in sg.RFM]


def kmeans(spark, sf):
    return remembered(spark, sf, "kmeans", lambda: sg.fit_kmeans(scaled_rfm(spark, sf)))


def clustered(spark, sf):
    return stored(spark, sf, "clustered", lambda: sg.assign_kmeans(kmeans(spark, sf), scaled_rfm(spark, sf)))


def kmeans_model_round_trip(spark, sf):
    path = scratch_path(spark, "kmeans")
    kmeans(spark, sf).save(spark, path)
    return sg.assign_kmeans(Centres.load(spark, path), scaled_rfm(spark, sf))


def nearest_means(spark, sf):
    """Customers, and those that are nearer to the mean of another cluster than to that of their own."""
    assigned = clustered(spark, sf)
    means = assigned.groupBy("cluster").agg(*[F.avg(c).alias(f"{c}_mean") for c in SCALED])     # six rows
    away = sum((F.col(c) - F.col(f"{c}_mean")) ** 2 for c in SCALED)
    beside = assigned.select("Customer ID", F.col("cluster").alias("own"), *SCALED).join(F.broadcast(means)).withColumn(
        "away", F.round(away, 6))
    own = F.max(F.when(F.col("own") == F.col("cluster"), F.col("away")))
    return beside.groupBy("Customer ID").agg((own > F.min("away")).cast("int").alias("_far")).agg(
        F.count("*").alias("customers"), F.sum("_far").alias("misplaced"))


def silhouette_of_given(spark, sf):
    """Clusters given by the length of the id."""
    rows = scaled_rfm(spark, sf).withColumn("cluster", (F.length("Customer ID") % 3).cast("int"))
    return store.metrics_frame(spark, {"given": {"silhouette": sg.silhouette(rows)}})


def forecast_facts(spark, sf, forecast, days):
    """Per series: asked days, days with a forecast, and days whose interval holds the forecast in its order."""
    joined = days.join(forecast, ["series", "ds"], "left")
    return joined.groupBy("series").agg(
        F.count("*").alias("asked"), F.count("yhat").alias("answered"),
        F.count_if((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"))


def test_days(spark, sf):
    return split_days(spark, sf).filter("part = 'test'").select("series", "ds")


def silhouette(spark, sf):
    score = sg.silhouette(clustered(spark, sf))
    return store.metrics_frame(spark, {"segmentation": {"silhouette": score}})


def given_clusters(spark, sf):
    """Cluster ids given by the data: orders modulo seven."""
    return sg.name_clusters(ft.rfm_matrix(lines(spark, sf), log_scale=False).withColumn(
        "cluster", (F.col("frequency") % 7).cast("int")))


def core_points(spark, sf):
    return dbscan.neighbour_flags(scaled_rfm(spark, sf), "Customer ID", SCALED, DEFAULTS.dbscan_eps,
                                  DEFAULTS.dbscan_min_points)


def density_clusters(spark, sf):
    return dbscan.dbscan(scaled_rfm(spark, sf), "Customer ID", SCALED, DEFAULTS.dbscan_eps,
                         DEFAULTS.dbscan_min_points)


RFM_SQL = """rfm AS (SELECT "Customer ID" AS id, ln(1 + CAST("DaysSinceLastPurchase" AS DOUBLE)) AS recency,
      ln(1 + CAST(order_count AS DOUBLE)) AS frequency, ln(1 + "CustomerLifetimeValue") AS monetary FROM cust),
  scaled AS MATERIALIZED (SELECT id, round((recency - avg(recency) OVER ()) / stddev_pop(recency) OVER (), 9) AS x,
      round((frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER (), 9) AS y,
      round((monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER (), 9) AS z FROM rfm)"""
DENSITY_SQL = RFM_SQL + """,
  pairs AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM scaled a JOIN scaled b
    ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= CAST(0.8 AS DOUBLE) * CAST(0.8 AS DOUBLE)),
  cores AS MATERIALIZED (SELECT a AS id FROM pairs GROUP BY a HAVING count(*) >= 5)"""


# ---- churn --------------------------------------------------------------------------

def churn_rows(spark, sf):
    return stored(spark, sf, "churn-split", lambda: evaluate.stratified_split(
        stored(spark, sf, "churn-set", lambda: churn.churn_set(features(spark, sf))), "ChurnFlag",
        "Customer ID"))


def churn_model(spark, sf):
    return remembered(spark, sf, "churn-model", lambda: churn.fit_churn(
        churn_rows(spark, sf).filter("part = 'train'"), DEFAULTS))


def honest_model(spark, sf):
    return remembered(spark, sf, "honest-model", lambda: churn.fit_churn(
        churn_rows(spark, sf).filter("part = 'train'"), DEFAULTS, exclude_leaky=True))


def churn_metrics(spark, sf):
    """Scores with the recency input, which gives the label away, and without it."""
    test = churn_rows(spark, sf).filter("part = 'test'")
    leaky = materialize(churn.score_churn(churn_model(spark, sf), test), "scored")
    honest = materialize(churn.score_churn(honest_model(spark, sf), test, exclude_leaky=True), "scored")
    return store.metrics_frame(spark, {"churn": churn.evaluate_churn(leaky),
                                       "churn_without_recency": churn.evaluate_churn(honest)})


def batch_scores(spark, sf):
    return churn.score_churn(churn_model(spark, sf), churn_rows(spark, sf))


def saved_model_scores(spark, sf):
    path = scratch_path(spark, "churn-model")
    churn.save_model(churn_model(spark, sf), path)
    return churn.score_requests(churn.load_churn(path), churn_rows(spark, sf))


def search(spark, sf):
    train = churn_rows(spark, sf).filter("part = 'train'")
    found = churn.search_churn(train, exclude_leaky=True, **SEARCH)
    return spark.createDataFrame([(i, t["trees"], t["depth"], t["rate"], t["roc_auc"])
                                  for i, t in enumerate(found)],
                                 "place int, trees int, depth int, rate double, roc_auc double")


def contributions(spark, sf):
    rows = churn_rows(spark, sf)
    return stored(spark, sf, "contributions", lambda: attribution.attribute(
        churn_model(spark, sf), rows, "Customer ID", churn.model_inputs(rows)))


def given_scores(spark, sf):
    """Label and score of every document that has labels: length as score of quality."""
    from .fixtures import table
    return table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", "quality", "toxic", (F.col("n_chars") % 1000).cast("double").alias("score"))


SCORES_SQL = """given AS (SELECT l.doc_id, quality, toxic, CAST(n_chars % 1000 AS DOUBLE) AS score
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def auc(spark, sf):
    return evaluate.roc_auc(given_scores(spark, sf), "quality", "score")


def given_precision(spark, sf):
    return evaluate.precision(given_scores(spark, sf), "quality", F.col("score") >= 500)


def given_report(spark, sf):
    return evaluate.classification_report(
        given_scores(spark, sf).withColumn("called", (F.col("score") >= 500).cast("int")), "quality", "called")


def top_precision(spark, sf):
    return evaluate.precision_at_top(given_scores(spark, sf), "quality", "score", "doc_id")


def given_importance(spark, sf):
    from ..schema import CHURN_FEATURES
    rows = churn_rows(spark, sf).select("Customer ID", *[(F.col(c) / 1000).alias(c) for c in CHURN_FEATURES])
    return attribution.importance(rows, CHURN_FEATURES)


def _report_sql():
    return """cell AS (SELECT quality AS a, CASE WHEN score >= 500 THEN 1 ELSE 0 END AS p FROM given),
  per AS (SELECT c, count(*) FILTER (a = c AND p = c) / nullif(CAST(count(*) FILTER (p = c) AS DOUBLE), 0) AS pr,
      count(*) FILTER (a = c AND p = c) / nullif(CAST(count(*) FILTER (a = c) AS DOUBLE), 0) AS re,
      count(*) FILTER (a = c) AS support FROM cell CROSS JOIN (VALUES (0), (1)) AS k(c) GROUP BY c),
  rep AS (SELECT c, coalesce(pr, 0) AS pr, coalesce(re, 0) AS re, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f, support FROM per),
  acc AS (SELECT avg(CASE WHEN a = p THEN 1.0 ELSE 0.0 END) AS v, count(*) AS n FROM cell)
RESULT
        SELECT CAST(c AS VARCHAR) AS class, pr AS precision, re AS recall, f AS f1, support FROM rep
        UNION ALL SELECT 'accuracy', v, v, v, n FROM acc
        UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f), sum(support) FROM rep
        UNION ALL SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support),
          sum(f * support) / sum(support), sum(support) FROM rep"""


# ---- drift ---------------------------------------------------------------------------

def drift_scores(spark, sf):
    first, rest = store.half_split(features(spark, sf))
    return drift.drift_scores(first, rest)


DRIFT_SQL = f"""halves AS MATERIALIZED (SELECT *, CASE WHEN row_number() OVER (ORDER BY {ORDER}) <= count(*) OVER () // 2
      THEN 1 ELSE 0 END AS is_ref FROM features),
  dlong AS (""" + "\n    UNION ALL ".join(
    f"""SELECT '{c}' AS col, CAST("{c}" AS DOUBLE) AS v, is_ref FROM halves""" for c in DRIFT_FEATURES) + """),
  dval AS (SELECT col, v, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM dlong GROUP BY col, v),
  dstep AS (SELECT col, v, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY col) - sum(c) OVER w / sum(c) OVER (PARTITION BY col)) AS gap,
      lead(v) OVER w AS nv FROM dval WINDOW w AS (PARTITION BY col ORDER BY v)),
  dscore AS (SELECT d.col AS "column", max(gap) AS ks, coalesce(sum(gap * (nv - v)), 0) / greatest(any_value(sd), 0.001) AS distance
    FROM dstep d JOIN (SELECT col, stddev_pop(v) AS sd FROM dlong WHERE is_ref = 1 GROUP BY col) s ON d.col = s.col GROUP BY d.col)"""

QUERIES = {
    "f01_daily_series": Query("series:s, ds:d, y:2", series_all, f"WITH {ALL_SQL}\nRESULT\nSELECT * FROM fser"),
    "f01_daily_series_by_country": Query("series:s, ds:d, y:2", series_by_country,
        f"WITH {COUNTRY_SQL}\nRESULT\nSELECT * FROM fser"),
    "f02_supervised_frame": Query(SUPERVISED, lambda s, d: fc.supervised_frame(series_by_country(s, d)),
        f"WITH {COUNTRY_SQL}, {_supervised_sql(1, '1 PRECEDING')}\nRESULT\nSELECT * FROM fsup"),
    "f02_supervised_with_today": Query(SUPERVISED,
        lambda s, d: fc.supervised_frame(series_all(s, d), include_today=True),
        f"WITH {ALL_SQL}, {_supervised_sql(0, 'CURRENT ROW')}\nRESULT\nSELECT * FROM fsup"),
    "f03_chronological_split": Query("series:s, ds:d, part:s", split_days,
        f"WITH {COUNTRY_SQL}, {SPLIT_SQL}\nRESULT\nSELECT * FROM fsplit"),
    "f04_trend_season_forecast": Query("series:s, ds:d, yhat:2, yhat_lower:2, yhat_upper:2", trend_forecast),
    "f05_boosted_lags": Query("series:s, ds:d, yhat:2",
        lambda s, d: hybrid(s, d).predictions.filter("model = 'boosted_lags'")),
    "f06_sequence_model": Query("series:s, ds:d, yhat:2",
        lambda s, d: hybrid(s, d).predictions.filter("model = 'sequence'")),
    "f06_sequence_frame": Query("series:s, ds:d, scaled:9, first_lag:9, last_lag:9",
        lambda s, d: fc.sequence_frame(series_by_country(s, d)).withColumns({
            "first_lag": F.col("lags")[0], "last_lag": F.col("lags")[13]}), f"""
        WITH {COUNTRY_SQL}, fsc AS (SELECT series, ds, (y - min(y) OVER p) / (max(y) OVER p - min(y) OVER p) AS scaled
            FROM fser WINDOW p AS (PARTITION BY series))
RESULT
        SELECT * FROM (SELECT series, ds, scaled, lag(scaled, 14) OVER w AS first_lag, lag(scaled, 1) OVER w AS last_lag
          FROM fsc WINDOW w AS (PARTITION BY series ORDER BY ds)) WHERE first_lag IS NOT NULL"""),
    "f07_guarded_errors": Query("series:s, model:s, mape:5, mae:2", given_errors, GIVEN_SQL + "SELECT * FROM ferr"),
    "f08_ensemble_weights": Query("series:s, model:s, weight:8",
        lambda s, d: fc.ensemble_weights(given_errors(s, d)), GIVEN_SQL + "SELECT * FROM fweight"),
    "f08_blend": Query("series:s, ds:d, yhat:2", given_blend, GIVEN_SQL + """
        SELECT g.series, ds, sum(weight * yhat) AS yhat FROM fgiven g JOIN fweight w
          ON g.series = w.series AND g.model = w.model GROUP BY g.series, ds"""),
    "f08_hybrid_metrics": Query("series:s, model:s, mape:5, mae:2", lambda s, d: hybrid(s, d).errors),
    "f09_align_predictions": Query("series:s, ds:d, yhat:2", alignment, GIVEN_SQL + """
        SELECT p.series, p.ds, first_value(yhat IGNORE NULLS) OVER (PARTITION BY p.series ORDER BY p.ds
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS yhat
        FROM fsplit p LEFT JOIN (SELECT * FROM fgiven WHERE model = 'lag_1' AND day(ds) > 12) g
          ON p.series = g.series AND p.ds = g.ds WHERE part = 'test'"""),
    "f10_future_forecast": Query("series:s, ds:d, yhat:2, yhat_lower:2, yhat_upper:2",
        lambda s, d: fc.future_forecast(series_by_country(s, d))),
    "f10_future_days": Query("series:s, ds:d, origin:s", lambda s, d: fc.future_days(series_by_country(s, d), 30)
        .withColumn("origin", F.lit("last")).unionByName(fc.future_days(
            series_by_country(s, d), 30, "train_end").withColumn("origin", F.lit("train_end"))), f"""
        WITH {COUNTRY_SQL}, {SPLIT_SQL}, fends AS (SELECT series, max(ds) AS e, 'last' AS origin FROM fser GROUP BY series
          UNION ALL SELECT series, max(ds), 'train_end' FROM fsplit WHERE part = 'train' GROUP BY series)
RESULT
        SELECT series, e + CAST(range + 1 AS INTEGER) AS ds, origin FROM fends CROSS JOIN range(30)"""),
    "f11_baseline_forecast": Query("ds:d, yhat:2, yhat_lower:2, yhat_upper:2",
        lambda s, d: fc.baseline_forecast(lines(s, d)), """
        SELECT (SELECT max(sales_date) FROM daily) + CAST(range + 1 AS INTEGER) AS ds, m AS yhat,
          m * CAST(0.85 AS DOUBLE) AS yhat_lower, m * CAST(1.15 AS DOUBLE) AS yhat_upper
        FROM range(30) CROSS JOIN (SELECT avg(daily_sales) AS m FROM (
          SELECT daily_sales FROM daily ORDER BY sales_date DESC LIMIT 30))"""),
    "f12_forecast_report": Query("ForecastDate:d, ForecastSales:2, ForecastLower:2, ForecastUpper:2, GeneratedFromDataThrough:d",
        lambda s, d: fc.forecast_report(fc.baseline_forecast(lines(s, d)), lines(s, d)), """
        SELECT (SELECT max(sales_date) FROM daily) + CAST(range + 1 AS INTEGER) AS "ForecastDate", m AS "ForecastSales",
          m * CAST(0.85 AS DOUBLE) AS "ForecastLower", m * CAST(1.15 AS DOUBLE) AS "ForecastUpper",
          (SELECT max(sales_date) FROM daily) AS "GeneratedFromDataThrough"
        FROM range(30) CROSS JOIN (SELECT avg(daily_sales) AS m FROM (
          SELECT daily_sales FROM daily ORDER BY sales_date DESC LIMIT 30))"""),
    "m01_standard_scale": Query("Customer ID:s, recency_scaled:7, frequency_scaled:7, monetary_scaled:7", scaled_rfm,
        f"""WITH {RFM_SQL}
RESULT
        SELECT id AS "Customer ID", x AS recency_scaled, y AS frequency_scaled, z AS monetary_scaled FROM scaled"""),
    "f04_intervals": Query("series:s, asked:i, answered:i, ordered:i",
        lambda s, d: forecast_facts(s, d, trend_forecast(s, d), test_days(s, d)), f"""
        WITH {COUNTRY_SQL}, {SPLIT_SQL}
RESULT
        SELECT series, count(*) AS asked, count(*) AS answered, count(*) AS ordered FROM fsplit WHERE part = 'test' GROUP BY series"""),
    "f04_saved_trend": Query("days:i, other:i", saved_trend, f"""
        WITH {COUNTRY_SQL}
RESULT
        SELECT count(DISTINCT series) * 30 AS days, 0 AS other FROM fser"""),
    "f10_intervals": Query("series:s, asked:i, answered:i, ordered:i",
        lambda s, d: forecast_facts(s, d, fc.future_forecast(series_by_country(s, d)),
                                    fc.future_days(series_by_country(s, d), 30)), f"""
        WITH {COUNTRY_SQL}
RESULT
        SELECT DISTINCT series, 30 AS asked, 30 AS answered, 30 AS ordered FROM fser"""),
    "f05_short_series": Query("series:s, ds:d, answers:i", boosted_dates, f"""
        WITH {COUNTRY_SQL}, {SPLIT_SQL}, fcut AS (SELECT series, ds, row_number() OVER (PARTITION BY series ORDER BY ds) AS k FROM fser)
RESULT
        SELECT series, ds, 1 AS answers FROM fcut WHERE series IN (SELECT series FROM fcut ORDER BY series LIMIT 1) AND k <= 30 AND k > 25
        UNION ALL SELECT series, ds, 1 FROM fsplit WHERE part = 'test'
          AND series NOT IN (SELECT series FROM fcut ORDER BY series LIMIT 1)"""),
    "f06_recurrent_against_linear": Query("model:s, metric:s, not_worse:i", recurrent_facts, """
        SELECT 'sequence' AS model, 'training error' AS metric, 1 AS not_worse"""),
    "m02_nearest_means": Query("customers:i, misplaced:i", nearest_means, """
        SELECT count(*) AS customers, 0 AS misplaced FROM cust"""),
    "m03_silhouette_of_given": Query("model:s, metric:s, value:6", silhouette_of_given, f"""WITH {RFM_SQL},
  given AS (SELECT *, len(id) % 3 AS c FROM scaled),
  far AS (SELECT a.id, a.c AS own, b.c AS other, sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS total, count(*) AS n
    FROM given a JOIN given b ON true GROUP BY ALL),
  inner_ AS (SELECT id, CASE WHEN n > 1 THEN total / (n - 1) END AS a FROM far WHERE own = other),
  outer_ AS (SELECT id, min(total / n) AS b FROM far WHERE own <> other GROUP BY id)
RESULT
        SELECT 'given' AS model, 'silhouette' AS metric, avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS value
        FROM inner_ JOIN outer_ USING (id)"""),
    "m02_kmeans": Query("Customer ID:s, cluster:i", clustered),
    "m03_silhouette": Query("model:s, metric:s, value:6", silhouette),
    "m04_core_points": Query("id:s, is_core:i", core_points, f"""WITH {DENSITY_SQL}
RESULT
        SELECT id, id IN (SELECT id FROM cores) AS is_core FROM scaled"""),
    "m04_density_clusters": Query("Customer ID:s, cluster:i", density_clusters, f"""WITH {DENSITY_SQL},
  links AS MATERIALIZED (SELECT a, b FROM pairs WHERE a IN (SELECT id FROM cores) AND b IN (SELECT id FROM cores)),
  RECURSIVE cc(id, label) USING KEY (id) AS (
    SELECT id, id FROM cores
    UNION
    SELECT l.a, min(cc.label) FROM cc JOIN links l ON l.b = cc.id JOIN recurring.cc AS known ON known.id = l.a
    WHERE cc.label < known.label GROUP BY l.a),
  numbered AS (SELECT id, dense_rank() OVER (ORDER BY label) - 1 AS cluster FROM cc)
RESULT
        SELECT s.id AS "Customer ID", coalesce(n.cluster, (SELECT min(m.cluster) FROM pairs p JOIN numbered m ON p.b = m.id
          WHERE p.a = s.id), -1) AS cluster FROM scaled s LEFT JOIN numbered n ON s.id = n.id"""),
    "m05_segment_names": Query("Customer ID:s, cluster:i, KMeansSegment:i, SegmentLabel:s", given_clusters, """
        WITH given AS (SELECT "Customer ID", order_count % 7 AS cluster, "CustomerLifetimeValue" AS v FROM cust),
          num AS (SELECT cluster AS k, row_number() OVER (ORDER BY avg(v), cluster) - 1 AS n FROM given GROUP BY cluster)
RESULT
        SELECT "Customer ID", cluster, n AS "KMeansSegment", CASE n WHEN 0 THEN 'Budget Shoppers' WHEN 1 THEN 'Loyal Regulars'
          WHEN 2 THEN 'High Rollers' WHEN 3 THEN 'Occasional Buyers' WHEN 4 THEN 'New Prospects' WHEN 5 THEN 'At-Risk Valuable' END
          AS "SegmentLabel" FROM given JOIN num ON cluster = k"""),
    "m05_named_segments": Query("Customer ID:s, KMeansSegment:i, SegmentLabel:s",
        lambda s, d: sg.name_clusters(clustered(s, d))),
    "m06_stratified_split": Query("Customer ID:s, ChurnFlag:i, part:s", churn_rows, """
        SELECT "Customer ID", "ChurnFlag", CASE WHEN row_number() OVER (PARTITION BY "ChurnFlag"
            ORDER BY md5('42|' || "Customer ID"), "Customer ID") <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY "ChurnFlag"))
          THEN 'test' ELSE 'train' END AS part FROM first_lines"""),
    "m07_churn_metrics": Query("model:s, metric:s, value:6", churn_metrics),
    "m07_churn_set": Query("Customer ID:s, CustomerLifetimeValue:2, PurchaseFrequency:9, DaysSinceLastPurchase:i, "
        "Rolling7DaySales:2, SeasonalIndex:9, InventoryRiskScore:7, ChurnFlag:i", churn_rows, "SELECT * FROM first_lines"),
    "m08_parameter_search": Query("place:i, trees:i, depth:i, rate:6, roc_auc:6", search),
    "m09_roc_auc": Query("roc_auc:9", auc, f"""WITH {SCORES_SQL},
          won AS (SELECT avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS roc_auc
            FROM given a JOIN given b ON a.quality = 1 AND b.quality = 0)
RESULT
        SELECT * FROM won"""),
    "m10_precision": Query("precision:9", given_precision, f"""WITH {SCORES_SQL}
RESULT
        SELECT coalesce(count(*) FILTER (score >= 500 AND quality = 1) / nullif(CAST(count(*) FILTER (score >= 500) AS DOUBLE), 0), 0)
          AS precision FROM given"""),
    "m11_classification_report": Query("class:s, precision:9, recall:9, f1:9, support:i", given_report,
        f"WITH {SCORES_SQL},\n  " + _report_sql()),
    "m12_batch_scores": Query("Customer ID:s, churn_probability:6, ChurnFlag:i", batch_scores),
    "m13_request_scores": Query("Customer ID:s, churn_probability:6, churn_risk:s", saved_model_scores),
    "a08_model_store": Query("Customer ID:s, cluster:i", kmeans_model_round_trip),
    "m15_contributions": Query("Customer ID:s, CustomerLifetimeValue:6, DaysSinceLastPurchase:6, base:6, margin:6",
        contributions),
    "m15_importance": Query("feature:s, importance:6", lambda s, d: attribution.importance(
        contributions(s, d), churn.model_inputs(churn_rows(s, d)))),
    "m16_sorted_importance": Query("feature:s, importance:6", given_importance, "\n        UNION ALL ".join(
        f"""SELECT '{c}' AS feature, avg(abs("{c}" / CAST(1000 AS DOUBLE))) AS importance FROM first_lines""" for c in
        ["CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency", "DaysSinceLastPurchase", "Rolling7DaySales",
         "Rolling30DaySales", "SeasonalIndex", "InventoryRiskScore"])),
    "w13_precision_at_top": Query("precision_at_top:9", top_precision, f"""WITH {SCORES_SQL}
RESULT
        SELECT avg(quality) AS precision_at_top FROM (SELECT quality, row_number() OVER (ORDER BY score DESC, doc_id) AS rn,
          count(*) OVER () AS n FROM given) WHERE rn <= greatest(1, floor(CAST(0.2 AS DOUBLE) * n))"""),
    "x01_seeded_sample": Query("Customer ID:s, CustomerLifetimeValue:2",
        lambda s, d: drift.seeded_sample(churn_rows(s, d), ["Customer ID"], 500), """
        SELECT * FROM cust ORDER BY md5('42|' || "Customer ID"), "Customer ID" LIMIT 500"""),
    "x03_drift_scores": Query("column:s, ks:9, distance:7, drifted:i", drift_scores,
        f"""WITH {DRIFT_SQL}
RESULT
        SELECT *, distance >= CAST(0.1 AS DOUBLE) AS drifted FROM dscore"""),
    "x04_drift_alert": Query("drift_share:9, alert:i", lambda s, d: drift.drift_alert(drift_scores(s, d)),
        f"""WITH {DRIFT_SQL}
RESULT
        SELECT avg(CASE WHEN distance >= CAST(0.1 AS DOUBLE) THEN 1.0 ELSE 0.0 END) AS drift_share,
          avg(CASE WHEN distance >= CAST(0.1 AS DOUBLE) THEN 1.0 ELSE 0.0 END) > 0.15 AS alert FROM dscore"""),
}
