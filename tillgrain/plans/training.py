"""Whole runs: forecaster fit, the full training run and the report export."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import select_available
from ..operators import (attribution, churn, dbscan, drift, evaluate, features as ft,
                         forecast as fc, inventory, reports as rp, segment as sg)
from ..operators.clean import clean_typed, typed_lines
from ..operators.quality import assert_features, assert_raw
from ..schema import BI_TRANSACTION_COLUMNS, DEFAULTS, Settings
from ..session import materialize
from ..sources import store


@dataclass
class Forecaster:
    """Test predictions per model, their errors and weights, and the fitted models."""
    predictions: DataFrame   # series, ds, model, yhat
    weights: DataFrame       # series, model, mape, weight
    errors: DataFrame        # series, model, mape, mae (with the ensemble)
    boosted: object
    sequence: object


def fit_forecaster(series: DataFrame, settings: Settings = DEFAULTS) -> Forecaster:
    """Fit three models on the first part of each series and blend them on the rest.

    `series` must be stored (see `daily_series`).
    """
    parts = materialize(fc.chronological_split(series, settings.train_share), "split")
    train, test = parts.filter("part = 'train'").drop("part"), parts.filter("part = 'test'").drop("part")
    days = test.select("series", "ds")

    trend = fc.trend_season_forecast(train, days).select("series", "ds", "yhat")

    frame = materialize(fc.supervised_frame(series), "supervised")
    boosted = fc.boosted_lag_model(frame.join(days, ["series", "ds"], "left_anti"), settings)
    lags = fc.boosted_lag_forecast(frame, days, boosted)

    sequences = materialize(fc.sequence_frame(series, settings.sequence_length), "sequences")
    sequence = fc.sequence_model(sequences.join(days, ["series", "ds"], "left_anti"), settings)
    steps = fc.sequence_forecast(sequences, days, sequence)

    named = [fc.align_predictions(days, p).withColumn("model", F.lit(name)) for name, p in
             (("trend_season", trend), ("boosted_lags", lags), ("sequence", steps))]
    predictions = materialize(named[0].unionByName(named[1]).unionByName(named[2]), "predictions")
    pairs = predictions.join(test, ["series", "ds"])
    errors = materialize(fc.guarded_errors(pairs, ["series", "model"]), "errors")
    weights = fc.ensemble_weights(errors)
    ensemble = fc.blend(predictions, weights).join(test, ["series", "ds"]).withColumn(
        "model", F.lit("ensemble"))
    all_errors = errors.unionByName(fc.guarded_errors(ensemble, ["series", "model"]))
    return Forecaster(predictions, weights, all_errors, boosted, sequence)


@dataclass
class Segmentation:
    """Segments per customer, and what places a new customer: scales and centres."""
    segments: DataFrame
    scales: DataFrame        # column, mean, deviation
    centres: sg.Centres


def segment_customers(lines: DataFrame, settings: Settings = DEFAULTS) -> Segmentation:
    """RFM matrix with k-means segment and name, and density cluster, per customer."""
    rfm = materialize(ft.rfm_matrix(lines), "rfm")
    scaled = materialize(sg.standard_scale(rfm), "scaled-rfm")
    model = sg.fit_kmeans(scaled, settings)
    named = sg.name_clusters(sg.assign_kmeans(model, scaled))
    density = dbscan.dbscan(scaled, "Customer ID", [f"{c}_scaled" for c in sg.RFM],
                            settings.dbscan_eps, settings.dbscan_min_points)
    return Segmentation(named.join(density.withColumnRenamed("cluster", "DBSCANSegment"), "Customer ID").select(
        "Customer ID", *sg.RFM, "KMeansSegment", "DBSCANSegment", "SegmentLabel"), sg.scales(rfm), model)


def explore(features: DataFrame, out: str) -> list[str]:
    """The tables of a first look at the data, as parquet under `out`; their names."""
    customers = materialize(ft.first_per_key(features, "Customer ID", ["CustomerLifetimeValue"]), "first-values")
    tables = {
        "summary": rp.summary_kpis(features),
        "sales_trend": ft.daily_sales(features),
        "country_revenue": rp.top_countries(features),
        "clv_distribution": rp.histogram(customers, "CustomerLifetimeValue"),
        "seasonality": rp.sales_by(features, "InvoiceMonth"),
        "correlation": rp.correlation_matrix(features),
        "outliers": rp.box_summary(features, ["Quantity", "Price", "TotalAmount"]),
    }
    for name, table in tables.items():
        store.write_parquet(table, os.path.join(out, name))
    return sorted(tables)


def tuned(rows: DataFrame, settings: Settings) -> tuple[Settings, dict]:
    """Settings with the best parameters of the search over the training rows, and that trial."""
    best = churn.search_churn(rows, settings)[0]
    return replace(settings, churn_trees=best["trees"], churn_depth=best["depth"], churn_rate=best["rate"],
                   churn_positive_weight=best["positive_weight"]), best


def report_metrics(report: DataFrame) -> dict[str, float]:
    """The classification report as named numbers: `report/<class>/<measure>`."""
    return {f"report/{r['class']}/{m}": float(r[m]) for r in report.collect()         # a row per class
            for m in ("precision", "recall", "f1", "support") if r[m] is not None}


def run_training(raw: DataFrame, out: str, settings: Settings = DEFAULTS, eda: bool = True,
                 tune: bool = True) -> DataFrame:
    """Raw lines to feature store, tables, models, recommendations and drift under `out`.

    Returns the metrics as (model, metric, value) rows.  Text is typed once; the feature store is the
    one large table written, and every later step reads it with pruned columns.
    """
    spark = raw.sparkSession
    typed = typed_lines(raw, settings)
    assert_raw(typed)
    clean = materialize(clean_typed(typed, settings), "clean")
    store.write_feature_store(ft.engineer_features(clean, settings), os.path.join(out, "features"))
    features = spark.read.parquet(os.path.join(out, "features")).drop("year", "month")
    assert_features(features)
    if eda:
        explore(features, os.path.join(out, "eda"))

    segmentation = segment_customers(features, settings)
    store.write_parquet(segmentation.segments, os.path.join(out, "segments"))
    store.write_parquet(segmentation.scales, os.path.join(out, "models", "segment_scales"))
    segmentation.centres.save(spark, os.path.join(out, "models", "segment_centres"))

    series = materialize(fc.daily_series(features), "series")
    forecaster = fit_forecaster(series, settings)
    churn.save_model(forecaster.boosted, os.path.join(out, "models", "boosted_lags"))
    forecaster.sequence.save(spark, os.path.join(out, "models", "sequence"))
    store.write_parquet(fc.trend_models(series), os.path.join(out, "models", "trend"))
    future = fc.future_forecast(series, settings.forecast_horizon)
    store.write_parquet(future, os.path.join(out, "forecast"))

    rows = materialize(evaluate.stratified_split(
        materialize(churn.churn_set(features), "churn-set"), "ChurnFlag", "Customer ID",
        settings.churn_test_share, settings.seed), "churn-split")
    train = rows.filter("part = 'train'")
    chosen, best = tuned(train, settings) if tune else (settings, {})
    model = churn.fit_churn(train, chosen, subsample=best.get("subsample", 1.0), feature_share=best.get("feature_share"))
    churn.save_model(model, os.path.join(out, "models", "churn"))
    scored = materialize(churn.score_churn(model, rows), "scored")
    store.write_parquet(scored.select("Customer ID", "churn_probability", "ChurnFlag"),
                        os.path.join(out, "churn_scores"))
    inputs = churn.model_inputs(rows)
    shares = attribution.importance(attribution.attribute(model, rows, "Customer ID", inputs), inputs)
    store.write_parquet(shares, os.path.join(out, "importance"))

    store.write_parquet(inventory.reorder_table(features, future, settings), os.path.join(out, "reorder"))

    reference = store.reference_snapshot(features, os.path.join(out, "reference"))
    _, current = store.half_split(features)
    alert = drift.drift_alert(drift.drift_scores(reference, current), settings.drift_threshold).first()

    errors = forecaster.errors.filter("model = 'ensemble'").first()
    test = scored.filter("part = 'test'")
    metrics = {
        "forecasting": {"mape": errors["mape"], "mae": errors["mae"]},
        "churn": churn.evaluate_churn(test) | report_metrics(churn.churn_report(test)),
        "drift": {"drift_share": alert["drift_share"], "alert": float(alert["alert"])},
    }
    if best:
        metrics["churn_search"] = {k: float(v) for k, v in best.items()}
    gates = rp.quality_gates(store.metrics_frame(spark, metrics), settings.target_mape, settings.target_auc)
    metrics["gates"] = {f"{r['model']}_{r['metric']}_{m}": float(r[m]) for r in gates.collect()     # two rows
                        for m in ("distance", "passed")}
    table = store.metrics_frame(spark, metrics)
    store.write_metrics(table, os.path.join(out, "metrics"))
    return table


def place_customers(spark: SparkSession, out: str, rfm: DataFrame) -> DataFrame:
    """K-means clusters of customers (an RFM matrix) by the saved scales and centres of a run."""
    scales = spark.read.parquet(os.path.join(out, "models", "segment_scales"))
    model = sg.Centres.load(spark, os.path.join(out, "models", "segment_centres"))
    return sg.assign_kmeans(model, sg.scale_by(rfm, scales))


def export_reports(spark: SparkSession, out: str, target: str, settings: Settings = DEFAULTS) -> list[str]:
    """The report tables of a finished run as CSV folders; returns their names."""
    features = spark.read.parquet(os.path.join(out, "features"))
    metrics = store.read_metrics(spark, [os.path.join(out, "metrics")])
    baseline = fc.forecast_report(fc.baseline_forecast(features, settings.forecast_horizon), features)
    tables = {
        "transactions": select_available(features, BI_TRANSACTION_COLUMNS),
        "daily_sales": rp.daily_report(features),
        "customer_summary": rp.customer_report(features),
        "model_metrics": rp.model_metric_table(metrics, settings.target_mape, settings.target_auc),
        "forecast_30_days": baseline,
        "country_sales": rp.country_report(features),
        "product_category_sales": rp.category_report(features),
    }
    for name, folder in (("customer_segments", "segments"), ("inventory_recommendations", "reorder")):
        path = os.path.join(out, folder)
        if store.path_exists(spark, path):
            tables[name] = spark.read.parquet(path)
    for name, table in tables.items():
        store.write_csv(table, os.path.join(target, name))
    return sorted(tables)
