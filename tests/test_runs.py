from dataclasses import replace

import __spark_entry__ as entry
from tillgrain.catalog.fixtures import dirty_transactions
from tillgrain.operators import forecast as fc
from tillgrain.operators.recurrent import RecurrentModel
from tillgrain.plans import training
from tillgrain.schema import DEFAULTS
from tillgrain.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_registry_is_consistent():
    names, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(names) and len(sqls) > 100


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_training_run_and_export(spark):
    out, target = scratch_path(spark, "run"), scratch_path(spark, "export")
    settings = replace(DEFAULTS, churn_trees=4, boost_trees=4, boost_depth=3, churn_depth=3, kmeans_starts=1,
                       sequence_epochs=3)
    metrics = {(r["model"], r["metric"]): r["value"]
               for r in training.run_training(dirty_transactions(spark, SF), out, settings, tune=False).collect()}
    assert metrics[("churn", "roc_auc")] > 0.9
    assert metrics[("forecasting", "mape")] > 0
    assert metrics[("gates", "churn_roc_auc_passed")] == 1.0 and ("gates", "forecasting_mape_distance") in metrics
    assert 0 <= metrics[("churn", "report/1/f1")] <= 1 and metrics[("churn", "report/accuracy/support")] > 10
    for name in ("summary", "sales_trend", "country_revenue", "clv_distribution", "seasonality", "correlation", "outliers"):
        assert not spark.read.parquet(f"{out}/eda/{name}").isEmpty()
    # Saved models say what the run has stored.
    stored = {r["Customer ID"]: r["KMeansSegment"] for r in spark.read.parquet(f"{out}/segments").collect()}
    rfm = spark.read.parquet(f"{out}/segments").select("Customer ID", "recency", "frequency", "monetary")
    placed = {r["Customer ID"]: r["cluster"] for r in training.place_customers(spark, out, rfm).collect()}
    pairs = {(placed[c], stored[c]) for c in stored}
    assert len(pairs) == len({p for p, _ in pairs}) == len({s for _, s in pairs})
    models = spark.read.parquet(f"{out}/models/trend")
    forecast = spark.read.parquet(f"{out}/forecast")
    again = fc.trend_predict(models, forecast.select("series", "ds"))
    both = forecast.join(again.withColumnsRenamed({"yhat": "a", "yhat_upper": "b"}), ["series", "ds"])
    assert both.count() == 30 and both.filter("abs(yhat - a) > 1e-6 OR abs(yhat_upper - b) > 1e-6").isEmpty()
    assert RecurrentModel.load(spark, f"{out}/models/sequence").losses
    tables = training.export_reports(spark, out, target)
    assert len(tables) == 9
    assert spark.read.option("header", True).csv(f"{target}/customer_segments").count() > 100
