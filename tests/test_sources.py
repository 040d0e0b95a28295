import pytest
from pyspark.sql import functions as F

from tillgrain.errors import DataContractError
from tillgrain.operators.clean import coerce_types
from tillgrain.schema import REQUIRED
from tillgrain.session import scratch_path
from tillgrain.sources import ingest, store

RAW = {"InvoiceNo": "536365", "StockCode": "85123A", "Description": "WHITE HANGING HEART",
       "Quantity": "6", "InvoiceDate": "12/01/2010 08:26:00", "UnitPrice": "2.55",
       "CustomerID": "17850", "Country": "United Kingdom"}


def raw(spark):
    return spark.createDataFrame([tuple(RAW.values())], list(RAW))


def test_aliases_give_contract_columns_in_order(spark):
    assert ingest.require_columns(ingest.normalize_columns(raw(spark))).columns == REQUIRED


def test_alias_rules():
    plan = ingest.alias_plan(["﻿invoice no", "sku", "Country", "Region", " qty "])
    assert plan["﻿invoice no"] == "Invoice"
    assert plan["sku"] == "StockCode"
    assert plan[" qty "] == "Quantity"
    assert "Region" not in plan        # the exact target is there already
    # Of two columns with one key the last one wins.
    assert ingest.alias_plan(["Qty", "QTY"]) == {"QTY": "Quantity"}


def test_missing_columns_are_named(spark):
    with pytest.raises(DataContractError, match="Price"):
        ingest.require_columns(ingest.normalize_columns(raw(spark).drop("UnitPrice")))


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    store.write_csv(raw(spark), path, single_file=True)
    row = coerce_types(ingest.read_csv(spark, path)).first()
    assert row["Invoice"] == "536365" and row["Price"] == 2.55 and row["Quantity"] == 6.0
    assert str(row["InvoiceDate"]) == "2010-12-01 08:26:00"
    with pytest.raises(DataContractError, match="no raw data"):
        ingest.read_csv(spark, path + "-absent")


def test_metrics_and_limited_read(spark):
    path = scratch_path(spark, "metrics")
    store.write_metrics(store.metrics_frame(spark, {"churn": {"roc_auc": 0.9}}), path)
    got = store.read_metrics(spark, [path, path + "-absent"]).collect()
    assert [tuple(r) for r in got] == [("churn", "roc_auc", 0.9)]
    assert store.read_metrics(spark, [path + "-absent"]).count() == 0
    rows = store.first_rows(spark.range(10), [F.desc("id")], 3).collect()
    assert [(r["id"], r["count"]) for r in rows] == [(9, 3), (8, 3), (7, 3)]


def test_quotes_newlines_and_fractions_survive_the_round_trip(spark):
    from pyspark.sql import types as T

    row = dict(RAW, Description='12" PLATE, "RED"\nsecond line', InvoiceDate="2021-01-15 10:00:00.123")
    typed = coerce_types(ingest.require_columns(ingest.normalize_columns(
        spark.createDataFrame([tuple(row.values())], list(row)))))
    assert isinstance(typed.schema["InvoiceDate"].dataType, T.TimestampType)
    path = scratch_path(spark, "csv")
    store.write_csv(typed, path)
    again = coerce_types(ingest.read_csv(spark, path))
    assert again.collect() == typed.collect()
    assert again.first()["Description"] == row["Description"]


def test_iso_zones_are_read_and_java_numbers_are_not(spark):
    row = dict(RAW, InvoiceDate="2021-01-15T10:00:00Z", Quantity="5d")
    typed = coerce_types(ingest.require_columns(ingest.normalize_columns(
        spark.createDataFrame([tuple(row.values())], list(row))))).first()
    assert str(typed["InvoiceDate"]) == "2021-01-15 10:00:00" and typed["Quantity"] is None
