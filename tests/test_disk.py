"""Work that leaves out shuffles of whole rows gives the same rows as work that has them."""

import pytest
from pyspark.sql import functions as F

from tillgrain.catalog import base_queries
from tillgrain.operators import features as ft, joins
from tillgrain.session import materialize, scratch_path
from tillgrain.sources import store


def equal(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def moved(df):
    return "hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcasts(monkeypatch):
    monkeypatch.setattr(joins, "broadcast_rows", lambda lookup: 0)
    monkeypatch.setattr(ft, "broadcast_rows", lambda lookup: 0)


def test_numbers_of_many_keys_are_attached_without_a_shuffle(spark, monkeypatch, no_broadcasts):
    rows = materialize(spark.range(3000).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("p"), F.col("id") % 700)).alias("code"), F.col("id").alias("line")))
    lookup = materialize(rows.groupBy("code").agg(F.count("*").alias("n"), F.sum("line").cast("double").alias("total")).withColumn(
        "gap", F.when(F.col("total") % 3 > 0, F.col("total").cast("int"))))
    found, want = joins.attach_whole(rows, lookup, "code", "n"), joins.attach(rows, lookup, "code", "n")
    assert equal(found, want) and found.filter("total is null").count() == 273
    assert moved(want) and not moved(found)
    monkeypatch.setattr(joins, "PACKED_BYTES", 0)                           # too many for one machine
    assert moved(joins.attach_whole(rows, lookup, "code", "n"))


def test_keys_that_share_a_hash_are_not_packed(spark, monkeypatch, no_broadcasts):
    rows = materialize(spark.createDataFrame([("a", 1), ("b", 2)], "code string, line int"))
    lookup = materialize(spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "code string, n long, v double"))
    monkeypatch.setattr(joins.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert equal(joins.attach_whole(rows, lookup, "code", "n"), joins.attach(rows, lookup, "code", "n"))


def test_a_sieve_keeps_every_wanted_row_and_few_others(spark):
    rows = materialize(spark.range(100_000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("t")))
    wanted = materialize(rows.groupBy("k").agg(F.min("t").alias("t")))
    left = joins.sieved(rows, wanted, [F.col("k"), F.col("t")], [F.col("k"), F.col("t")])
    assert left.join(wanted, ["k", "t"]).count() == 5000 and left.count() < 6000


def test_first_values_shuffle_only_rows_of_first_times(spark, monkeypatch, no_broadcasts):
    rows = materialize(spark.range(5000).select(
        F.when(F.col("id") % 50 > 0, (F.col("id") % 50).cast("string")).alias("Customer ID"),
        (F.timestamp_seconds(F.col("id") % 977)).alias("InvoiceDate"), F.col("id").alias("Invoice"),
        F.when(F.col("id") > 800, F.col("id") * 0.5).alias("x"), F.lit(None).cast("int").alias("y")))
    got = []
    monkeypatch.setattr(ft, "attach", lambda r, *rest: got.append(r.count()) or joins.attach(r, *rest))
    order = ["InvoiceDate", "Invoice"]
    found = ft.first_per_key(rows, "Customer ID", ["x", "y"], order)
    want = rows.groupBy("Customer ID").agg(*ft.first_values("Customer ID", ["x", "y"], order))
    assert equal(found, want) and found.count() == 50 and got[0] < 500


@pytest.mark.parametrize("open_files", [2, 120])
def test_the_feature_store_is_written_without_moving_rows(spark, monkeypatch, open_files):
    rows = materialize(spark.range(400).select(
        F.when(F.col("id") % 9 > 0, F.expr("timestamp'2023-01-15' + make_interval(0, cast(id % 30 as int))")).alias("InvoiceDate"),
        F.col("id").cast("string").alias("Invoice")))
    monkeypatch.setattr(store, "OPEN_FILES", open_files)
    monkeypatch.setattr(type(rows), "repartition", None)
    path = scratch_path(spark, "feature-store")
    store.write_feature_store(rows, path)
    back = spark.read.parquet(path)
    assert equal(back.select("InvoiceDate", "Invoice"), rows)
    assert back.filter(~F.col("year").eqNullSafe(F.year("InvoiceDate")) | ~F.col("month").eqNullSafe(F.month("InvoiceDate"))).isEmpty()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_row_ranks_carry_the_line_key_alone(spark, monkeypatch):
    lines = materialize(spark.range(300).select(
        F.timestamp_seconds(F.col("id") % 20).alias("InvoiceDate"), (F.col("id") % 40).cast("string").alias("Invoice"),
        (F.col("id") % 3).cast("string").alias("StockCode"), (F.col("id") % 50).cast("double").alias("Quantity"),
        F.col("id").cast("double").alias("Price"), (F.col("id") % 7).cast("string").alias("Customer ID"),
        F.lit(None).cast("string").alias("Description"), F.lit("x").alias("Country")))
    customers = materialize(lines.groupBy("Customer ID").agg(F.count("*").alias("n_lines"), F.lit(5).alias("DaysSinceLastPurchase"),
        (F.max("Price") % 3).cast("int").alias("order_count"), F.sum("Price").alias("CustomerLifetimeValue")))
    monkeypatch.setattr(base_queries, "lines", lambda s, d: lines)
    monkeypatch.setattr(base_queries, "customers", lambda s, d: customers)
    found = base_queries.row_ranks(spark, "none")
    assert not {"Description", "Country"} & set(found.columns)              # they tell no two lines apart
    for name, measure in (("r_rank", "DaysSinceLastPurchase"), ("f_rank", "order_count"), ("m_rank", "CustomerLifetimeValue")):
        rows = lines.join(customers, "Customer ID").orderBy(measure, *base_queries.ROW_ORDER).collect()
        assert [r["Price"] for r in found.orderBy(name).collect()] == [r["Price"] for r in rows]
        assert [r[name] for r in found.orderBy(name).collect()] == list(range(1, 301))
