import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillgrain.functions import scalars as sc
from tillgrain.operators import features as ft, joins
from tillgrain.operators.inventory import reorder_table
from tillgrain.schema import ROW_ORDER
from tillgrain.session import materialize


def fixture(spark, rows=None):
    rows = rows or [
        ("INV1", "S1", "MUG RED", 2.0, dt.datetime(2021, 1, 15, 10), 10.0, "C001", "United Kingdom", 0),
        ("INV2", "S2", "GIFT BOX", 5.0, dt.datetime(2021, 2, 20, 14, 30), 5.0, "C002", "Germany", 0)]
    return materialize(spark.createDataFrame(
        rows, "Invoice string, StockCode string, Description string, Quantity double, InvoiceDate timestamp, "
              "Price double, `Customer ID` string, Country string, is_outlier_capped int"))


def test_feature_table(spark):
    got = {r["Invoice"]: r for r in ft.engineer_features(fixture(spark)).collect()}
    one, two = got["INV1"], got["INV2"]
    assert one["TotalAmount"] == 20.0 and two["TotalAmount"] == 25.0
    assert one["DaysSinceLastPurchase"] == 36 and two["DaysSinceLastPurchase"] == 0
    assert two["ProductCategory"] == "HOME" and one["ProductCategory"] == "KITCHEN"
    assert one["CountrySalesRank"] == 2.0 and two["WeekendFlag"] == 1
    assert one["Lag_1_Day_Sales"] == 22.5 and two["Lag_1_Day_Sales"] == 20.0
    assert two["Rolling7DaySales"] == 22.5 and one["ChurnFlag"] == 0
    assert one["SeasonalIndex"] == pytest.approx(20 / 22.5)


def test_categories(spark):
    texts = ["GIFT BOX", "party bag", "Gift Card", "pendant", "plain", None, "dollhouse"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(sc.product_category("t")).collect()]
    assert got == ["HOME", "FASHION", "GIFT", "STATIONERY", "CAT_0", "CAT_0", "TOY"]
    more = rows.select(sc.product_category("t", buckets=12).alias("c")).filter("c like 'CAT_%'").collect()
    assert all(0 <= int(r["c"][4:]) < 5 for r in more)


def test_elapsed_days_and_rounding(spark):
    row = spark.sql("select timestamp'2021-03-02 10:00:00' a, timestamp'2021-03-01 11:00:00' b").select(
        sc.elapsed_days(F.col("a"), F.col("b")), sc.half_even(F.lit(2.5)), sc.half_even(F.lit(3.5)),
        sc.clip(F.lit(None).cast("double"), 0.0, 1.0)).first()
    assert tuple(row) == (0, 2.0, 4.0, None)


def test_quartile_closed_form(spark):
    for n in (1, 2, 3, 5, 10, 101):
        got = [r[0] for r in spark.range(1, n + 1).orderBy("id").select(
            ft.quartile_of_rank(F.col("id"), n)).collect()]
        expected = [1] if n == 1 else (pd.qcut(pd.Series(range(1, n + 1)), 4, labels=False) + 1).tolist()
        assert got == expected


@pytest.mark.parametrize("limit", [1_000_000, 60])
def test_first_line_quartiles_match_full_ranking(spark, monkeypatch, limit):
    if limit < 1000:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(11)
    n = 900
    hours = rng.integers(0, 60, n)          # few timestamps, so ties reach the full key
    customer = np.where(rng.random(n) < 0.33, "GUEST", [f"c{i:03d}" for i in rng.integers(0, 80, n)])
    rows = [(f"i{i // 2}", f"s{rng.integers(0, 9)}", "x", float(rng.integers(1, 5)),
             dt.datetime(2021, 1, 1) + dt.timedelta(hours=int(hours[i])), float(rng.integers(1, 4)),
             str(customer[i]), "UK", i) for i in range(n)]
    pdf = pd.DataFrame(rows, columns=ROW_ORDER_COLUMNS).drop_duplicates(ROW_ORDER).reset_index(drop=True)
    lines = materialize(spark.createDataFrame(pdf.drop(columns="seq")))
    per = pdf.groupby("Customer ID").agg(n_lines=("Invoice", "size"), first_purchase=("InvoiceDate", "min"))
    per["few"] = [i % 3 for i in range(len(per))]
    per["many"] = rng.permutation(len(per)) * 1.5
    customers = materialize(spark.createDataFrame(per.reset_index()))
    got = ft.first_line_quartiles(lines, customers, {"few": "q_few", "many": "q_many"}, limit).toPandas()
    got = got.set_index("Customer ID")
    ordered = pdf.sort_values(ROW_ORDER).reset_index(drop=True)
    for measure, name in (("few", "q_few"), ("many", "q_many")):
        values = ordered["Customer ID"].map(per[measure])
        rank = values.rank(method="first")
        quartile = pd.qcut(rank, 4, labels=False) + 1
        first = quartile.groupby(ordered["Customer ID"]).first()
        assert got[name].sort_index().tolist() == first.sort_index().tolist()


ROW_ORDER_COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID",
                     "Country", "seq"]


def test_first_per_key_skips_nulls(spark):
    rows = spark.createDataFrame([("c", 1, None, 5), ("c", 2, "x", 6), ("d", 1, None, None)],
                                 "c string, o int, t string, v int")
    got = {r["c"]: (r["t"], r["v"]) for r in ft.first_per_key(rows, "c", ["t", "v"], ["o"]).collect()}
    assert got == {"c": ("x", 5), "d": (None, None)}


def test_single_line_product(spark):
    rows = reorder_table(ft.engineer_features(fixture(spark))).collect()
    by = {r["StockCode"]: r for r in rows}
    assert by["S1"]["demand_std"] == pytest.approx(0.6)
    assert by["S1"]["forecast_demand"] == 2.0


def test_days_of_1e15_do_not_overflow(spark):
    from tillgrain.operators.features import with_daily_features
    from tillgrain.operators.variants import seasonal_index

    days = spark.sql("select date'2021-01-01' + cast(id as int) sales_date, 1e15 + id daily_sales from range(9)")
    last = with_daily_features(days).orderBy("sales_date").collect()[-1]
    assert last["Rolling7DaySales"] == 1e15 + 5
    lines = spark.sql("select cast(id % 2 as int) + 1 InvoiceMonth, 9e11 TotalAmount from range(4000)")
    assert {r["SeasonalIndex"] for r in seasonal_index(lines).collect()} == {1.0}


def test_reports_of_periods_copy_no_rows(spark):
    import datetime
    from tillgrain.operators import reports as rp
    rows = [(datetime.datetime(2024, m, d, 9), f"i{i}", c, 2.0, 1.0)
            for m, d, i, c in [(1, 1, 1, "a"), (1, 1, 1, "a"), (1, 1, 2, "b"), (1, 2, 2, "b"), (1, 2, 3, None), (2, 1, 3, "a")]]
    lines = spark.createDataFrame(rows, "InvoiceDate timestamp, Invoice string, `Customer ID` string, TotalAmount double, Quantity double")
    daily = rp.daily_report(lines)
    assert "Expand" not in daily._jdf.queryExecution().executedPlan().toString()
    assert {(str(r["SalesDate"]), r["TotalSales"], r["Orders"], r["Customers"], r["AOV"]) for r in daily.collect()} == {
        ("2024-01-01", 6.0, 2, 2, 3.0), ("2024-01-02", 4.0, 2, 1, 2.0), ("2024-02-01", 2.0, 1, 1, 2.0)}
    months = {(r["SalesMonth"], r["Orders"], r["Customers"]) for r in rp.monthly_report(rp.visits(lines)).collect()}
    assert months == {("2024-01", 3, 2), ("2024-02", 1, 1)}
