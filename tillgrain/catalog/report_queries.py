"""Reports, dashboard variants and inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import inventory, reports as rp, variants as va
from ..schema import BI_TRANSACTION_COLUMNS, CORRELATION_FEATURES
from ..session import scratch_path
from ..sources import store
from .base_queries import lines
from .base_sql import ORDER, days, money
from .data import features, stored
from .spec import Query

SKU_DEMAND = f"""SELECT "StockCode", {money('"Quantity"')} / count(*) AS avg_daily_demand,
      coalesce(stddev_samp("Quantity"), {money('"Quantity"')} / count(*) * CAST(0.3 AS DOUBLE)) AS demand_std,
      {money('"Quantity"')} AS current_velocity, avg("InventoryRiskScore") AS risk_score,
      arg_min("ProductCategory", ({ORDER})) AS category
    FROM features GROUP BY "StockCode" """

REORDER = f"""WITH sku_demand AS ({SKU_DEMAND}),
  points AS (SELECT *, FORECAST AS forecast_demand,
    CAST(1.65 AS DOUBLE) * demand_std * sqrt(7.0) AS safety_stock FROM sku_demand),
  reorder AS (SELECT *, round_even((reorder_point + economic_order_qty) * CAST(1.2 AS DOUBLE), 0) AS recommended_order_qty,
      CASE WHEN risk_score > CAST(0.7 AS DOUBLE) THEN 'Critical – Reorder Now'
        WHEN risk_score > CAST(0.4 AS DOUBLE) THEN 'Monitor' ELSE 'Healthy' END AS stock_status
    FROM (SELECT *, forecast_demand * 7 + safety_stock AS reorder_point,
      sqrt(2 * current_velocity * 50.0 / (greatest(avg_daily_demand, 0.1) * CAST(0.2 AS DOUBLE))) AS economic_order_qty
      FROM points))
RESULT
"""
PLAIN_REORDER = REORDER.replace("FORECAST", "avg_daily_demand")

VARIANT_CUSTOMERS = f"""SELECT "Customer ID", {money('"TotalAmount"')} AS "CustomerLifetimeValue",
      {money('"TotalAmount"')} / count(*) AS "AvgOrderValue",
      count(DISTINCT "Invoice") / CAST(greatest({days('max("InvoiceDate")', 'min("InvoiceDate")')} + 1, 1) AS DOUBLE) AS "PurchaseFrequency",
      date_diff('day', CAST(max("InvoiceDate") AS DATE), CAST((SELECT snapshot FROM snap) AS DATE) + 1) AS "DaysSinceLastPurchase"
    FROM lines GROUP BY "Customer ID" """

VARIANT_SEGMENTS = f"""WITH vc AS ({VARIANT_CUSTOMERS}),
  cuts AS (SELECT quantile_cont("CustomerLifetimeValue", 0.70) AS high, quantile_cont("CustomerLifetimeValue", 0.35) AS low,
    quantile_cont("DaysSinceLastPurchase", 0.35) AS recent, quantile_cont("DaysSinceLastPurchase", 0.75) AS inactive,
    quantile_cont("PurchaseFrequency", 0.65) AS frequent FROM vc),
  vseg AS (SELECT "Customer ID" AS vid, "CustomerLifetimeValue" AS vclv, "AvgOrderValue" AS vaov,
    "PurchaseFrequency" AS vfreq, "DaysSinceLastPurchase" AS vdays,
    CASE WHEN "CustomerLifetimeValue" >= high AND "DaysSinceLastPurchase" <= recent THEN 'Champions'
      WHEN "PurchaseFrequency" >= frequent THEN 'Loyal' WHEN "CustomerLifetimeValue" >= high THEN 'High Value'
      WHEN "DaysSinceLastPurchase" >= inactive THEN 'At Risk' WHEN "CustomerLifetimeValue" <= low THEN 'New'
      ELSE 'Regular' END AS vsegment,
    CASE WHEN "DaysSinceLastPurchase" >= inactive THEN 1 ELSE 0 END AS vchurn
    FROM vc CROSS JOIN cuts)"""

VARIANT_DAILY = """vcal AS (SELECT CAST(unnest(generate_series(min(sales_date), max(sales_date), INTERVAL 1 DAY)) AS DATE) AS day FROM daily),
  vfilled AS (SELECT day, coalesce(daily_sales, 0.0) AS y FROM vcal LEFT JOIN daily ON day = sales_date),
  vdaily AS (SELECT day, y AS vsales,
    CAST(sum(CAST(y AS DECIMAL(18,6))) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS vroll7,
    CAST(sum(CAST(y AS DECIMAL(18,6))) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) AS vroll30,
    coalesce(lag(y, 1) OVER (ORDER BY day), 0.0) AS vlag1, coalesce(lag(y, 7) OVER (ORDER BY day), 0.0) AS vlag7
    FROM vfilled)"""

VARIANT_RISK = """vspread AS (SELECT "StockCode" AS code, coalesce(stddev_samp("Quantity"), 0.0) AS spread FROM lines GROUP BY "StockCode"),
  vrisk AS (SELECT code, least(greatest((spread - min(spread) OVER ()) /
    (max(spread) OVER () - min(spread) OVER () + CAST(1e-9 AS DOUBLE)), 0.0), 1.0) AS vrisk FROM vspread)"""

VARIANT_COUNTRY = f"""vcountry AS (SELECT "Country" AS vname, sales AS vsales_total, dense_rank() OVER (ORDER BY sales DESC) AS vrank
    FROM (SELECT "Country", {money('"TotalAmount"')} AS sales FROM lines GROUP BY "Country"))"""

VARIANT_MONTH = f"""vmonth AS (SELECT "InvoiceMonth" AS m, {money('"TotalAmount"')} AS revenue FROM lines GROUP BY "InvoiceMonth"),
  vseason AS (SELECT m, revenue / (SELECT {money('revenue')} / count(*) FROM vmonth) AS vindex FROM vmonth)"""


def reorder(spark, sf):
    return stored(spark, sf, "reorder", lambda: inventory.reorder_table(features(spark, sf)))


def given_forecast(spark, sf):
    """A forecast taken from the data: the rolling means of the last 30 sales days."""
    per_day = features(spark, sf).groupBy("sales_date").agg(F.max("Rolling7DaySales").alias("yhat"))
    return per_day.orderBy(F.desc("sales_date")).limit(30)


def measured_metrics(spark, sf):
    """Metric rows whose values are measured on the data."""
    facts = features(spark, sf)
    rates = facts.agg(F.avg("ChurnFlag").alias("roc_auc"), F.avg("WeekendFlag").alias("precision"))
    churn = rates.unpivot([], ["roc_auc", "precision"], "metric", "value").withColumn("model", F.lit("churn"))
    daily = facts.select("sales_date", "daily_sales").distinct().agg(
        (sc.exact_avg("daily_sales") / 1e6).alias("mape"))
    sales = daily.unpivot([], ["mape"], "metric", "value").withColumn("model", F.lit("forecasting"))
    return churn.unionByName(sales)


METRICS_SQL = f"""metric_rows AS (
    SELECT 'churn' AS model, 'roc_auc' AS metric, avg("ChurnFlag") AS value FROM features
    UNION ALL SELECT 'churn', 'precision', avg("WeekendFlag") FROM features
    UNION ALL SELECT 'forecasting', 'mape', {money('daily_sales')} / count(*) / 1e6 FROM daily)"""


def pass_through(spark, sf):
    """The reorder table as CSV and back; a table that is absent is skipped."""
    path = scratch_path(spark, "inventory-csv")
    store.write_csv(reorder(spark, sf), path, single_file=True)
    return spark.read.option("header", True).csv(path)


def variant_churn(spark, sf):
    flagged, _ = va.segment_rules(stored(spark, sf, "variant-customers",
                                         lambda: va.customer_features(lines(spark, sf))))
    return flagged


def variant_table(spark, sf):
    return va.dashboard_features(lines(spark, sf))


def daily_of(spark, sf):
    return lines(spark, sf).groupBy("sales_date").agg(sc.exact_sum("TotalAmount").alias("daily_sales"))


_corr = "\n    UNION ALL ".join(
    f"""SELECT '{x}' AS x, '{y}' AS y, corr("{x}", "{y}") AS r FROM features"""
    for x in CORRELATION_FEATURES for y in CORRELATION_FEATURES)

_box = "\n    UNION ALL ".join(f"""SELECT '{c}' AS "column", q1, median, q3,
      (SELECT min("{c}") FROM features WHERE "{c}" BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
      (SELECT max("{c}") FROM features WHERE "{c}" BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
      (SELECT count(*) FROM features WHERE NOT "{c}" BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM (SELECT quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.5) AS median,
      quantile_cont("{c}", 0.75) AS q3 FROM features)""" for c in ("Price", "Quantity"))


def _sales_by(column, kind):
    return Query(f"{column}:{kind}, TotalAmount:2", lambda s, d: rp.sales_by(features(s, d), column), f"""
        SELECT "{column}", {money('"TotalAmount"')} AS "TotalAmount" FROM features GROUP BY "{column}" """)


REORDER_COLUMNS = ("StockCode:s, avg_daily_demand:6, demand_std:6, current_velocity:4, risk_score:7, category:s, "
                   "forecast_demand:5, safety_stock:5, reorder_point:5, economic_order_qty:5, "
                   "recommended_order_qty:i, stock_status:s")

QUERIES = {
    "d12_bi_transactions": Query(
        "Invoice:s, StockCode:s, Description:s, Quantity:6, InvoiceDate:t, Price:6, Customer ID:s, Country:s, "
        "TotalAmount:6, InvoiceMonth:i, InvoiceDay:i, InvoiceHour:i, WeekendFlag:i, ProductCategory:s, "
        "CustomerSegment:s, ChurnFlag:i, InventoryRiskScore:7",
        lambda s, d: sc.select_available(features(s, d), BI_TRANSACTION_COLUMNS), "SELECT * FROM features"),
    "e04_daily_report": Query("SalesDate:d, TotalSales:2, TotalQuantity:4, Orders:i, Customers:i, AOV:4",
        lambda s, d: rp.daily_report(features(s, d)), f"""
        SELECT *, "TotalSales" / greatest("Orders", 1) AS "AOV" FROM (
          SELECT sales_date AS "SalesDate", {money('"TotalAmount"')} AS "TotalSales",
            {money('"Quantity"')} AS "TotalQuantity", count(DISTINCT "Invoice") AS "Orders",
            count(DISTINCT "Customer ID") AS "Customers" FROM features GROUP BY sales_date)"""),
    "e04_monthly_report": Query("SalesMonth:s, TotalSales:2, TotalQuantity:4, Orders:i, Customers:i, AOV:4",
        lambda s, d: rp.monthly_report(stored(s, d, "visits", lambda: rp.visits(features(s, d)))), f"""
        SELECT *, "TotalSales" / greatest("Orders", 1) AS "AOV" FROM (
          SELECT strftime(sales_date, '%Y-%m') AS "SalesMonth", {money('"TotalAmount"')} AS "TotalSales",
            {money('"Quantity"')} AS "TotalQuantity", count(DISTINCT "Invoice") AS "Orders",
            count(DISTINCT "Customer ID") AS "Customers" FROM features GROUP BY ALL)"""),
    "e06_sku_demand": Query("StockCode:s, avg_daily_demand:6, demand_std:6, current_velocity:4, risk_score:7, category:s",
        lambda s, d: inventory.sku_demand(features(s, d)), SKU_DEMAND),
    "e07_summary_kpis": Query("n_rows:i, n_customers:i, n_products:i, n_countries:i, first_date:t, last_date:t, "
        "total_revenue:2, avg_order_value:4, churn_rate:9", lambda s, d: rp.summary_kpis(features(s, d)), f"""
        SELECT count(*) AS n_rows, count(DISTINCT "Customer ID") AS n_customers,
          count(DISTINCT "StockCode") AS n_products, count(DISTINCT "Country") AS n_countries,
          min("InvoiceDate") AS first_date, max("InvoiceDate") AS last_date,
          {money('"TotalAmount"')} AS total_revenue,
          (SELECT {money('v')} / count(*) FROM (SELECT {money('"TotalAmount"')} AS v FROM features GROUP BY "Invoice")) AS avg_order_value,
          (SELECT avg("ChurnFlag") FROM first_lines) AS churn_rate FROM features"""),
    "e08_executive_kpis": Query("revenue:2, customers:i, transactions:i, churn_rate:9",
        lambda s, d: rp.executive_kpis(features(s, d)), f"""
        SELECT {money('"TotalAmount"')} AS revenue, count(DISTINCT "Customer ID") AS customers,
          count(*) AS transactions, (SELECT avg("ChurnFlag") FROM first_lines) AS churn_rate FROM features"""),
    "e09_revenue_by_segment": _sales_by("CustomerSegment", "s"),
    "e10_revenue_by_hour": _sales_by("InvoiceHour", "i"),
    "e11_revenue_by_month": _sales_by("InvoiceMonth", "i"),
    "e12_country_report": Query("Country:s, TotalSales:2, Customers:i", lambda s, d: rp.country_report(features(s, d)), f"""
        SELECT "Country", {money('"TotalAmount"')} AS "TotalSales", count(DISTINCT "Customer ID") AS "Customers"
        FROM features GROUP BY "Country" """),
    "e13_category_report": Query("ProductCategory:s, TotalSales:2, Quantity:4, SKUs:i",
        lambda s, d: rp.category_report(features(s, d)), f"""
        SELECT "ProductCategory", {money('"TotalAmount"')} AS "TotalSales", {money('"Quantity"')} AS "Quantity",
          count(DISTINCT "StockCode") AS "SKUs" FROM features GROUP BY "ProductCategory" """),
    "e14_customer_report": Query("Customer ID:s, CustomerLifetimeValue:2, AvgOrderValue:4, PurchaseFrequency:9, "
        "DaysSinceLastPurchase:i, Orders:i, Quantity:4, Revenue:2, LastPurchase:t, Country:s, CustomerSegment:s, "
        "ChurnFlag:i, SnapshotDate:t", lambda s, d: rp.customer_report(features(s, d)), f"""
        WITH totals AS (SELECT "Customer ID" AS cid, count(DISTINCT "Invoice") AS "Orders", {money('"Quantity"')} AS units,
          {money('"TotalAmount"')} AS "Revenue", max("InvoiceDate") AS "LastPurchase" FROM features GROUP BY "Customer ID")
RESULT
        SELECT f.* EXCLUDE ("Quantity"), t.units AS "Quantity", "Orders", "Revenue", "LastPurchase",
          (SELECT snapshot FROM snap) AS "SnapshotDate" FROM first_lines f JOIN totals t ON f."Customer ID" = t.cid"""),
    "e15_customers_per_segment": Query("CustomerSegment:s, customers:i",
        lambda s, d: rp.customers_per_segment(features(s, d)), """
        SELECT "CustomerSegment", count(DISTINCT "Customer ID") AS customers FROM features GROUP BY ALL"""),
    "e16_first_line_per_customer": Query("Customer ID:s, CustomerLifetimeValue:2, AvgOrderValue:4, PurchaseFrequency:9, "
        "DaysSinceLastPurchase:i, Rolling7DaySales:2, Rolling30DaySales:2, SeasonalIndex:9, InventoryRiskScore:7, "
        "ChurnFlag:i, Country:s, Invoice:s", lambda s, d: rp.first_per_key(features(s, d), "Customer ID", [
            "CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency", "DaysSinceLastPurchase", "Rolling7DaySales",
            "Rolling30DaySales", "SeasonalIndex", "InventoryRiskScore", "ChurnFlag", "Country", "Invoice"]),
        "SELECT * FROM first_lines"),
    "e17_daily_vs_rolling": Query("InvoiceDate:d, actual:2, rolling_7:2", lambda s, d: rp.daily_vs_rolling(features(s, d)), f"""
        SELECT sales_date AS "InvoiceDate", {money('"TotalAmount"')} AS actual,
          {money('"Rolling7DaySales"')} / count(*) AS rolling_7 FROM features GROUP BY sales_date"""),
    "e18_correlation_matrix": Query("x:s, y:s, r:6", lambda s, d: rp.correlation_matrix(features(s, d)), _corr),
    "e19_histogram": Query("bin:i, bin_start:2, n:i", lambda s, d: rp.histogram(
        rp.first_per_key(features(s, d), "Customer ID", ["CustomerLifetimeValue"]), "CustomerLifetimeValue"), """
        WITH edges AS (SELECT min("CustomerLifetimeValue") AS low, max("CustomerLifetimeValue") AS high FROM first_lines),
          counted AS (SELECT least(floor(("CustomerLifetimeValue" - low) / (high - low) * 50), 49) AS b, count(*) AS n
            FROM first_lines CROSS JOIN edges GROUP BY ALL)
RESULT
        SELECT range AS bin, low + range * ((high - low) / 50) AS bin_start, coalesce(n, 0) AS n
        FROM range(50) CROSS JOIN edges LEFT JOIN counted ON range = b"""),
    "e19_recency_by_churn": Query("ChurnFlag:i, bin:i, bin_start:4, n:i", lambda s, d: rp.histogram(
        rp.first_per_key(features(s, d), "Customer ID", ["DaysSinceLastPurchase", "ChurnFlag"]),
        "DaysSinceLastPurchase", by=["ChurnFlag"]), """
        WITH edges AS (SELECT CAST(min("DaysSinceLastPurchase") AS DOUBLE) AS low,
            CAST(max("DaysSinceLastPurchase") AS DOUBLE) AS high FROM first_lines),
          counted AS (SELECT "ChurnFlag", least(floor(("DaysSinceLastPurchase" - low) / (high - low) * 50), 49) AS bin, count(*) AS n
            FROM first_lines CROSS JOIN edges GROUP BY ALL)
RESULT
        SELECT "ChurnFlag", bin, low + bin * ((high - low) / 50) AS bin_start, n FROM counted CROSS JOIN edges"""),
    "e20_box_summary": Query("column:s, q1:6, median:6, q3:6, whisker_low:6, whisker_high:6, outliers:i",
        lambda s, d: rp.box_summary(features(s, d), ["Price", "Quantity"]), _box),
    "e21_inventory_kpis": Query("skus:i, critical:i, avg_reorder_qty:6", lambda s, d: rp.inventory_kpis(reorder(s, d)),
        PLAIN_REORDER + f"""SELECT count(*) AS skus, count(*) FILTER (starts_with(stock_status, 'Critical')) AS critical,
          {money('recommended_order_qty')} / count(*) AS avg_reorder_qty FROM reorder"""),
    "e22_bi_measures": Query("total_sales:2, total_quantity:4, orders:i, customers:i, aov:4, churn_rate:9, "
        "forecast_mape:6, churn_auc:9", lambda s, d: rp.bi_measures(
            features(s, d), rp.model_metric_table(measured_metrics(s, d))), f"""
        WITH {METRICS_SQL}
RESULT
        SELECT *, total_sales / nullif(orders, 0) AS aov FROM (SELECT {money('"TotalAmount"')} AS total_sales,
          {money('"Quantity"')} AS total_quantity, count(DISTINCT "Invoice") AS orders,
          count(DISTINCT "Customer ID") AS customers, (SELECT avg("ChurnFlag") FROM first_lines) AS churn_rate,
          (SELECT max(value) FROM metric_rows WHERE metric = 'mape') AS forecast_mape,
          (SELECT max(value) FROM metric_rows WHERE metric = 'roc_auc') AS churn_auc FROM features)"""),
    "e23_model_metric_table": Query("Model:s, Metric:s, Value:6",
        lambda s, d: rp.model_metric_table(measured_metrics(s, d)), f"""
        WITH {METRICS_SQL}
RESULT
        SELECT CASE model WHEN 'churn' THEN 'Churn Prediction' ELSE 'Demand Forecasting' END AS "Model",
          CASE metric WHEN 'roc_auc' THEN 'ROC-AUC' WHEN 'precision' THEN 'Precision' ELSE 'MAPE' END AS "Metric",
          value AS "Value" FROM metric_rows
        UNION ALL SELECT 'Churn Prediction', 'Target ROC-AUC', 0.88
        UNION ALL SELECT 'Demand Forecasting', 'Target MAPE', 12.0"""),
    "e24_pass_through": Query("StockCode:s, category:s, recommended_order_qty:i, stock_status:s",
        lambda s, d: pass_through(s, d).withColumn("recommended_order_qty", F.col("recommended_order_qty").cast("double")),
        PLAIN_REORDER + "SELECT * FROM reorder"),
    "e25_stock_list": Query("StockCode:s, category:s, recommended_order_qty:i, reorder_point:5, stock_status:s",
        lambda s, d: rp.stock_list(reorder(s, d), ["Critical – Reorder Now", "Monitor"]), PLAIN_REORDER + """
        SELECT * FROM reorder WHERE stock_status IN ('Critical – Reorder Now', 'Monitor') ORDER BY "StockCode" LIMIT 50"""),
    "w12_top_countries": Query("Country:s, TotalAmount:2", lambda s, d: rp.top_countries(features(s, d)), f"""
        SELECT "Country", {money('"TotalAmount"')} AS "TotalAmount" FROM features GROUP BY "Country"
        ORDER BY 2 DESC, 1 LIMIT 15"""),
    "w12_at_risk_customers": Query("Customer ID:s, CustomerLifetimeValue:2, DaysSinceLastPurchase:i, ChurnFlag:i",
        lambda s, d: rp.at_risk_customers(features(s, d)), """
        SELECT * FROM first_lines ORDER BY "DaysSinceLastPurchase" DESC, "Customer ID" LIMIT 20"""),
    "m14_quality_gates": Query("model:s, metric:s, value:6, distance:6, passed:i",
        lambda s, d: rp.quality_gates(measured_metrics(s, d)), f"""
        WITH {METRICS_SQL}
RESULT
        SELECT *, value - 12 AS distance, value <= 12 AS passed FROM metric_rows WHERE metric = 'mape'
        UNION ALL SELECT *, value - CAST(0.88 AS DOUBLE), value >= CAST(0.88 AS DOUBLE) * CAST(0.95 AS DOUBLE)
        FROM metric_rows WHERE metric = 'roc_auc'"""),
    "i01_reorder_table": Query(REORDER_COLUMNS, reorder, PLAIN_REORDER + "SELECT * FROM reorder"),
    "i02_forecast_demand": Query(REORDER_COLUMNS,
        lambda s, d: inventory.reorder_table(features(s, d), given_forecast(s, d)), REORDER.replace("FORECAST", """(
        SELECT avg(y) FROM (SELECT "Rolling7DaySales" AS y FROM daily_features ORDER BY sales_date DESC LIMIT 30))
        / (SELECT count(DISTINCT "StockCode") FROM features)""") + "SELECT * FROM reorder"),
    "v01_customer_features": Query("Customer ID:s, CustomerLifetimeValue:2, AvgOrderValue:4, PurchaseFrequency:9, "
        "DaysSinceLastPurchase:i", lambda s, d: va.customer_features(lines(s, d)), VARIANT_CUSTOMERS),
    "v02_rolling_sums": Query("sales_date:d, daily_sales:2, Rolling7DaySales:2, Rolling30DaySales:2, Lag_1_Day_Sales:2, "
        "Lag_7_Day_Sales:2", lambda s, d: va.daily_features(daily_of(s, d)), f"""
        WITH {VARIANT_DAILY}
RESULT
        SELECT day AS sales_date, vsales AS daily_sales, vroll7 AS "Rolling7DaySales", vroll30 AS "Rolling30DaySales",
          vlag1 AS "Lag_1_Day_Sales", vlag7 AS "Lag_7_Day_Sales" FROM vdaily"""),
    "v03_dense_rank": Query("Country:s, sales:2, CountrySalesRank:i", lambda s, d: va.country_dense_rank(lines(s, d)), f"""
        WITH {VARIANT_COUNTRY}
RESULT
        SELECT vname AS "Country", vsales_total AS sales, vrank AS "CountrySalesRank" FROM vcountry"""),
    "v04_segment_rules": Query("Customer ID:s, CustomerSegment:s", variant_churn, VARIANT_SEGMENTS + """
RESULT
        SELECT vid AS "Customer ID", vsegment AS "CustomerSegment" FROM vseg"""),
    "v05_quantile_churn": Query("Customer ID:s, DaysSinceLastPurchase:i, ChurnFlag:i", variant_churn, VARIANT_SEGMENTS + """
RESULT
        SELECT vid AS "Customer ID", vdays AS "DaysSinceLastPurchase", vchurn AS "ChurnFlag" FROM vseg"""),
    "v06_seasonal_totals": Query("InvoiceMonth:i, SeasonalIndex:9", lambda s, d: va.seasonal_index(lines(s, d)), f"""
        WITH {VARIANT_MONTH}
RESULT
        SELECT m AS "InvoiceMonth", vindex AS "SeasonalIndex" FROM vseason"""),
    "v07_spread_risk": Query("StockCode:s, InventoryRiskScore:7", lambda s, d: va.sku_spread_risk(lines(s, d)), f"""
        WITH {VARIANT_RISK}
RESULT
        SELECT code AS "StockCode", vrisk AS "InventoryRiskScore" FROM vrisk"""),
    "v08_reorder_by_rate": Query("StockCode:s, category:s, total_demand:4, demand_std:6, avg_daily_demand:9, "
        "reorder_point:6, recommended_order_qty:i, stock_status:s",
        lambda s, d: va.reorder_by_rate(features(s, d)), f"""
        WITH base AS (SELECT "StockCode", "ProductCategory" AS category, {money('"Quantity"')} AS total_demand,
            coalesce(stddev_samp("Quantity"), 0.0) AS demand_std,
            {money('"Quantity"')} / (SELECT CAST(greatest({days('max("InvoiceDate")', 'min("InvoiceDate")')}, 1) AS DOUBLE) FROM features)
              AS avg_daily_demand FROM features GROUP BY ALL),
          pts AS (SELECT *, round(avg_daily_demand * 7 + CAST(1.65 AS DOUBLE) * demand_std * sqrt(7.0), 9) AS reorder_point FROM base),
          cuts AS (SELECT quantile_cont(reorder_point, 0.75) AS high, quantile_cont(reorder_point, 0.35) AS low FROM pts)
RESULT
        SELECT *, ceil(avg_daily_demand * 30 + reorder_point) AS recommended_order_qty,
          CASE WHEN reorder_point >= high THEN 'Critical - Reorder Now' WHEN reorder_point <= low THEN 'Healthy'
            ELSE 'Monitor' END AS stock_status FROM pts CROSS JOIN cuts"""),
    "v09_segment_codes": Query("SegmentLabel:s, code:i", lambda s, d: va.segment_codes(features(s, d)), """
        SELECT "CustomerSegment" AS "SegmentLabel", row_number() OVER (ORDER BY min("Customer ID")) - 1 AS code
        FROM first_lines GROUP BY "CustomerSegment" """),
    "variant_feature_table": Query("Invoice:s, StockCode:s, Customer ID:s, InvoiceDate:t, Quantity:6, Price:6, daily_sales:2, "
        "Rolling7DaySales:2, Lag_7_Day_Sales:2, SeasonalIndex:9, CountrySalesRank:i, CustomerLifetimeValue:2, "
        "AvgOrderValue:4, PurchaseFrequency:9, DaysSinceLastPurchase:i, CustomerSegment:s, ChurnFlag:i, "
        "InventoryRiskScore:7", variant_table, VARIANT_SEGMENTS + f""", {VARIANT_DAILY}, {VARIANT_RISK},
        {VARIANT_COUNTRY}, {VARIANT_MONTH}
RESULT
        SELECT l.*, vsales AS daily_sales, vroll7 AS "Rolling7DaySales", vlag7 AS "Lag_7_Day_Sales", vindex AS "SeasonalIndex",
          vrank AS "CountrySalesRank", vclv AS "CustomerLifetimeValue", vaov AS "AvgOrderValue", vfreq AS "PurchaseFrequency",
          vdays AS "DaysSinceLastPurchase", vsegment AS "CustomerSegment", vchurn AS "ChurnFlag", vrisk AS "InventoryRiskScore"
        FROM lines l JOIN vseg ON l."Customer ID" = vid JOIN vdaily ON sales_date = day JOIN vseason ON "InvoiceMonth" = m
          JOIN vcountry ON "Country" = vname JOIN vrisk ON "StockCode" = code"""),
}
