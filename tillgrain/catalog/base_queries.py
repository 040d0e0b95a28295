"""Sources, cleaning, gates, row expressions, windows and joins."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import scalars as sc
from ..operators import clean as cl, features as ft, quality, ranking
from ..operators.joins import attach
from ..schema import BI_TRANSACTION_COLUMNS, CHURN_FEATURES, LINE_KEY, REQUIRED, ROW_ORDER
from ..session import materialize, scratch_path
from ..sources import ingest, store
from .base_sql import ORDER, days, money
from .data import clean, features, stored
from .fixtures import dirty_transactions, joined_lines, plain_transactions, table
from .spec import Query

RAW = "Invoice:s, StockCode:s, Description:s, Quantity:s, InvoiceDate:s, Price:s, Customer ID:s, Country:s"
TYPED = "Invoice:s, StockCode:s, Description:s, Quantity:6, InvoiceDate:t, Price:6, Customer ID:s, Country:s"
LINE = "Invoice:s, StockCode:s, Quantity:6, Price:6, InvoiceDate:t, Customer ID:s"

# Raw headings as found in the wild; matched by the alias rules.
HEADINGS = {"Invoice": "Invoice No", "StockCode": "SKU", "Description": "product description",
            "Quantity": " Qty", "InvoiceDate": "Order Date", "Price": "unit_price",
            "Customer ID": "CustomerNo", "Country": "Market"}


def coerced(spark, sf):
    return cl.coerce_types(dirty_transactions(spark, sf))


def valid(spark, sf):
    return cl.drop_missing_critical(coerced(spark, sf))


def lines(spark, sf):
    return sc.with_line_features(clean(spark, sf))


def customers(spark, sf):
    return stored(spark, sf, "customers", lambda: ft.customer_table(lines(spark, sf)))


def volatility(spark, sf):
    return stored(spark, sf, "sku-volatility", lambda: ft.sku_volatility(lines(spark, sf)))


def raw_csv(spark, sf):
    """The dirty lines as a CSV folder with unusual headings."""
    path = scratch_path(spark, "raw-csv")
    raw = dirty_transactions(spark, sf)
    store.write_csv(raw.select(*[F.col(f"`{c}`").alias(h) for c, h in HEADINGS.items()],
                               F.lit("x").alias("unused")), path)
    return path


def csv_scan(spark, sf):
    return cl.coerce_types(ingest.read_csv(spark, raw_csv(spark, sf)))


def alias_columns(spark, sf):
    raw = dirty_transactions(spark, sf)
    return ingest.normalize_columns(
        raw.select(*[F.col(f"`{c}`").alias(h) for c, h in HEADINGS.items()]))


def required_columns(spark, sf):
    return ingest.require_columns(dirty_transactions(spark, sf).withColumn("unused", F.lit(1)))


def parquet_scan(spark, sf):
    path = scratch_path(spark, "features")
    store.write_parquet(features(spark, sf).select("Invoice", "StockCode", "TotalAmount",
                                                   "CustomerSegment"), path)
    return (ingest.read_features(spark, path).groupBy("CustomerSegment")
            .agg(F.count("*").alias("n"), sc.exact_sum("TotalAmount").alias("revenue")))


def parquet_sink(spark, sf):
    path = scratch_path(spark, "feature-store")
    store.write_feature_store(features(spark, sf), path)
    return (spark.read.parquet(path).groupBy("year", "month")
            .agg(F.count("*").alias("n"), sc.exact_sum("TotalAmount").alias("revenue")))


def csv_sink(spark, sf):
    path = scratch_path(spark, "bi-csv")
    store.write_csv(sc.select_available(features(spark, sf), BI_TRANSACTION_COLUMNS), path)
    back = spark.read.option("header", True).csv(path)
    return (back.groupBy("Country").agg(
        F.count("*").alias("n"), F.sum(F.col("Quantity").cast("decimal(18,6)")).alias("units"),
        F.countDistinct("Customer ID").alias("customers")))


def metrics_json(spark, sf):
    facts = features(spark, sf)
    metrics = facts.agg(F.avg("ChurnFlag").alias("churn_share"),
                        F.avg("WeekendFlag").alias("weekend_share")).unpivot(
        [], ["churn_share", "weekend_share"], "metric", "value").withColumn("model", F.lit("churn"))
    sizes = facts.agg(F.count("*").cast("double").alias("rows")).unpivot(
        [], ["rows"], "metric", "value").withColumn("model", F.lit("forecasting"))
    churn, sales = scratch_path(spark, "churn-metrics"), scratch_path(spark, "forecast-metrics")
    store.write_metrics(metrics, churn)
    store.write_metrics(sizes, sales)
    return store.read_metrics(spark, [churn, sales, scratch_path(spark, "never-written")])


def limited_read(spark, sf):
    return store.first_rows(customers(spark, sf), [F.desc("CustomerLifetimeValue"), "Customer ID"], 100)


def reference_snapshot(spark, sf):
    path = scratch_path(spark, "reference")
    facts = features(spark, sf)
    store.reference_snapshot(facts, path)
    again = store.reference_snapshot(facts.limit(0), path)   # exists now, so it is reused
    return again.groupBy("sales_date").agg(F.count("*").alias("n"))


def fallback_chain(spark, sf):
    got = ingest.read_features_or_raw(spark, scratch_path(spark, "absent"), raw_csv(spark, sf))
    return got.groupBy("ProductCategory").agg(
        F.count("*").alias("n"), sc.exact_sum("TotalAmount").alias("revenue"),
        F.sum("ChurnFlag").alias("churned_lines"))


def fill_text(spark, sf):
    return cl.fill_descriptions(materialize(valid(spark, sf), "valid"))


def capped(spark, sf):
    rows = materialize(cl.keep_positive(cl.bucket_guests(valid(spark, sf))), "positive")
    return cl.cap_outliers(rows, cl.find_caps(rows))


def cap_values(spark, sf):
    caps = cl.find_caps(cl.keep_positive(valid(spark, sf)))
    flagged = clean(spark, sf).agg(F.sum("is_outlier_capped").alias("n_capped"))
    return flagged.select(F.lit(caps.price).alias("price_cap"),
                          F.lit(caps.quantity).alias("quantity_cap"), "n_capped")


def iqr_flag(spark, sf):
    return cl.flag_iqr_outliers(clean(spark, sf).withColumn(
        "TotalAmount", sc.line_amount()), "TotalAmount")


def feature_gate(spark, sf):
    facts = features(spark, sf)
    quality.assert_features(facts)
    wanted = ["TotalAmount", "CustomerLifetimeValue", "Rolling7DaySales", "CustomerSegment",
              "ChurnFlag"]
    return quality.profile(facts.select(*wanted))


def daily(spark, sf):
    return ft.with_daily_features(ft.daily_sales(lines(spark, sf)))


def row_ranks(spark, sf):
    """Tie-broken rank of every line by its customer's recency, orders and value.

    Cleaning leaves one line per line key, so the rest of the row order breaks no tie and is not carried.
    """
    order = [c for c in ROW_ORDER if c in LINE_KEY]
    measures = customers(spark, sf).select("Customer ID", "n_lines", "DaysSinceLastPurchase", "order_count",
                                           "CustomerLifetimeValue")
    stored_rows = materialize(attach(lines(spark, sf).select(*[F.col(f"`{c}`") for c in order]).filter(
        F.col("Customer ID").isNotNull()), measures, "Customer ID", "n_lines"), "ranked-lines")
    out = stored_rows
    for measure, name in (("DaysSinceLastPurchase", "r_rank"), ("order_count", "f_rank"),
                          ("CustomerLifetimeValue", "m_rank")):
        out = ranking.with_row_rank(out, [measure, *order], name)
    return out


def row_quartiles(spark, sf):
    ranked = row_ranks(spark, sf)
    n = ranked.agg(F.count("*")).scalar()
    return ranked.withColumns({q: ft.quartile_of_rank(F.col(r), n) for q, r in
                               (("r_q", "r_rank"), ("f_q", "f_rank"), ("m_q", "m_rank"))})


def segments(spark, sf):
    return ft.customer_segments(lines(spark, sf), customers(spark, sf))


def group_transforms(spark, sf):
    """Group aggregates on each line: distinct invoices, mean and first description."""
    rows = lines(spark, sf)
    per = materialize(rows.groupBy("StockCode").agg(
        F.countDistinct("Invoice").alias("sku_invoices"), sc.exact_avg("TotalAmount").alias("sku_mean"),
        F.min_by("Description", F.struct(*[F.col(f"`{c}`") for c in ROW_ORDER])).alias("sku_first"),
        F.count("*").alias("n_lines")), "sku-groups")
    return attach(rows, per, "StockCode", "n_lines")


def country_ranks(spark, sf):
    return ft.country_ranks(materialize(ft.sales_cube(lines(spark, sf)), "cube"))


def percent_ranks(spark, sf):
    ranked = ranking.with_average_rank(volatility(spark, sf), "cv", "cv_rank", percent=True)
    return ranking.with_average_rank(ranked, "qty_sum", "qty_rank", percent=True)


def season(spark, sf):
    return ft.seasonal_index(ft.sales_cube(lines(spark, sf)))


def join_customers(spark, sf):
    from ..operators.joins import attach
    return attach(lines(spark, sf), customers(spark, sf).select(
        "Customer ID", "n_lines", "CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency",
        "DaysSinceLastPurchase"), "Customer ID", "n_lines")


def join_daily(spark, sf):
    return lines(spark, sf).join(materialize(daily(spark, sf), "daily"), "sales_date", "left")


def join_risk(spark, sf):
    from ..operators.joins import attach
    risk = materialize(ft.inventory_risk(volatility(spark, sf)).filter("InventoryRiskScore > 0.2"),
                       "sku-risk")
    return attach(lines(spark, sf), risk, "StockCode", "n_lines").withColumn(
        "InventoryRiskScore", F.coalesce("InventoryRiskScore", F.lit(0.5)))


def lookup_map(spark, sf):
    names = F.create_map(*[F.lit(x) for pair in (("Champions", "A"), ("Loyal", "B"), ("Potential", "C"))
                           for x in pair])
    found = segments(spark, sf).withColumn("code", F.element_at(names, F.col("CustomerSegment")))
    return found


def scalar_broadcast(spark, sf):
    rows = lines(spark, sf)
    snapshot = rows.agg(F.max("InvoiceDate")).scalar()
    mean = rows.agg(sc.exact_avg("TotalAmount")).scalar()
    return rows.withColumns({"age": sc.elapsed_days(snapshot, F.col("InvoiceDate")),
                             "ratio": F.col("TotalAmount") / mean})


def membership(spark, sf):
    """Lines on month-end sales days, and lines on all other days."""
    rows = lines(spark, sf)
    days_ = rows.groupBy("sales_date").agg(F.count("*").alias("n"))
    late = days_.filter(F.dayofmonth("sales_date") > 25).select("sales_date")
    inside = rows.join(late, "sales_date", "left_semi").groupBy("Country").agg(
        F.count("*").alias("n")).withColumn("part", F.lit("in"))
    outside = rows.join(late, "sales_date", "left_anti").groupBy("Country").agg(
        F.count("*").alias("n")).withColumn("part", F.lit("out"))
    return inside.unionByName(outside)


def half_split(spark, sf):
    first, rest = store.half_split(features(spark, sf))
    def per_day(df, name):
        return df.groupBy("sales_date").agg(F.count("*").alias("n")).withColumn("half", F.lit(name))

    return per_day(first, "reference").unionByName(per_day(rest, "current"))


FEATURES = ("Invoice:s, StockCode:s, Description:s, Quantity:6, InvoiceDate:t, Price:6, Customer ID:s, "
            "Country:s, is_outlier_capped:i, TotalAmount:6, InvoiceMonth:i, InvoiceDay:i, InvoiceHour:i, "
            "WeekendFlag:i, CustomerLifetimeValue:2, AvgOrderValue:4, PurchaseFrequency:9, "
            "DaysSinceLastPurchase:i, sales_date:d, Rolling7DaySales:2, Rolling30DaySales:2, "
            "Lag_1_Day_Sales:2, Lag_7_Day_Sales:2, daily_sales:2, ProductCategory:s, CountrySalesRank:1, "
            "CustomerSegment:s, ChurnFlag:i, SeasonalIndex:9, InventoryRiskScore:7")

QUERIES = {
    "a01_csv_scan": Query(TYPED, csv_scan, "SELECT * FROM coerced"),
    "a02_alias_columns": Query(RAW, alias_columns, "SELECT * FROM raw"),
    "a03_required_columns": Query(RAW, required_columns, "SELECT * FROM raw"),
    "a04_parquet_scan": Query("CustomerSegment:s, n:i, revenue:2", parquet_scan, f"""
        SELECT "CustomerSegment", count(*) AS n, {money('"TotalAmount"')} AS revenue
        FROM features GROUP BY ALL"""),
    "a05_parquet_sink": Query("year:i, month:i, n:i, revenue:2", parquet_sink, f"""
        SELECT year("InvoiceDate") AS year, month("InvoiceDate") AS month, count(*) AS n,
          {money('"TotalAmount"')} AS revenue FROM features GROUP BY ALL"""),
    "a06_csv_sink": Query("Country:s, n:i, units:4, customers:i", csv_sink, f"""
        SELECT "Country", count(*) AS n, {money('"Quantity"')} AS units,
          count(DISTINCT "Customer ID") AS customers FROM features GROUP BY ALL"""),
    "a07_metrics_json": Query("model:s, metric:s, value:9", metrics_json, """
        SELECT 'churn' AS model, 'churn_share' AS metric, avg("ChurnFlag") AS value FROM features
        UNION ALL SELECT 'churn', 'weekend_share', avg("WeekendFlag") FROM features
        UNION ALL SELECT 'forecasting', 'rows', count(*) FROM features"""),
    "a09_limited_read": Query("Customer ID:s, CustomerLifetimeValue:2, order_count:i, count:i", limited_read, """
        SELECT *, least((SELECT count(*) FROM cust), 100) AS count FROM cust
        ORDER BY "CustomerLifetimeValue" DESC, "Customer ID" LIMIT 100"""),
    "a10_reference_snapshot": Query("sales_date:d, n:i", reference_snapshot, f"""
        SELECT sales_date, count(*) AS n FROM (
          SELECT sales_date, row_number() OVER (ORDER BY {ORDER}) AS rn, count(*) OVER () AS total
          FROM features) WHERE rn <= total // 2 GROUP BY ALL"""),
    "a11_fallback_chain": Query("ProductCategory:s, n:i, revenue:2, churned_lines:i", fallback_chain, f"""
        SELECT "ProductCategory", count(*) AS n, {money('"TotalAmount"')} AS revenue,
          sum("ChurnFlag") AS churned_lines FROM features GROUP BY ALL"""),
    "b01_coerce_types": Query(TYPED, coerced, "SELECT * FROM coerced"),
    "b02_drop_missing_critical": Query(TYPED, valid, "SELECT * FROM valid"),
    "b03_fill_descriptions": Query("Invoice:s, StockCode:s, Description:s, Quantity:6", fill_text, """
        SELECT "Invoice", v."StockCode", coalesce("Description", mode_text, 'Unknown') AS "Description",
          "Quantity" FROM valid v LEFT JOIN text_modes t ON v."StockCode" = t."StockCode" """),
    "b03_description_modes": Query("StockCode:s, mode_description:s, n_missing:i",
        lambda s, d: cl.description_modes(valid(s, d)), """
        SELECT v."StockCode", any_value(mode_text) AS mode_description,
          count(*) - count("Description") AS n_missing
        FROM valid v LEFT JOIN text_modes t ON v."StockCode" = t."StockCode" GROUP BY v."StockCode" """),
    "b04_fill_countries": Query("Invoice:s, StockCode:s, Country:s, Quantity:6",
        lambda s, d: cl.fill_countries(valid(s, d)), """
        SELECT "Invoice", "StockCode", "Quantity",
          coalesce("Country", (SELECT mode_country FROM country_mode)) AS "Country" FROM valid"""),
    "b05_bucket_guests": Query("Invoice:s, StockCode:s, Quantity:6, Customer ID:s",
        lambda s, d: cl.bucket_guests(valid(s, d)), """
        SELECT "Invoice", "StockCode", "Quantity", coalesce("Customer ID", 'GUEST') AS "Customer ID" FROM valid"""),
    "b06_keep_positive": Query(TYPED, lambda s, d: cl.keep_positive(valid(s, d)),
        'SELECT * FROM valid WHERE "Quantity" > 0 AND "Price" > 0'),
    "b07_cap_values": Query("price_cap:6, quantity_cap:6, n_capped:i", cap_values, """
        SELECT price_cap, quantity_cap, (SELECT sum(is_outlier_capped) FROM clean) AS n_capped FROM caps"""),
    "b08_outlier_flag": Query(LINE + ", is_outlier_capped:i", capped, "SELECT * FROM capped"),
    "b09_dedupe_lines": Query(LINE + ", Description:s, Country:s, is_outlier_capped:i", clean,
        "SELECT * FROM clean"),
    "b10_iqr_flag": Query(LINE + ", is_outlier:i", iqr_flag, """
        SELECT *, CASE WHEN "TotalAmount" < q1 - 1.5 * (q3 - q1) OR "TotalAmount" > q3 + 1.5 * (q3 - q1)
          THEN 1 ELSE 0 END AS is_outlier
        FROM lines CROSS JOIN (SELECT quantile_cont("TotalAmount", 0.25) AS q1,
          quantile_cont("TotalAmount", 0.75) AS q3 FROM lines)"""),
    "c01_raw_gates": Query("gate:s, measure:9, passed:i", lambda s, d: quality.gate_report(coerced(s, d)), """
        WITH shares AS (SELECT count(*) AS n, count("InvoiceDate") AS dates,
          greatest(""" + ", ".join(f'1 - count("{c}") / CAST(count(*) AS DOUBLE)' for c in REQUIRED) + """) AS worst
          FROM coerced)
RESULT
        SELECT 'not_empty' AS gate, n AS measure, n > 0 AS passed FROM shares
        UNION ALL SELECT 'some_dates', dates, dates > 0 FROM shares
        UNION ALL SELECT 'null_share', worst, worst <= 0.5 FROM shares"""),
    "c03_null_profile": Query("column:s, n:i, nulls:i, null_pct:9",
        lambda s, d: quality.profile(coerced(s, d)), "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count("{c}") AS nulls,
            (count(*) - count("{c}")) / CAST(count(*) AS DOUBLE) AS null_pct FROM coerced""" for c in REQUIRED)),
    "c04_feature_gate": Query("column:s, n:i, nulls:i, null_pct:9", feature_gate, "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count("{c}") AS nulls,
            (count(*) - count("{c}")) / CAST(count(*) AS DOUBLE) AS null_pct FROM features"""
            for c in ["TotalAmount", "CustomerLifetimeValue", "Rolling7DaySales", "CustomerSegment", "ChurnFlag"])),
    "d01_line_amount": Query(LINE + ", TotalAmount:6", lines, "SELECT * FROM lines"),
    "d02_calendar_parts": Query(LINE + ", InvoiceMonth:i, InvoiceDay:i, InvoiceHour:i, WeekendFlag:i, sales_date:d",
        lines, "SELECT * FROM lines"),
    "d05_elapsed_days": Query("Customer ID:s, first_purchase:t, last_purchase:t, span:i, idle:i",
        lambda s, d: customers(s, d).withColumns({
            "span": sc.elapsed_days(F.col("last_purchase"), F.col("first_purchase")),
            "idle": F.col("DaysSinceLastPurchase")}), f"""
        SELECT *, {days('last_purchase', 'first_purchase')} AS span, "DaysSinceLastPurchase" AS idle FROM cust"""),
    "d06_product_category": Query("Invoice:s, StockCode:s, Description:s, ProductCategory:s",
        lambda s, d: clean(s, d).withColumn("ProductCategory", sc.product_category("Description")),
        "SELECT * FROM lines"),
    "d07_clip": Query("StockCode:s, low:6, high:6, both:6",
        lambda s, d: volatility(s, d).select("StockCode", sc.clip(F.col("cv"), lower=0.5).alias("low"),
            sc.clip(F.col("cv"), upper=0.5).alias("high"), sc.clip(F.col("cv"), 0.45, 0.55).alias("both")), """
        SELECT "StockCode", greatest(cv, 0.5) AS low, least(cv, 0.5) AS high,
          least(greatest(cv, 0.45), 0.55) AS both FROM sku"""),
    "d08_log1p": Query("Customer ID:s, recency:9, frequency:9, monetary:9",
        lambda s, d: ft.rfm_matrix(lines(s, d)), """
        SELECT "Customer ID", ln(1 + CAST("DaysSinceLastPurchase" AS DOUBLE)) AS recency,
          ln(1 + CAST(order_count AS DOUBLE)) AS frequency,
          ln(1 + "CustomerLifetimeValue") AS monetary FROM cust"""),
    "d09_half_even": Query("Invoice:s, StockCode:s, Quantity:6, half:6, rounded:i",
        lambda s, d: clean(s, d).withColumn("half", F.col("Quantity") / 2)
            .withColumn("rounded", sc.half_even(F.col("half"))), """
        SELECT *, "Quantity" / 2 AS half, round_even("Quantity" / 2, 0) AS rounded FROM clean"""),
    "d10_threshold_buckets": Query("StockCode:s, InventoryRiskScore:7, stock_status:s, churn_risk:s",
        lambda s, d: ft.inventory_risk(volatility(s, d)).withColumns({
            "stock_status": sc.stock_status(F.col("InventoryRiskScore")),
            "churn_risk": sc.churn_risk(F.col("InventoryRiskScore"))}), """
        SELECT *, CASE WHEN "InventoryRiskScore" > CAST(0.7 AS DOUBLE) THEN 'Critical – Reorder Now'
            WHEN "InventoryRiskScore" > CAST(0.4 AS DOUBLE) THEN 'Monitor' ELSE 'Healthy' END AS stock_status,
          CASE WHEN "InventoryRiskScore" >= CAST(0.7 AS DOUBLE) THEN 'High'
            WHEN "InventoryRiskScore" >= CAST(0.4 AS DOUBLE) THEN 'Medium' ELSE 'Low' END AS churn_risk
        FROM sku_risk"""),
    "d11_membership_filter": Query("StockCode:s, Description:s, Country:s, Invoice:s",
        lambda s, d: clean(s, d).filter(F.col("Description").startswith("large")
                                        & F.col("Country").isin("NATION_1", "NATION_5", "NATION_12")), """
        SELECT * FROM clean WHERE starts_with("Description", 'large')
          AND "Country" IN ('NATION_1', 'NATION_5', 'NATION_12')"""),
    "d12_available_columns": Query("Invoice:s, Quantity:6, TotalAmount:6, ChurnFlag:i",
        lambda s, d: sc.select_available(features(s, d), ["Invoice", "Absent", "Quantity", "TotalAmount",
                                                          "ChurnFlag"]), "SELECT * FROM features"),
    "d13_fill_model_inputs": Query("event:i, value:6, quality:i, toxic:i",
        lambda s, d: sc.fill_model_inputs(
            table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left").select(
                F.col("doc_id").alias("event"), F.col("n_chars").alias("value"), "quality", "toxic"),
            ["quality", "toxic", "absent"]), """
        SELECT d.doc_id AS event, n_chars AS value, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "e01_customer_aggregate": Query("Customer ID:s, CustomerLifetimeValue:2, order_count:i, AvgOrderValue:4, "
        "PurchaseFrequency:9, DaysSinceLastPurchase:i, first_purchase:t, last_purchase:t, n_lines:i",
        lambda s, d: ft.customer_table(lines(s, d)), "SELECT * FROM cust"),
    "e02_rfm_matrix": Query("Customer ID:s, recency:i, frequency:i, monetary:2",
        lambda s, d: ft.rfm_matrix(lines(s, d), log_scale=False), """
        SELECT "Customer ID", "DaysSinceLastPurchase" AS recency, order_count AS frequency,
          "CustomerLifetimeValue" AS monetary FROM cust"""),
    "e03_daily_sales": Query("sales_date:d, daily_sales:2", lambda s, d: ft.daily_sales(lines(s, d)),
        "SELECT * FROM daily"),
    "e05_sku_volatility": Query("StockCode:s, sales_std:3, sales_mean:3, qty_sum:4, cv:7",
        lambda s, d: ft.sku_volatility(lines(s, d)), "SELECT * FROM sku"),
    "w01_rolling_and_lag": Query("sales_date:d, daily_sales:2, Rolling7DaySales:2, Rolling30DaySales:2, "
        "Lag_1_Day_Sales:2, Lag_7_Day_Sales:2", daily, "SELECT * FROM daily_features"),
    "w03_average_rank": Query("Country:s, sales:2, CountrySalesRank:1", country_ranks,
        "SELECT * FROM country_rank"),
    "w04_percent_rank": Query("StockCode:s, cv_rank:9, qty_rank:9", percent_ranks, "SELECT * FROM sku_risk"),
    "w05_row_rank": Query(LINE + ", r_rank:i, f_rank:i, m_rank:i", row_ranks, 'SELECT * FROM line_ranks'),
    "w06_quartile_bins": Query(LINE + ", r_q:i, f_q:i, m_q:i", row_quartiles, """
        SELECT *, greatest(1, ceil(4.0 * (r_rank - 1) / (n - 1))) AS r_q,
          greatest(1, ceil(4.0 * (f_rank - 1) / (n - 1))) AS f_q,
          greatest(1, ceil(4.0 * (m_rank - 1) / (n - 1))) AS m_q FROM line_ranks"""),
    "w07_rfm_segments": Query("Customer ID:s, rfm_score:i, CustomerSegment:s", segments, "SELECT * FROM segments"),
    "w08_group_transform": Query(LINE + ", sku_invoices:i, sku_mean:3, sku_first:s", group_transforms, f"""
        WITH g AS (SELECT "StockCode" AS code, count(DISTINCT "Invoice") AS sku_invoices,
            {money('"TotalAmount"')} / count(*) AS sku_mean FROM lines GROUP BY ALL),
          f AS (SELECT "StockCode" AS code2, "Description" AS sku_first FROM (
            SELECT *, row_number() OVER (PARTITION BY "StockCode" ORDER BY {ORDER}) AS rn FROM lines) WHERE rn = 1)
RESULT
        SELECT * FROM lines JOIN g ON "StockCode" = code JOIN f ON "StockCode" = code2"""),
    "w09_seasonal_index": Query("InvoiceMonth:i, SeasonalIndex:9", season, "SELECT * FROM season"),
    "w10_inventory_risk": Query("StockCode:s, InventoryRiskScore:7",
        lambda s, d: ft.inventory_risk(volatility(s, d)), "SELECT * FROM sku_risk"),
    "w11_churn_flag": Query("Customer ID:s, ChurnFlag:i",
        lambda s, d: customers(s, d).withColumn("ChurnFlag", ft.churn_flag(F.col("DaysSinceLastPurchase"))), """
        SELECT "Customer ID", CASE WHEN "DaysSinceLastPurchase" > 90 THEN 1 ELSE 0 END AS "ChurnFlag" FROM cust"""),
    "j01_join_customers": Query(LINE + ", CustomerLifetimeValue:2, AvgOrderValue:4, PurchaseFrequency:9, "
        "DaysSinceLastPurchase:i", join_customers,
        'SELECT * FROM lines l LEFT JOIN (SELECT * RENAME ("Customer ID" AS cid) FROM cust) c ON l."Customer ID" = c.cid'),
    "j02_join_daily": Query(LINE + ", sales_date:d, Rolling7DaySales:2, Lag_7_Day_Sales:2", join_daily, """
        SELECT * FROM lines l LEFT JOIN (SELECT * RENAME (sales_date AS day) FROM daily_features) d
        ON l.sales_date = d.day"""),
    "j03_join_sku_default": Query(LINE + ", InventoryRiskScore:7", join_risk, """
        SELECT l.*, coalesce("InventoryRiskScore", 0.5) AS "InventoryRiskScore" FROM lines l LEFT JOIN
          (SELECT "StockCode" AS code, "InventoryRiskScore" FROM sku_risk
           WHERE "InventoryRiskScore" > CAST(0.2 AS DOUBLE)) r ON l."StockCode" = r.code"""),
    "j04_lookup_map": Query("Customer ID:s, code:s", lookup_map, """
        SELECT "Customer ID", CASE "CustomerSegment" WHEN 'Champions' THEN 'A' WHEN 'Loyal' THEN 'B'
          WHEN 'Potential' THEN 'C' END AS code FROM segments"""),
    "j05_scalar_broadcast": Query(LINE + ", age:i, ratio:9", scalar_broadcast, f"""
        SELECT *, {days('(SELECT snapshot FROM snap)', '"InvoiceDate"')} AS age,
          "TotalAmount" / (SELECT {money('"TotalAmount"')} / count(*) FROM lines) AS ratio FROM lines"""),
    "j07_membership_split": Query("Country:s, n:i, part:s", membership, """
        SELECT "Country", count(*) AS n, CASE WHEN day(sales_date) > 25 THEN 'in' ELSE 'out' END AS part
        FROM lines GROUP BY ALL"""),
    "x02_half_split": Query("sales_date:d, n:i, half:s", half_split, f"""
        SELECT sales_date, count(*) AS n, half FROM (
          SELECT sales_date, CASE WHEN row_number() OVER (ORDER BY {ORDER}) <= count(*) OVER () // 2
            THEN 'reference' ELSE 'current' END AS half FROM features) GROUP BY ALL"""),
    "feature_table": Query(FEATURES, features, "SELECT * FROM features"),
}
