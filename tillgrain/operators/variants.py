"""The dashboard's own feature definitions, used where no feature store exists.

They differ from the feature table on purpose: calendar-day lifetimes, rolling sums
on a gap-filled calendar, dense ranks and quantile rules.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import (
    TOTAL, elapsed_days, exact_avg, exact_sum)
from ..session import materialize
from .calendar import fill_calendar
from .features import first_per_key
from .joins import attach
from .ranking import SMALL, exact_quantiles, running_totals



def customer_features(lines: DataFrame) -> DataFrame:
    """Value, mean line amount, invoices per lifetime day and days since last purchase."""
    reference = lines.agg(F.date_add(F.to_date(F.max("InvoiceDate")), 1)).scalar()
    per = lines.groupBy("Customer ID").agg(
        exact_sum("TotalAmount").alias("CustomerLifetimeValue"),
        exact_avg("TotalAmount").alias("AvgOrderValue"),
        F.countDistinct("Invoice").alias("invoices"),
        F.min("InvoiceDate").alias("first_purchase"), F.max("InvoiceDate").alias("last_purchase"),
        F.count("*").alias("n_lines"))
    lifetime = F.greatest(elapsed_days(F.col("last_purchase"), F.col("first_purchase")) + 1, F.lit(1))
    return per.withColumns({
        "PurchaseFrequency": F.col("invoices") / lifetime,
        "DaysSinceLastPurchase": F.datediff(reference, F.to_date("last_purchase")),
    }).drop("invoices", "first_purchase", "last_purchase")


def daily_features(daily: DataFrame) -> DataFrame:
    """Rolling sums and zero-filled lags on the gap-filled daily series."""
    filled = fill_calendar(daily, "sales_date", "daily_sales")
    w = W.orderBy("sales_date")   # one row per calendar day

    def rolling_sum(n):
        return F.sum(F.col("daily_sales").cast(TOTAL)).over(w.rowsBetween(1 - n, 0)).cast("double")

    return filled.withColumns({
        "Rolling7DaySales": rolling_sum(7), "Rolling30DaySales": rolling_sum(30),
        "Lag_1_Day_Sales": F.lag("daily_sales", 1, 0.0).over(w),
        "Lag_7_Day_Sales": F.lag("daily_sales", 7, 0.0).over(w)})


def country_dense_rank(lines: DataFrame, limit: int = SMALL) -> DataFrame:
    """Dense rank of the countries by revenue, best first."""
    sales = materialize(lines.groupBy("Country").agg(
        exact_sum("TotalAmount").alias("sales"), F.count("*").alias("n_lines")), "countries")
    values = sales.groupBy("sales").agg(F.lit(1).cast("long").alias("one"))
    total = values.agg(F.count("*")).scalar()
    ranked = running_totals(values, "sales", ["one"], limit=limit).select(
        "sales", (total - F.col("one_before")).cast("int").alias("CountrySalesRank"))
    return sales.join(ranked, "sales")


def segment_rules(customers: DataFrame) -> tuple[DataFrame, float]:
    """Quantile-rule segment per customer, and the recency from which one is inactive."""
    found = exact_quantiles(customers, {
        "CustomerLifetimeValue": [0.70, 0.35], "DaysSinceLastPurchase": [0.35, 0.75],
        "PurchaseFrequency": [0.65]})
    high, low = found["CustomerLifetimeValue"]
    recent, inactive = found["DaysSinceLastPurchase"]
    frequent = found["PurchaseFrequency"][0]
    value, recency, rate = (F.col("CustomerLifetimeValue"), F.col("DaysSinceLastPurchase"),
                            F.col("PurchaseFrequency"))
    segment = (F.when((value >= high) & (recency <= recent), "Champions")
               .when(rate >= frequent, "Loyal").when(value >= high, "High Value")
               .when(recency >= inactive, "At Risk").when(value <= low, "New")
               .otherwise("Regular"))
    flagged = customers.withColumn("CustomerSegment", segment).withColumn(
        "ChurnFlag", (recency >= inactive).cast("int"))
    return flagged, inactive


def seasonal_index(lines: DataFrame) -> DataFrame:
    """Revenue of each month of the year over the mean of the month totals."""
    monthly = lines.groupBy("InvoiceMonth").agg(exact_sum("TotalAmount").alias("revenue"))
    return monthly.select("InvoiceMonth", (
        F.col("revenue") / monthly.agg(exact_avg("revenue", TOTAL)).scalar()).alias("SeasonalIndex"))


def sku_spread_risk(lines: DataFrame) -> DataFrame:
    """Min-max scaled spread of the line quantities per product."""
    spread = materialize(lines.groupBy("StockCode").agg(
        F.coalesce(F.stddev_samp("Quantity"), F.lit(0.0)).alias("spread"),
        F.count("*").alias("n_lines")), "sku-spread")
    low = spread.agg(F.min("spread")).scalar()
    high = spread.agg(F.max("spread")).scalar()
    risk = (F.col("spread") - low) / (high - low + 1e-9)
    return spread.select("StockCode", "n_lines",
                         F.least(F.greatest(risk, F.lit(0.0)), F.lit(1.0)).alias("InventoryRiskScore"))


def dashboard_features(lines: DataFrame) -> DataFrame:
    """All variant columns on the lines (`lines` stored, with the line features)."""
    customers = materialize(customer_features(lines), "variant-customers")
    segmented, _ = segment_rules(customers)
    daily = lines.groupBy("sales_date").agg(exact_sum("TotalAmount").alias("daily_sales"))
    out = lines.join(materialize(daily_features(daily), "variant-daily"), "sales_date", "left")
    out = out.join(F.broadcast(seasonal_index(lines)), "InvoiceMonth", "left")   # twelve rows
    ranks = country_dense_rank(lines).select("Country", "n_lines", "CountrySalesRank")
    out = attach(out, materialize(ranks, "variant-countries"), "Country", "n_lines")
    out = attach(out, materialize(segmented, "variant-segments"), "Customer ID", "n_lines")
    return attach(out, materialize(sku_spread_risk(lines), "variant-risk"), "StockCode", "n_lines")


def reorder_by_rate(lines: DataFrame, category: str | Column = "ProductCategory") -> DataFrame:
    """Reorder table from units per calendar day; status by quantiles of the reorder point."""
    span = lines.agg(F.greatest(elapsed_days(F.max("InvoiceDate"), F.min("InvoiceDate")),
                                F.lit(1))).scalar()
    per = lines.groupBy("StockCode", F.col(category).alias("category")).agg(
        exact_sum("Quantity").alias("total_demand"),
        F.coalesce(F.stddev_samp("Quantity"), F.lit(0.0)).alias("demand_std"))
    per = per.withColumn("avg_daily_demand", F.col("total_demand") / span)
    per = per.withColumn("reorder_point", F.round(
        F.col("avg_daily_demand") * 7 + 1.65 * F.col("demand_std") * math.sqrt(7), 9))
    per = materialize(per.withColumn("recommended_order_qty", F.ceil(
        F.col("avg_daily_demand") * 30 + F.col("reorder_point")).cast("double")), "reorder")
    high, low = exact_quantiles(per, {"reorder_point": [0.75, 0.35]})["reorder_point"]
    point = F.col("reorder_point")
    return per.withColumn("stock_status", F.when(point >= high, "Critical - Reorder Now")
                          .when(point <= low, "Healthy").otherwise("Monitor"))


def segment_codes(features: DataFrame) -> DataFrame:
    """Code per segment label, numbered by where customers first show it.

    Customers stand in the order of their id, as in a grouped table.
    """
    first = first_per_key(features, "Customer ID", ["CustomerSegment"]).withColumnRenamed(
        "CustomerSegment", "SegmentLabel")
    labels = first.groupBy("SegmentLabel").agg(F.min("Customer ID").alias("first_customer"))
    # One row per label.
    return labels.withColumn("code", F.row_number().over(W.orderBy("first_customer")) - 1)
