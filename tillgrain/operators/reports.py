"""Reporting aggregates over the feature table.

Every report is one grouped aggregate with map-side combining; distinct counts are
exact.  `features` is the stored feature table unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import MONEY, available, exact_avg, exact_sum
from ..schema import CORRELATION_FEATURES
from ..session import materialize
from .features import first_per_key
from .ranking import exact_quantiles


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Exact number of distinct values as one row; reads a single column."""
    return df.agg(F.countDistinct(F.col(f"`{column}`")).alias("n"))


def customer_churn_rate(features: DataFrame) -> Column:
    """Mean churn flag over customers, as a scalar subquery."""
    return first_per_key(features, "Customer ID", ["ChurnFlag"]).agg(F.avg("ChurnFlag")).scalar()


# ---- key figures ---------------------------------------------------------------

def summary_kpis(features: DataFrame) -> DataFrame:
    """Size, span, revenue, mean invoice value and churn rate in one row.

    Distinct counts run as separate one-column scans: counting several columns in
    one aggregate would copy every line once per column.
    """
    invoices = features.groupBy("Invoice").agg(exact_sum("TotalAmount").alias("value"))
    return features.agg(
        F.count("*").alias("n_rows"),
        F.min("InvoiceDate").alias("first_date"), F.max("InvoiceDate").alias("last_date"),
        exact_sum("TotalAmount").alias("total_revenue"),
    ).select(
        "n_rows", "first_date", "last_date", "total_revenue",
        distinct_count(features, "Customer ID").scalar().alias("n_customers"),
        distinct_count(features, "StockCode").scalar().alias("n_products"),
        distinct_count(features, "Country").scalar().alias("n_countries"),
        invoices.agg(exact_avg("value")).scalar().alias("avg_order_value"),
        customer_churn_rate(features).alias("churn_rate"))


def executive_kpis(features: DataFrame) -> DataFrame:
    return features.agg(
        exact_sum("TotalAmount").alias("revenue"), F.count("*").alias("transactions"),
    ).select("revenue", "transactions",
             distinct_count(features, "Customer ID").scalar().alias("customers"),
             customer_churn_rate(features).alias("churn_rate"))


def bi_measures(features: DataFrame, metrics: DataFrame) -> DataFrame:
    """The report measures; `metrics` holds (Model, Metric, Value) rows."""
    looked_up = metrics.agg(
        F.max(F.when(F.col("Metric") == "MAPE", F.col("Value"))).alias("forecast_mape"),
        F.max(F.when(F.col("Metric") == "ROC-AUC", F.col("Value"))).alias("churn_auc"))
    totals = features.agg(
        exact_sum("TotalAmount").alias("total_sales"), exact_sum("Quantity").alias("total_quantity"),
        F.countDistinct("Invoice").alias("orders"))
    return totals.select(
        "*", distinct_count(features, "Customer ID").scalar().alias("customers"),
        F.try_divide("total_sales", "orders").alias("aov"),
        customer_churn_rate(features).alias("churn_rate"),
        looked_up.select("forecast_mape").scalar().alias("forecast_mape"),
        looked_up.select("churn_auc").scalar().alias("churn_auc"))


# ---- sales by dimension -----------------------------------------------------------

def sales_by(features: DataFrame, column: str) -> DataFrame:
    """Revenue by one column: segment, hour, month, category."""
    return features.groupBy(F.col(f"`{column}`")).agg(exact_sum("TotalAmount").alias("TotalAmount"))


def visits(features: DataFrame) -> DataFrame:
    """Sales and units per day, invoice and customer: what exact counts of longer periods add up from.

    Lines are added up where they are before anything is shuffled, so the table has a row per
    invoice, not per line.
    """
    return features.groupBy(F.to_date("InvoiceDate").alias("SalesDate"), "Invoice", "Customer ID").agg(
        F.sum(F.col("TotalAmount").cast(MONEY)).alias("amount"), F.sum(F.col("Quantity").cast(MONEY)).alias("units"))


def period_report(known: DataFrame, period: Column, name: str) -> DataFrame:
    """Sales, units, orders, customers and order value per period, from stored `visits`.

    Orders and customers are counted on their own, each from its distinct pairs: a row is
    never copied for every count.
    """
    rows = known.withColumn(name, period)
    totals = rows.groupBy(name).agg(F.sum("amount").cast("double").alias("TotalSales"),
                                    F.sum("units").cast("double").alias("TotalQuantity"))
    for column, count in (("Invoice", "Orders"), ("Customer ID", "Customers")):
        # One row per period on either side; null periods and null keys as in a plain count.
        found = rows.select(F.col(name).alias("_period"), F.col(f"`{column}`").alias("_key")).distinct().groupBy(
            "_period").agg(F.count("_key").alias(count))
        totals = totals.join(found, F.col(name).eqNullSafe(F.col("_period"))).drop("_period")
    return totals.withColumn("AOV", F.col("TotalSales") / F.greatest("Orders", F.lit(1)))


def daily_report(features: DataFrame) -> DataFrame:
    """Sales, units, orders, customers and order value per day."""
    return period_report(materialize(visits(features), "visits"), F.col("SalesDate"), "SalesDate")


def monthly_report(known: DataFrame) -> DataFrame:
    """The same per month, from the stored `visits` of its days."""
    return period_report(known, F.date_format("SalesDate", "yyyy-MM"), "SalesMonth")


def country_report(features: DataFrame) -> DataFrame:
    return features.groupBy("Country").agg(
        exact_sum("TotalAmount").alias("TotalSales"),
        F.countDistinct("Customer ID").alias("Customers")).orderBy(F.desc("TotalSales"), "Country")


def category_report(features: DataFrame) -> DataFrame:
    return features.groupBy("ProductCategory").agg(
        exact_sum("TotalAmount").alias("TotalSales"), exact_sum("Quantity").alias("Quantity"),
        F.countDistinct("StockCode").alias("SKUs")).orderBy(F.desc("TotalSales"), "ProductCategory")


def customer_report(features: DataFrame) -> DataFrame:
    """One row per customer with its first feature values, totals and snapshot date."""
    first = ["CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency",
             "DaysSinceLastPurchase", "Country", "CustomerSegment", "ChurnFlag"]
    totals = features.groupBy(F.col("Customer ID").alias("_customer")).agg(
        F.countDistinct("Invoice").alias("Orders"), exact_sum("Quantity").alias("Quantity"),
        exact_sum("TotalAmount").alias("Revenue"), F.max("InvoiceDate").alias("LastPurchase"))
    # Apart from the first values, whose order would have every line sorted.
    return first_per_key(features, "Customer ID", first).join(
        totals, F.col("Customer ID").eqNullSafe(F.col("_customer"))).drop("_customer").withColumn("SnapshotDate", features.agg(F.max("InvoiceDate")).scalar())


def customers_per_segment(features: DataFrame) -> DataFrame:
    return features.groupBy("CustomerSegment").agg(F.countDistinct("Customer ID").alias("customers"))


def daily_vs_rolling(features: DataFrame) -> DataFrame:
    return features.groupBy(F.to_date("InvoiceDate").alias("InvoiceDate")).agg(
        exact_sum("TotalAmount").alias("actual"), exact_avg("Rolling7DaySales").alias("rolling_7"))


# ---- distributions ----------------------------------------------------------------

def correlation_matrix(features: DataFrame, wanted: list[str] = CORRELATION_FEATURES) -> DataFrame:
    """Pearson r of every pair of the available columns, as (x, y, r) rows.

    All pairs come from one aggregate; a pair skips rows where either side is null.
    """
    names = available(features, wanted)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    wide = features.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [F.col(f"`{a}|{b}`") for a, b in pairs], "pair", "r").select(
        F.split("pair", r"\|")[0].alias("x"), F.split("pair", r"\|")[1].alias("y"), "r")
    mirrored = long.filter("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "r")
    return long.unionAll(mirrored)


def histogram(df: DataFrame, column: str, bins: int = 50, by: list[str] | None = None) -> DataFrame:
    """Counts in `bins` equal-width bins between the smallest and largest value.

    The last bin includes the maximum; empty bins are kept when `by` is not given.
    """
    keys = by or []
    edges = df.agg(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    place = F.floor(F.try_divide(F.col(column) - low, high - low) * bins)
    counted = (df.filter(F.col(column).isNotNull())
               .groupBy(*keys, F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).alias("bin"))
               .agg(F.count("*").alias("n")))
    if not keys:
        every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
        counted = every.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    width = (high - low) / bins
    return counted.withColumn("bin_start", low + F.col("bin") * width)


def box_summary(df: DataFrame, columns: list[str], factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count of each column; a column without values has nulls and 0."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    rows = []
    for c in columns:
        q1, median, q3 = (F.lit(q).cast("double") for q in quartiles[c])
        inside = F.col(c).between(q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        rows.append(F.struct(
            F.lit(c).alias("column"), q1.alias("q1"), median.alias("median"), q3.alias("q3"), F.min(F.when(inside, F.col(c))).alias("whisker_low"),
            F.max(F.when(inside, F.col(c))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers")))
    return df.agg(*[r.alias(c) for r, c in zip(rows, columns)]).select(
        F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")


# ---- lists --------------------------------------------------------------------------

def top_by(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The n rows with the largest measure; ties by key (top-k, no full sort)."""
    return df.orderBy(F.desc(measure), F.col(f"`{key}`")).limit(n)


def top_countries(features: DataFrame, n: int = 15) -> DataFrame:
    return top_by(sales_by(features, "Country"), "TotalAmount", "Country", n)


def at_risk_customers(features: DataFrame, n: int = 20) -> DataFrame:
    """Customers with the longest time since their last purchase."""
    columns = ["CustomerLifetimeValue", "DaysSinceLastPurchase", "ChurnFlag"]
    return top_by(first_per_key(features, "Customer ID", columns),
                  "DaysSinceLastPurchase", "Customer ID", n)


def stock_list(reorder: DataFrame, statuses: list[str] | None = None, n: int = 50) -> DataFrame:
    """First products of the reorder table with one of the given statuses."""
    rows = reorder.filter(F.col("stock_status").isin(statuses)) if statuses else reorder
    return rows.select("StockCode", "category", "recommended_order_qty", "reorder_point",
                       "stock_status").orderBy("StockCode").limit(n)


def inventory_kpis(reorder: DataFrame) -> DataFrame:
    return reorder.agg(
        F.count("*").alias("skus"),
        F.count_if(F.col("stock_status").startswith("Critical")).alias("critical"),
        exact_avg("recommended_order_qty").alias("avg_reorder_qty"))


def model_metric_table(metrics: DataFrame, target_mape: float = 12.0,
                       target_auc: float = 0.88) -> DataFrame:
    """(Model, Metric, Value) rows for reports, with the targets of each model present.

    `metrics` holds (model, metric, value); unknown metrics are left out.
    """
    # Report names of the stored metrics.
    names = [("forecasting", "mape", "Demand Forecasting", "MAPE"),
             ("forecasting", "mae", "Demand Forecasting", "MAE"),
             ("churn", "roc_auc", "Churn Prediction", "ROC-AUC"),
             ("churn", "precision", "Churn Prediction", "Precision"),
             ("churn", "precision_at_top_20pct", "Churn Prediction", "Precision@Top20%")]
    targets = [("forecasting", "Demand Forecasting", "Target MAPE", target_mape),
               ("churn", "Churn Prediction", "Target ROC-AUC", target_auc)]
    model, metric = F.col("model"), F.col("metric")
    shown, title = F.lit(None).cast("string"), F.lit(None).cast("string")
    for m, k, nice_model, nice_metric in names:
        hit = (model == m) & (metric == k)
        shown = F.when(hit, nice_metric).otherwise(shown)
        title = F.when(hit, nice_model).otherwise(title)
    values = metrics.select(title.alias("Model"), shown.alias("Metric"),
                            F.col("value").alias("Value")).filter("Metric is not null")
    present = metrics.select("model").distinct()
    goals = None
    for m, nice_model, nice_metric, goal in targets:
        one = present.filter(model == m).select(
            F.lit(nice_model).alias("Model"), F.lit(nice_metric).alias("Metric"),
            F.lit(goal).alias("Value"))
        goals = one if goals is None else goals.unionAll(one)
    return values.unionAll(goals)


def quality_gates(metrics: DataFrame, target_mape: float = 12.0, target_auc: float = 0.88,
                  auc_slack: float = 0.95) -> DataFrame:
    """Distance of each model to its target, and whether it raises no warning."""
    value = F.col("value")
    mape = metrics.filter("model = 'forecasting' and metric = 'mape'").select(
        "model", "metric", "value", (value - target_mape).alias("distance"),
        (value <= target_mape).alias("passed"))
    auc = metrics.filter("model = 'churn' and metric = 'roc_auc'").select(
        "model", "metric", "value", (value - target_auc).alias("distance"),
        (value >= target_auc * auc_slack).alias("passed"))
    return mape.unionAll(auc)
