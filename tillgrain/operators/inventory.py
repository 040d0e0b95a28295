"""Reorder recommendations per product."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import clip, exact_avg, exact_sum, half_even, stock_status
from ..schema import DEFAULTS, Settings
from .features import first_per_key

ORDER_COST = 50.0
HOLDING_SHARE = 0.2


def sku_demand(features: DataFrame) -> DataFrame:
    """Units per line (mean, spread), total units, mean risk and category per product.

    `avg_daily_demand` is the mean number of units per line; the name is kept.
    A product with a single line takes 30 % of its mean as spread.
    """
    demand = features.groupBy(F.col("StockCode").alias("_sku")).agg(
        exact_avg("Quantity").alias("avg_daily_demand"),
        F.stddev_samp("Quantity").alias("demand_std"),
        exact_sum("Quantity").alias("current_velocity"),
        F.avg("InventoryRiskScore").alias("risk_score"))
    # Apart from the first category, whose order would have every line sorted.
    first = first_per_key(features, "StockCode", ["ProductCategory"]).withColumnRenamed("ProductCategory", "category")
    demand = first.join(demand, F.col("StockCode").eqNullSafe(F.col("_sku"))).select(
        "StockCode", "avg_daily_demand", "demand_std", "current_velocity", "risk_score", "category")
    return demand.withColumn("demand_std", F.coalesce("demand_std", F.col("avg_daily_demand") * 0.3))


def reorder_table(features: DataFrame, forecast: DataFrame | None = None,
                  settings: Settings = DEFAULTS) -> DataFrame:
    """Safety stock, reorder point, order quantity and status per product.

    With a forecast, every product gets the mean forecast divided by the number of
    products as its demand (sales per product, used as units as in the reports).
    """
    sku = sku_demand(features)
    if forecast is None:
        demand = F.col("avg_daily_demand")
    else:
        products = features.agg(F.countDistinct("StockCode")).scalar()
        demand = forecast.agg(F.avg("yhat")).scalar() / F.greatest(products, F.lit(1))
    lead = settings.lead_time_days
    sku = sku.withColumn("forecast_demand", demand)
    sku = sku.withColumn("safety_stock", settings.safety_z * F.col("demand_std") * math.sqrt(lead))
    sku = sku.withColumn("reorder_point", F.col("forecast_demand") * lead + F.col("safety_stock"))
    holding = clip(F.col("avg_daily_demand"), lower=0.1) * HOLDING_SHARE
    sku = sku.withColumn("economic_order_qty",
                         F.sqrt(2 * F.col("current_velocity") * ORDER_COST / holding))
    quantity = (F.col("reorder_point") + F.col("economic_order_qty")) * settings.reorder_multiplier
    return (sku.withColumn("recommended_order_qty", half_even(quantity))
            .withColumn("stock_status", stock_status(F.col("risk_score"))))
