"""The transaction contract: columns, aliases, row order and defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# The eight contract columns, in contract order.
REQUIRED = [
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
]

# Accepted spellings of each contract column.
ALIASES = {
    "Invoice": ["InvoiceNo", "Invoice No", "InvoiceNumber", "Invoice Number",
                "OrderNo", "Order No", "OrderID", "Order ID"],
    "StockCode": ["Stock Code", "SKU", "Sku", "ProductCode", "Product Code"],
    "Description": ["Product Description", "ProductName", "Product Name", "Item Description"],
    "Quantity": ["Qty", "Units", "UnitQuantity", "Unit Quantity"],
    "InvoiceDate": ["Invoice Date", "InvoiceDatetime", "OrderDate", "Order Date", "Date"],
    "Price": ["UnitPrice", "Unit Price", "UnitCost", "Unit Cost", "PriceEach"],
    "Customer ID": ["CustomerID", "Customer Id", "Customer_ID", "CustomerNo",
                    "Customer No", "ClientID"],
    "Country": ["Market", "Region", "Nation"],
}

CRITICAL = ["Invoice", "StockCode", "Quantity", "Price", "InvoiceDate"]

# Two lines with the same values here are one line (applied after capping).
LINE_KEY = ["Invoice", "StockCode", "Quantity", "Price", "InvoiceDate", "Customer ID"]

# Spark rows have no position, so "first" always means first in this order.
ROW_ORDER = ["InvoiceDate", "Invoice", "StockCode", "Quantity", "Price",
             "Customer ID", "Description", "Country"]

ENGINEERED_REQUIRED = ["TotalAmount", "CustomerLifetimeValue", "Rolling7DaySales",
                       "CustomerSegment", "ChurnFlag"]

CHURN_FEATURES = ["CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency",
                  "DaysSinceLastPurchase", "Rolling7DaySales", "Rolling30DaySales",
                  "SeasonalIndex", "InventoryRiskScore"]

DRIFT_FEATURES = ["Quantity", "Price", "TotalAmount", "CustomerLifetimeValue",
                  "PurchaseFrequency", "Rolling7DaySales"]

CORRELATION_FEATURES = ["Quantity", "Price", "TotalAmount", "CustomerLifetimeValue",
                        "PurchaseFrequency", "Rolling7DaySales", "SeasonalIndex",
                        "InventoryRiskScore"]

BI_TRANSACTION_COLUMNS = REQUIRED + ["TotalAmount", "InvoiceMonth", "InvoiceDay", "InvoiceHour",
                                     "WeekendFlag", "ProductCategory", "CustomerSegment",
                                     "ChurnFlag", "InventoryRiskScore"]


@dataclass(frozen=True)
class Settings:
    """Defaults of every tunable used by the operators."""

    price_cap: float = 0.995
    quantity_cap: float = 0.99
    churn_days: int = 90
    product_categories: int = 8
    kmeans_clusters: int = 6
    kmeans_starts: int = 10
    seed: int = 42
    dbscan_eps: float = 0.8
    dbscan_min_points: int = 5
    forecast_horizon: int = 30
    train_share: float = 0.85
    target_mape: float = 12.0
    target_auc: float = 0.88
    churn_trees: int = 400
    churn_depth: int = 5
    churn_rate: float = 0.03
    churn_positive_weight: float = 2.5
    churn_test_share: float = 0.2
    search_trials: int = 30
    boost_trees: int = 300
    boost_depth: int = 6
    boost_rate: float = 0.05
    sequence_length: int = 14
    sequence_hidden: int = 16
    sequence_epochs: int = 25
    sequence_rate: float = 0.05
    safety_z: float = 1.65
    lead_time_days: int = 7
    reorder_multiplier: float = 1.2
    drift_threshold: float = 0.15
    timestamp_formats: tuple[str, ...] = field(default=(
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss",
        "M/d/yyyy H:mm:ss",
        "M/d/yyyy H:mm",
        "yyyy-MM-dd",
        "M/d/yyyy",
    ))


DEFAULTS = Settings()
