"""The engineered feature table and the aggregates it is made of.

The transaction table is read three times, always with pruned columns: once into
a (day, country) cube, once per customer and once per product.  Everything else
(daily series, months, countries, quartiles, ranks) is derived from these three
stored aggregates and joined back onto the lines.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.scalars import (
    MONEY, TOTAL, clip, elapsed_days, exact_avg, exact_sum, product_category, with_line_features)
from ..schema import DEFAULTS, ROW_ORDER, Settings
from ..session import materialize
from .joins import attach, attach_whole, broadcast_rows, sieved
from .ranking import SMALL, select_ranks_by, with_average_rank

# Ranked ratios are rounded here, so that equal ratios tie on any machine.
RATIO_DIGITS = 9


# ---- customers -------------------------------------------------------------

def customer_table(lines: DataFrame) -> DataFrame:
    """Per customer: value, orders, first and last purchase, and derived rates."""
    spend = lines.groupBy("Customer ID").agg(
        exact_sum("TotalAmount").alias("CustomerLifetimeValue"),
        F.countDistinct("Invoice").alias("order_count"),
        F.max("InvoiceDate").alias("last_purchase"),
        F.min("InvoiceDate").alias("first_purchase"),
        F.count("*").alias("n_lines"))
    return with_customer_rates(spend, lines.agg(F.max("InvoiceDate")).scalar())


def with_customer_rates(spend: DataFrame, snapshot: Column) -> DataFrame:
    span = F.greatest(elapsed_days(F.col("last_purchase"), F.col("first_purchase")), F.lit(1))
    return spend.withColumns({
        "AvgOrderValue": F.col("CustomerLifetimeValue") / F.greatest("order_count", F.lit(1)),
        "PurchaseFrequency": F.col("order_count") / span,
        "DaysSinceLastPurchase": elapsed_days(snapshot, F.col("last_purchase")),
    })


def rfm_matrix(lines: DataFrame, log_scale: bool = True) -> DataFrame:
    """Recency in days, number of invoices and spend per customer (log1p by default)."""
    customers = customer_table(lines).select(
        "Customer ID",
        F.col("DaysSinceLastPurchase").cast("double").alias("recency"),
        F.col("order_count").cast("double").alias("frequency"),
        F.col("CustomerLifetimeValue").alias("monetary"))
    if not log_scale:
        return customers
    return customers.withColumns({c: F.log1p(c) for c in ("recency", "frequency", "monetary")})


# ---- the (day, country) cube -----------------------------------------------

def sales_cube(lines: DataFrame) -> DataFrame:
    """Exact amount and line count per day and country: size of a calendar."""
    return lines.groupBy("sales_date", "Country").agg(
        F.sum(F.col("TotalAmount").cast(MONEY)).alias("amount"), F.count("*").alias("n_lines"))


def daily_sales(lines: DataFrame) -> DataFrame:
    """Sales per calendar day; days without sales are absent."""
    return lines.groupBy("sales_date").agg(exact_sum("TotalAmount").alias("daily_sales"))


def rolling_mean(value: str, days: int, series: list[str], order: str) -> Column:
    """Mean of the last `days` rows of a series (fewer at its start)."""
    window = W.partitionBy(*series).orderBy(order).rowsBetween(1 - days, 0)
    exact = F.col(value).cast(TOTAL)
    return F.sum(exact).over(window).cast("double") / F.count(exact).over(window)


def filled_lag(value: str, days: int, series: list[str], order: str) -> Column:
    """Value `days` rows earlier; the mean of the series where there is none."""
    whole = W.partitionBy(*series)
    exact = F.col(value).cast(TOTAL)
    mean = F.sum(exact).over(whole).cast("double") / F.count(exact).over(whole)
    return F.coalesce(F.lag(value, days).over(W.partitionBy(*series).orderBy(order)), mean)


def with_daily_features(daily: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Rolling means and lags over the rows of a daily table (calendar-sized)."""
    keys = series or []
    return daily.withColumns({
        "Rolling7DaySales": rolling_mean("daily_sales", 7, keys, "sales_date"),
        "Rolling30DaySales": rolling_mean("daily_sales", 30, keys, "sales_date"),
        "Lag_1_Day_Sales": filled_lag("daily_sales", 1, keys, "sales_date"),
        "Lag_7_Day_Sales": filled_lag("daily_sales", 7, keys, "sales_date"),
    })


def country_ranks(cube: DataFrame, limit: int = SMALL) -> DataFrame:
    """Average rank of each country by sales, best first."""
    sales = materialize(cube.groupBy("Country").agg(
        F.sum("amount").cast("double").alias("sales"), F.sum("n_lines").alias("n_lines")), "countries")
    return with_average_rank(sales, "sales", "CountrySalesRank", descending=True, limit=limit)


def seasonal_index(cube: DataFrame) -> DataFrame:
    """Mean line amount of each month of the year over the global mean."""
    total = cube.agg((F.sum("amount").cast("double") / F.sum("n_lines")).alias("m")).scalar()
    monthly = cube.groupBy(F.month("sales_date").alias("InvoiceMonth")).agg(
        (F.sum("amount").cast("double") / F.sum("n_lines")).alias("mean"))
    return monthly.select("InvoiceMonth",
                          (F.col("mean") / F.greatest(total, F.lit(1e-6))).alias("SeasonalIndex"))


# ---- products ----------------------------------------------------------------

def sku_volatility(lines: DataFrame) -> DataFrame:
    """Spread, mean and variation of the line amounts per product, and its units."""
    stats = lines.groupBy("StockCode").agg(
        F.coalesce(F.stddev_samp("TotalAmount"), F.lit(0.0)).alias("sales_std"),
        exact_avg("TotalAmount").alias("sales_mean"),
        exact_sum("Quantity").alias("qty_sum"),
        F.count("*").alias("n_lines"))
    return stats.withColumn(
        "cv", F.round(F.col("sales_std") / clip(F.col("sales_mean"), lower=1e-6), RATIO_DIGITS))


def inventory_risk(volatility: DataFrame, limit: int = SMALL) -> DataFrame:
    """Risk score per product from the percent ranks of variation and units.

    `volatility` must be stored: it is ranked twice.
    """
    ranked = with_average_rank(volatility, "cv", "cv_rank", percent=True, limit=limit)
    ranked = with_average_rank(ranked, "qty_sum", "qty_rank", percent=True, limit=limit)
    score = F.col("cv_rank") * 0.6 + (1 - F.col("qty_rank")) * 0.4
    return ranked.select("StockCode", "n_lines",
                         clip(score, 0.0, 1.0).alias("InventoryRiskScore"))


# ---- quartiles and segments -----------------------------------------------

def quartile_of_rank(rank: Column, n: Column | int) -> Column:
    """Quartile bin 1..4 of the ranks 1..n: bin edges at equal rank distances."""
    n = F.lit(n) if isinstance(n, int) else n
    steps = F.greatest(n - 1, F.lit(1))
    return F.greatest(F.lit(1), F.ceil(4 * (rank - 1) / steps)).cast("int")


def _boundary_ranks(n: int) -> list[int]:
    """Last rank of quartiles 1, 2 and 3."""
    return [1 + (j * (n - 1)) // 4 for j in (1, 2, 3)]


def first_line_quartiles(lines: DataFrame, customers: DataFrame,
                         measures: dict[str, str], limit: int = SMALL) -> DataFrame:
    """Quartile of each customer's first line among all lines, per measure.

    All lines are ranked by a measure of their customer, ties by row order, and cut
    into quartiles; a customer takes the quartile of its first line.  Only the three
    boundary lines of a measure decide this, so they are selected and nothing is
    ranked: a customer is above a boundary when its value is, or when it shares the
    boundary value and its first line comes after the boundary line.

    `lines` and `customers` must be stored tables; `measures` maps the column of
    `customers` to the name of the added quartile column.
    """
    n = customers.agg(F.sum("n_lines").alias("n")).first()["n"] or 0
    ranks = _boundary_ranks(n) if n else []
    out = customers
    # Measures are compared as doubles; all of them hold whole numbers or amounts.
    long = customers.select("n_lines", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v"))
        for m in measures])).alias("_p")).select("n_lines", "_p.*")
    merged = long.groupBy("measure", "v").agg(F.sum("n_lines").alias("n_lines"))
    cuts = select_ranks_by(merged, "measure", ["v"], {m: ranks for m in measures}, "n_lines", limit)
    # Boundary values that several customers share and whose lines fall on both sides.
    open_ties = {}
    for measure, found in cuts.items():
        for j, (rank, cut) in enumerate(zip(ranks, found)):
            if rank < cut["before"] + cut["equal"]:
                open_ties[(measure, j)] = (cut["key"][0], rank - cut["before"])
    lines_at = {}
    if open_ties:
        lines_at = _boundary_lines(lines, customers, open_ties, limit)
        out = _with_first_keys(lines, out, sorted({k[0] for k in lines_at.values()}))
    first_key = F.struct(F.col("first_purchase").alias("k0"),
                         *[F.col("_first_key")[f"k{i}"].alias(f"k{i}")
                           for i in range(1, len(ROW_ORDER))]) if open_ties else None
    types = {f.name: f.dataType for f in lines.schema.fields}
    for measure, name in measures.items():
        quartile = F.lit(1)
        for j, cut in enumerate(cuts.get(measure, [])):
            value = F.lit(cut["key"][0])
            above = F.col(measure) > value
            if (measure, j) in lines_at:
                edge = lines_at[(measure, j)]
                edge_key = F.struct(*[F.lit(v).cast(types[c]).alias(f"k{i}")
                                      for i, (c, v) in enumerate(zip(ROW_ORDER, edge))])
                later = (F.col("first_purchase") > edge[0]) | (
                    (F.col("first_purchase") == edge[0]) & (first_key > edge_key))
                above = above | ((F.col(measure) == value) & later)
            quartile = quartile + above.cast("int")
        out = out.withColumn(name, quartile)
    return out.drop("_first_key")


def _boundary_lines(lines, customers, open_ties, limit) -> dict:
    """The row-order key of the line at each open boundary.

    One narrow join finds the lines of the tied customers; they are counted per
    timestamp, and only the lines of the boundary timestamp are compared in full.
    """
    tied = F.array_compact(F.array(*[
        F.when(F.col(measure) == value, F.lit(f"{measure}#{j}"))
        for (measure, j), (value, _) in open_ties.items()]))
    members = materialize(customers.select("Customer ID", "n_lines", tied.alias("ties"))
                          .filter(F.size("ties") > 0), "tied-customers")
    dated = attach(lines.select("Customer ID", "InvoiceDate"), members, "Customer ID", "n_lines")
    per_time = materialize(
        dated.filter(F.col("ties").isNotNull())
        .groupBy("ties", "InvoiceDate").agg(F.count("*").alias("n"))
        .select(F.explode("ties").alias("tie"), "InvoiceDate", "n")
        .groupBy("tie", "InvoiceDate").agg(F.sum("n").alias("n")), "tie-times")
    places = {f"{m}#{j}": position for (m, j), (_, position) in open_ties.items()}
    times = select_ranks_by(per_time, "tie", ["InvoiceDate"], {t: [p] for t, p in places.items()},
                            "n", limit)
    moments = {t: found[0]["key"][0] for t, found in times.items()}
    moment_of = F.create_map(*[F.lit(x) for pair in moments.items() for x in pair])
    here = (lines.filter(F.col("InvoiceDate").isin(sorted(set(moments.values()))))
            .join(members.select("Customer ID", F.explode("ties").alias("tie")), "Customer ID")
            .filter(F.col("InvoiceDate") == F.element_at(moment_of, F.col("tie"))))
    at = select_ranks_by(here, "tie", ROW_ORDER,
                         {t: [places[t] - times[t][0]["before"]] for t in places}, limit=limit)
    return {key: at[f"{key[0]}#{key[1]}"][0]["key"] for key in open_ties}


def _with_first_keys(lines, customers, moments) -> DataFrame:
    """Full key of a customer's first line, where it falls on a boundary timestamp."""
    keys = (lines.filter(F.col("InvoiceDate").isin(moments))
            .groupBy(F.col("Customer ID").alias("_c"), F.col("InvoiceDate").alias("_t"))
            .agg(F.min(F.struct(*[F.col(f"`{c}`").alias(f"k{i}")
                                  for i, c in enumerate(ROW_ORDER)])).alias("_first_key")))
    return (customers.join(keys, (F.col("Customer ID") == F.col("_c"))
                           & (F.col("first_purchase") == F.col("_t")), "left").drop("_c", "_t"))


def segment_label(score: Column) -> Column:
    return (F.when(score >= 10, "Champions").when(score >= 8, "Loyal")
            .when(score >= 6, "Potential").when(score >= 4, "At Risk")
            .otherwise("Hibernating"))


def customer_segments(lines: DataFrame, customers: DataFrame, limit: int = SMALL) -> DataFrame:
    """RFM score and segment per customer, from the quartiles of its first line."""
    scored = first_line_quartiles(lines, customers, {
        "DaysSinceLastPurchase": "_r", "order_count": "_f", "CustomerLifetimeValue": "_m"}, limit)
    return (scored.withColumn("rfm_score", (5 - F.col("_r")) + F.col("_f") + F.col("_m"))
            .withColumn("CustomerSegment", segment_label(F.col("rfm_score")))
            .drop("_r", "_f", "_m"))


def churn_flag(recency: Column, days: int = DEFAULTS.churn_days) -> Column:
    return (recency > days).cast("int")


# ---- the feature table -------------------------------------------------------

def engineer_features(clean: DataFrame, settings: Settings = DEFAULTS,
                      limit: int = SMALL) -> DataFrame:
    """All engineered columns on the cleaned lines.

    `clean` must be a stored table.  Its small aggregates are written to the shared
    folder; the returned frame is lazy and meant to be written to the feature store.
    """
    lines = with_line_features(clean)
    cube = materialize(sales_cube(lines), "cube")
    daily = materialize(with_daily_features(
        cube.groupBy("sales_date").agg(F.sum("amount").cast("double").alias("daily_sales"))), "daily")
    countries = country_ranks(cube, limit).select("Country", "n_lines", "CountrySalesRank")
    months = seasonal_index(cube)

    customers = materialize(customer_table(lines), "customers")
    segmented = customer_segments(lines, customers, limit).select(
        "Customer ID", "n_lines", "CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency",
        "DaysSinceLastPurchase", "CustomerSegment",
        churn_flag(F.col("DaysSinceLastPurchase"), settings.churn_days).alias("ChurnFlag"))
    segmented = materialize(segmented, "customer-features")

    volatility = materialize(sku_volatility(lines), "sku")
    risk = materialize(inventory_risk(volatility, limit), "sku-risk")

    # The large tables come first, while the lines are narrow; the risks, which may be sent packed, after the shuffle.
    out = attach(clean, segmented, "Customer ID", "n_lines")
    out = attach_whole(out, risk, "StockCode", "n_lines")
    out = with_line_features(out).withColumn(
        "ProductCategory", product_category("Description", settings.product_categories))
    out = out.join(F.broadcast(months), "InvoiceMonth", "left")     # twelve rows
    out = out.join(daily, "sales_date", "left")                      # calendar-sized
    out = attach(out, materialize(countries, "country-ranks"), "Country", "n_lines")
    out = out.withColumn("InventoryRiskScore", F.coalesce("InventoryRiskScore", F.lit(0.5)))
    return out.select(*FEATURE_COLUMNS)


FEATURE_COLUMNS = [
    "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID",
    "Country", "is_outlier_capped", "TotalAmount", "InvoiceMonth", "InvoiceDay", "InvoiceHour",
    "WeekendFlag", "CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency",
    "DaysSinceLastPurchase", "sales_date", "Rolling7DaySales", "Rolling30DaySales",
    "Lag_1_Day_Sales", "Lag_7_Day_Sales", "daily_sales", "ProductCategory", "CountrySalesRank",
    "CustomerSegment", "ChurnFlag", "SeasonalIndex", "InventoryRiskScore",
]


# Columns that are equal on all lines of a customer, so any line shows the first value.
CUSTOMER_COLUMNS = ["CustomerLifetimeValue", "AvgOrderValue", "PurchaseFrequency",
                    "DaysSinceLastPurchase", "CustomerSegment", "ChurnFlag"]


def first_values(key: str, columns: list[str], order: list[str] = ROW_ORDER) -> list[Column]:
    """Aggregates for the first non-null value of each column, in row order."""
    position = F.struct(*[F.col(f"`{c}`") for c in order])
    constant = CUSTOMER_COLUMNS if key == "Customer ID" else []
    return [F.max(c).alias(c) if c in constant else
            F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), position)).alias(c)
            for c in columns]


def first_per_key(df: DataFrame, key: str, columns: list[str],
                  order: list[str] = ROW_ORDER) -> DataFrame:
    """First non-null value of each column per key, in row order.

    `df` is read twice and should be stored.  Where the order begins with a time, the first time of
    each column and key is found by hashing, and only the rows of these times are put in order.  Where the keys are
    too many for a broadcast, a sieve takes away most other rows before any are shuffled.
    """
    # The greatest text cannot be found by hashing; a text is looked up like a varying column.
    constant = [c for c in CUSTOMER_COLUMNS if key == "Customer ID" and dict(df.dtypes).get(c) != "string"]
    varying = [c for c in dict.fromkeys(columns) if c not in constant]
    if not varying or not isinstance(df.schema[order[0]].dataType, T.TimestampType):
        return df.groupBy(F.col(f"`{key}`")).agg(*first_values(key, columns, order))
    names = list(dict.fromkeys([key, *order, *varying]))
    micros = F.coalesce(F.unix_micros(F.col(f"`{order[0]}`")), F.lit(-2 ** 63))         # null comes first
    heads = materialize(df.groupBy(F.col(f"`{key}`")).agg(
        *[F.max(c).alias(c) for c in columns if c in constant], F.count("*").alias("_n"),
        *[F.min(F.when(F.col(f"`{c}`").isNotNull(), micros)).alias(f"_t{i}") for i, c in enumerate(varying)]), "heads")
    times = [f"_t{i}" for i in range(len(varying))]
    rows, known = df.select(*[F.col(f"`{c}`") for c in names]), heads.select(F.col(f"`{key}`"), "_n", *times)
    if heads.count() > broadcast_rows(known.drop("_n")):
        wanted = heads.select(F.col(f"`{key}`"), F.explode(F.array_distinct(F.array(*times))).alias("_t")).filter("_t is not null")
        rows = sieved(rows, wanted, [F.col(f"`{key}`"), micros], [F.col(f"`{key}`"), F.col("_t")])
    timed = attach(rows, known, key, "_n")
    early = reduce(or_, [F.col(f"`{c}`").isNotNull() & (micros == F.col(t)) for c, t in zip(varying, times)])
    firsts = timed.filter(early).drop(*times)
    unknown = F.col(f"`{key}`").isNull()
    if not heads.filter(unknown).isEmpty():
        firsts = firsts.unionByName(df.filter(unknown).select(*firsts.columns))
    found = firsts.groupBy(F.col(f"`{key}`").alias("_key")).agg(*first_values(key, varying, order))
    rest = heads.drop("_n", *times)
    return rest.join(found, rest[f"`{key}`"].eqNullSafe(found["_key"]), "left").select(
        F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in columns])
