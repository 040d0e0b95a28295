"""The shared tables of the SQL twins, from the raw tables to the feature table."""

ORDER = ('"InvoiceDate", "Invoice", "StockCode", "Quantity", "Price", '
         '"Customer ID", "Description", "Country"')


def money(x: str) -> str:
    """Exact sum of a double expression."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({a}) - epoch_us({b})) / 86400000000.0) AS BIGINT)"


CATEGORY = """CASE
    WHEN regexp_matches(upper("Description"), 'HOME|BOX|BASKET|CANDLE|FRAME') THEN 'HOME'
    WHEN regexp_matches(upper("Description"), 'BAG|SHIRT|DRESS|SCARF|SHOE') THEN 'FASHION'
    WHEN regexp_matches(upper("Description"), 'GIFT|CARD|WRAP|PARTY') THEN 'GIFT'
    WHEN regexp_matches(upper("Description"), 'MUG|CUP|PLATE|KITCHEN|LUNCH') THEN 'KITCHEN'
    WHEN regexp_matches(upper("Description"), 'LIGHT|LAMP|DECOR|ORNAMENT') THEN 'DECOR'
    WHEN regexp_matches(upper("Description"), 'PAPER|PEN|NOTEBOOK|CARD') THEN 'STATIONERY'
    WHEN regexp_matches(upper("Description"), 'TOY|GAME|DOLL') THEN 'TOY'
    ELSE 'CAT_0' END"""

CHAIN = f"""joined AS (
  SELECT * FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey),
plain AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS "Invoice", CAST(l_partkey AS VARCHAR) AS "StockCode",
    p_name AS "Description", l_quantity AS "Quantity",
    o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS "InvoiceDate",
    l_extendedprice AS "Price", CAST(o_custkey AS VARCHAR) AS "Customer ID", n_name AS "Country"
  FROM joined),
dirty_once AS (
  SELECT l_orderkey AS _key,
    CAST(l_orderkey AS VARCHAR) AS "Invoice", CAST(l_partkey AS VARCHAR) AS "StockCode",
    CASE WHEN l_partkey % 10 = 3 AND l_linenumber = 1 THEN NULL
      ELSE p_name || CASE l_partkey % 9 WHEN 0 THEN ' box' WHEN 1 THEN ' bag' WHEN 2 THEN ' gift card'
          WHEN 3 THEN ' mug' WHEN 4 THEN ' lamp' WHEN 5 THEN ' notebook' WHEN 6 THEN ' toy'
          WHEN 7 THEN ' pendant' ELSE '' END
        || CASE l_linenumber % 3 WHEN 1 THEN ' red' WHEN 2 THEN ' set' ELSE '' END END AS "Description",
    CASE WHEN l_orderkey % 89 = 0 AND l_linenumber = 2 THEN 'n/a'
      WHEN l_orderkey % 97 = 0 THEN CAST(-l_quantity AS VARCHAR)
      ELSE CAST(l_quantity AS VARCHAR) END AS "Quantity",
    CASE WHEN l_orderkey % 101 = 0 AND l_linenumber = 4 THEN 'not a date'
      ELSE strftime(o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
      END AS "InvoiceDate",
    CASE WHEN l_orderkey % 83 = 0 AND l_linenumber = 3 THEN 'free'
      ELSE CAST(l_extendedprice AS VARCHAR) END AS "Price",
    CASE WHEN o_custkey % 50 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS "Customer ID",
    CASE WHEN l_orderkey % 71 <> 0 THEN n_name END AS "Country"
  FROM joined),
raw AS (
  SELECT * EXCLUDE (_key) FROM dirty_once
  UNION ALL SELECT * EXCLUDE (_key) FROM dirty_once WHERE _key % 100 = 0),
coerced AS (
  SELECT "Invoice", "StockCode", "Description", try_cast("Quantity" AS DOUBLE) AS "Quantity",
    try_cast("InvoiceDate" AS TIMESTAMP) AS "InvoiceDate", try_cast("Price" AS DOUBLE) AS "Price",
    "Customer ID", "Country" FROM raw),
valid AS (
  SELECT * FROM coerced WHERE "Invoice" IS NOT NULL AND "StockCode" IS NOT NULL
    AND "Quantity" IS NOT NULL AND "Price" IS NOT NULL AND "InvoiceDate" IS NOT NULL),
text_modes AS (
  SELECT "StockCode", "Description" AS mode_text FROM (
    SELECT "StockCode", "Description",
      row_number() OVER (PARTITION BY "StockCode" ORDER BY count(*) DESC, "Description") AS rn
    FROM valid WHERE "Description" IS NOT NULL GROUP BY "StockCode", "Description") WHERE rn = 1),
country_mode AS (
  SELECT "Country" AS mode_country FROM valid WHERE "Country" IS NOT NULL
  GROUP BY "Country" ORDER BY count(*) DESC, "Country" LIMIT 1),
filled AS (
  SELECT "Invoice", v."StockCode", coalesce("Description", mode_text, 'Unknown') AS "Description",
    "Quantity", "InvoiceDate", "Price",
    CASE WHEN "Customer ID" IS NULL OR "Customer ID" IN ('nan', 'None') THEN 'GUEST'
      ELSE "Customer ID" END AS "Customer ID",
    coalesce("Country", (SELECT mode_country FROM country_mode)) AS "Country"
  FROM valid v LEFT JOIN text_modes t ON v."StockCode" = t."StockCode"),
positive AS (SELECT * FROM filled WHERE "Quantity" > 0 AND "Price" > 0),
caps AS (
  SELECT round(quantile_cont("Price", 0.995), 6) AS price_cap,
    round(quantile_cont("Quantity", 0.99), 6) AS quantity_cap FROM positive),
capped AS (
  SELECT "Invoice", "StockCode", "Description", least("Quantity", quantity_cap) AS "Quantity",
    "InvoiceDate", least("Price", price_cap) AS "Price", "Customer ID", "Country",
    CASE WHEN "Price" >= price_cap OR "Quantity" >= quantity_cap THEN 1 ELSE 0 END AS is_outlier_capped
  FROM positive CROSS JOIN caps),
clean AS MATERIALIZED (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY "Invoice", "StockCode", "Quantity", "Price", "InvoiceDate", "Customer ID"
      ORDER BY {ORDER}) AS rn FROM capped) WHERE rn = 1),
lines AS MATERIALIZED (
  SELECT *, "Quantity" * "Price" AS "TotalAmount", month("InvoiceDate") AS "InvoiceMonth",
    day("InvoiceDate") AS "InvoiceDay", hour("InvoiceDate") AS "InvoiceHour",
    CASE WHEN isodow("InvoiceDate") >= 6 THEN 1 ELSE 0 END AS "WeekendFlag",
    CAST("InvoiceDate" AS DATE) AS sales_date, {CATEGORY} AS "ProductCategory"
  FROM clean),
snap AS (SELECT max("InvoiceDate") AS snapshot FROM lines),
cust AS MATERIALIZED (
  SELECT *, "CustomerLifetimeValue" / greatest(order_count, 1) AS "AvgOrderValue",
    order_count / CAST(greatest({days('last_purchase', 'first_purchase')}, 1) AS DOUBLE) AS "PurchaseFrequency",
    {days('(SELECT snapshot FROM snap)', 'last_purchase')} AS "DaysSinceLastPurchase"
  FROM (SELECT "Customer ID", {money('"TotalAmount"')} AS "CustomerLifetimeValue",
      count(DISTINCT "Invoice") AS order_count, max("InvoiceDate") AS last_purchase,
      min("InvoiceDate") AS first_purchase, count(*) AS n_lines
    FROM lines GROUP BY "Customer ID")),
daily AS MATERIALIZED (
  SELECT sales_date, {money('"TotalAmount"')} AS daily_sales FROM lines GROUP BY sales_date),
daily_features AS (
  SELECT sales_date, daily_sales,
    CAST(sum(CAST(daily_sales AS DECIMAL(18,6))) OVER w7 AS DOUBLE) / count(*) OVER w7 AS "Rolling7DaySales",
    CAST(sum(CAST(daily_sales AS DECIMAL(18,6))) OVER w30 AS DOUBLE) / count(*) OVER w30 AS "Rolling30DaySales",
    coalesce(lag(daily_sales, 1) OVER w, m) AS "Lag_1_Day_Sales",
    coalesce(lag(daily_sales, 7) OVER w, m) AS "Lag_7_Day_Sales"
  FROM daily CROSS JOIN (
    SELECT CAST(sum(CAST(daily_sales AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS m FROM daily)
  WINDOW w AS (ORDER BY sales_date),
    w7 AS (ORDER BY sales_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
    w30 AS (ORDER BY sales_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
country_rank AS (
  SELECT "Country", sales, rank() OVER (ORDER BY sales DESC)
    + (count(*) OVER (PARTITION BY sales) - 1) / 2.0 AS "CountrySalesRank"
  FROM (SELECT "Country", {money('"TotalAmount"')} AS sales FROM lines GROUP BY "Country")),
season AS (
  SELECT "InvoiceMonth", {money('"TotalAmount"')} / count(*)
    / greatest((SELECT {money('"TotalAmount"')} / count(*) FROM lines), 1e-6) AS "SeasonalIndex"
  FROM lines GROUP BY "InvoiceMonth"),
sku AS MATERIALIZED (
  SELECT *, round(sales_std / greatest(sales_mean, 1e-6), 9) AS cv FROM (
    SELECT "StockCode", coalesce(stddev_samp("TotalAmount"), 0.0) AS sales_std,
      {money('"TotalAmount"')} / count(*) AS sales_mean, {money('"Quantity"')} AS qty_sum,
      count(*) AS n_lines FROM lines GROUP BY "StockCode")),
sku_risk AS (
  SELECT "StockCode", cv_rank, qty_rank,
    least(greatest(cv_rank * CAST(0.6 AS DOUBLE) + (1 - qty_rank) * CAST(0.4 AS DOUBLE), 0.0), 1.0)
      AS "InventoryRiskScore"
  FROM (SELECT "StockCode",
      (rank() OVER (ORDER BY cv) + (count(*) OVER (PARTITION BY cv) - 1) / CAST(2 AS DOUBLE))
        / count(*) OVER () AS cv_rank,
      (rank() OVER (ORDER BY qty_sum) + (count(*) OVER (PARTITION BY qty_sum) - 1) / CAST(2 AS DOUBLE))
        / count(*) OVER () AS qty_rank
    FROM sku)),
line_ranks AS MATERIALIZED (
  SELECT l.*, c."DaysSinceLastPurchase", c.order_count, c."CustomerLifetimeValue",
    row_number() OVER (ORDER BY c."DaysSinceLastPurchase", {ORDER.replace('"Customer ID"', 'l."Customer ID"')}) AS r_rank,
    row_number() OVER (ORDER BY c.order_count, {ORDER.replace('"Customer ID"', 'l."Customer ID"')}) AS f_rank,
    row_number() OVER (ORDER BY c."CustomerLifetimeValue", {ORDER.replace('"Customer ID"', 'l."Customer ID"')}) AS m_rank,
    row_number() OVER (PARTITION BY l."Customer ID" ORDER BY {ORDER.replace('"Customer ID"', 'l."Customer ID"')}) AS line_no,
    count(*) OVER () AS n
  FROM lines l JOIN cust c ON l."Customer ID" = c."Customer ID"),
quartiles AS (
  SELECT "Customer ID", greatest(1, ceil(4.0 * (r_rank - 1) / greatest(n - 1, 1))) AS r_q,
    greatest(1, ceil(4.0 * (f_rank - 1) / greatest(n - 1, 1))) AS f_q,
    greatest(1, ceil(4.0 * (m_rank - 1) / greatest(n - 1, 1))) AS m_q
  FROM line_ranks WHERE line_no = 1),
segments AS (
  SELECT "Customer ID", score AS rfm_score, CASE WHEN score >= 10 THEN 'Champions' WHEN score >= 8 THEN 'Loyal'
    WHEN score >= 6 THEN 'Potential' WHEN score >= 4 THEN 'At Risk' ELSE 'Hibernating' END AS "CustomerSegment"
  FROM (SELECT "Customer ID", (5 - r_q) + f_q + m_q AS score FROM quartiles)),
features AS MATERIALIZED (
  SELECT l.*, c."CustomerLifetimeValue", c."AvgOrderValue", c."PurchaseFrequency",
    c."DaysSinceLastPurchase", d.daily_sales, d."Rolling7DaySales", d."Rolling30DaySales",
    d."Lag_1_Day_Sales", d."Lag_7_Day_Sales", k."CountrySalesRank", g."CustomerSegment",
    CASE WHEN c."DaysSinceLastPurchase" > 90 THEN 1 ELSE 0 END AS "ChurnFlag",
    m."SeasonalIndex", coalesce(r."InventoryRiskScore", 0.5) AS "InventoryRiskScore"
  FROM lines l
  LEFT JOIN cust c ON l."Customer ID" = c."Customer ID"
  LEFT JOIN daily_features d ON l.sales_date = d.sales_date
  LEFT JOIN country_rank k ON l."Country" = k."Country"
  LEFT JOIN segments g ON l."Customer ID" = g."Customer ID"
  LEFT JOIN season m ON l."InvoiceMonth" = m."InvoiceMonth"
  LEFT JOIN sku_risk r ON l."StockCode" = r."StockCode"),
first_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY {ORDER}) AS rn FROM features)
  WHERE rn = 1)"""
