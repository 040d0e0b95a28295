"""Row-level expressions. All are built-in Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import DEFAULTS

# Category rules in precedence order; first hit wins.
CATEGORY_RULES = [
    ("HOME", ["HOME", "BOX", "BASKET", "CANDLE", "FRAME"]),
    ("FASHION", ["BAG", "SHIRT", "DRESS", "SCARF", "SHOE"]),
    ("GIFT", ["GIFT", "CARD", "WRAP", "PARTY"]),
    ("KITCHEN", ["MUG", "CUP", "PLATE", "KITCHEN", "LUNCH"]),
    ("DECOR", ["LIGHT", "LAMP", "DECOR", "ORNAMENT"]),
    ("STATIONERY", ["PAPER", "PEN", "NOTEBOOK", "CARD"]),
    ("TOY", ["TOY", "GAME", "DOLL"]),
]

MICROS_PER_DAY = 86_400_000_000
MONEY = "decimal(18,6)"        # one line's amount
TOTAL = "decimal(32,6)"        # an amount that is a sum already


def exact_sum(col: Column | str, kind: str = MONEY) -> Column:
    """Sum of a double column that does not depend on row order.

    Doubles are added as decimals (six places), so the same rows give the same
    total under any partitioning or after a retried task.  Sums of sums ask for `TOTAL`.
    """
    col = F.col(col) if isinstance(col, str) else col
    return F.sum(col.cast(kind)).cast("double")


def exact_avg(col: Column | str, kind: str = MONEY) -> Column:
    """Mean on top of `exact_sum`; nulls are skipped."""
    return exact_sum(col, kind) / F.count(col)


def line_amount() -> Column:
    return F.col("Quantity") * F.col("Price")


def weekend_flag(ts: Column | str) -> Column:
    """1 on Saturday and Sunday (weekday 0 is Monday)."""
    return (F.weekday(ts) >= 5).cast("int")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded down."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int")


def product_category(description: Column | str, buckets: int | None = None,
                     rules=CATEGORY_RULES) -> Column:
    """Keyword category of a description, else a hashed `CAT_n` bucket.

    `buckets` is the number of product categories asked for; the rules and the
    rest class take up part of it, and at least one hash bucket remains.
    """
    description = F.col(description) if isinstance(description, str) else description
    wanted = DEFAULTS.product_categories if buckets is None else buckets
    spare = max(wanted - (len(rules) + 1) + 1, 1)
    text = F.upper(F.coalesce(description, F.lit("")))
    chain = None
    for name, words in rules:
        hit = text.contains(words[0])
        for word in words[1:]:
            hit = hit | text.contains(word)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    bucket = F.lit("0") if spare == 1 else F.pmod(F.xxhash64(text), F.lit(spare)).cast("string")
    return chain.otherwise(F.concat(F.lit("CAT_"), bucket))


def clip(col: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value; a null stays null."""
    out = col
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(col.isNotNull(), out)


def half_even(col: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.rint(col)


def stock_status(risk: Column) -> Column:
    return (F.when(risk > 0.7, "Critical – Reorder Now")
            .when(risk > 0.4, "Monitor")
            .otherwise("Healthy"))


def churn_risk(probability: Column) -> Column:
    return (F.when(probability >= 0.7, "High")
            .when(probability >= 0.4, "Medium")
            .otherwise("Low"))


def with_calendar_parts(df: DataFrame, ts: str = "InvoiceDate") -> DataFrame:
    return df.withColumns({
        "InvoiceMonth": F.month(ts),
        "InvoiceDay": F.dayofmonth(ts),
        "InvoiceHour": F.hour(ts),
        "WeekendFlag": weekend_flag(ts),
    })


def with_line_features(df: DataFrame) -> DataFrame:
    """Line amount, calendar parts and the sales day."""
    out = with_calendar_parts(df.withColumn("TotalAmount", line_amount()))
    return out.withColumn("sales_date", F.to_date("InvoiceDate"))


def available(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that exist, in wanted order."""
    have = set(df.columns)
    return [name for name in wanted if name in have]


def select_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in available(df, wanted)])


def fill_model_inputs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null model inputs become 0."""
    return df.fillna(0, subset=available(df, columns))
