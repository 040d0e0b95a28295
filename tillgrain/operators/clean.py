"""Cleaning: coercion, imputation, capping and keyed deduplication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..errors import DataContractError
from ..schema import CRITICAL, DEFAULTS, LINE_KEY, REQUIRED, ROW_ORDER, Settings
from ..session import materialize
from .joins import attach, broadcast_rows
from .ranking import exact_quantiles

GUEST = "GUEST"
# Capped values are rounded here, so that they compare equal on any machine.
CAP_DIGITS = 6
REPEATED = 3_000_000    # hashes of repeated keys that are broadcast


def coerce_types(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Dates, numbers and ids as their types; what cannot be read becomes null."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def number(name):
        value = F.col(name).try_cast("double")
        if isinstance(types[name], T.StringType):     # "5d" is a Java number, but no number here
            value = F.when(F.trim(name).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), value)
        return F.when(~F.isnan(value), value)

    def stamp(name):
        if isinstance(types[name], (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.col(name).cast("timestamp")
        # ISO 8601 in full (fractions and zones, too), then the listed patterns.
        iso = F.when(F.trim(name).rlike(r"^\d{4}-\d{2}-\d{2}"), F.col(name).try_cast("timestamp"))
        return F.coalesce(iso, *[F.try_to_timestamp(F.col(name), F.lit(f))
                                 for f in settings.timestamp_formats])

    customer = F.regexp_replace(F.col("`Customer ID`").cast("string"), r"^(\d+)\.0$", "$1")
    return df.withColumns({
        "Invoice": F.col("Invoice").cast("string"),
        "StockCode": F.col("StockCode").cast("string"),
        "InvoiceDate": stamp("InvoiceDate"),
        "Quantity": number("Quantity"),
        "Price": number("Price"),
        "Customer ID": customer,
    })


def drop_missing_critical(df: DataFrame) -> DataFrame:
    return df.dropna(subset=CRITICAL)


def description_modes(df: DataFrame) -> DataFrame:
    """Most frequent description per product; ties go to the smallest text.

    Counted per (product, text) first, so no task holds all texts of a product.
    `n_missing` counts the product's lines that wait for a description.
    """
    counts = df.groupBy("StockCode", "Description").agg(F.count("*").alias("n"))
    known = F.col("Description").isNotNull()
    return counts.groupBy("StockCode").agg(
        F.min(F.when(known, F.struct((-F.col("n")).alias("n"), F.col("Description").alias("text"))))
        ["text"].alias("mode_description"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_missing"))


def fill_descriptions(df: DataFrame) -> DataFrame:
    """Null descriptions take the mode of their product, else `Unknown`.

    Only the lines without a description are joined; all others pass through.  Texts are counted
    for products with such lines alone, unless these are too many for a broadcast.
    """
    missing = df.filter(F.col("Description").isNull())
    gaps = materialize(missing.select("StockCode").distinct(), "description-gaps")
    few = gaps.count() <= broadcast_rows(gaps)
    counted = df.join(F.broadcast(gaps), "StockCode", "left_semi") if few else df
    modes = materialize(description_modes(counted).filter("n_missing > 0"), "description-modes")
    filled = attach(missing, modes, "StockCode", "n_missing")
    filled = filled.withColumn("Description", F.coalesce("mode_description", F.lit("Unknown")))
    return df.filter(F.col("Description").isNotNull()).unionByName(filled.select(*df.columns))


def country_mode(df: DataFrame) -> DataFrame:
    """The most frequent country as a one-row table; ties go to the smallest."""
    return (df.filter(F.col("Country").isNotNull()).groupBy("Country")
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "Country").limit(1)
            .select("Country"))


def fill_countries(df: DataFrame) -> DataFrame:
    return df.withColumn("Country", F.coalesce("Country", country_mode(df).scalar()))


def bucket_guests(df: DataFrame) -> DataFrame:
    """Lines without a customer belong to one customer called GUEST."""
    customer = F.col("`Customer ID`")
    return df.withColumn("Customer ID", F.when(customer.isNull() | customer.isin("nan", "None"), GUEST)
                         .otherwise(customer))


def keep_positive(df: DataFrame) -> DataFrame:
    return df.filter((F.col("Quantity") > 0) & (F.col("Price") > 0))


@dataclass(frozen=True)
class Caps:
    price: float
    quantity: float


def find_caps(df: DataFrame, settings: Settings = DEFAULTS) -> Caps:
    """Upper percentiles of price and quantity over positive lines."""
    found = exact_quantiles(df, {"Price": [settings.price_cap],
                                 "Quantity": [settings.quantity_cap]})
    if found["Price"][0] is None:
        raise DataContractError("no line with positive quantity and price")
    return Caps(round(found["Price"][0], CAP_DIGITS), round(found["Quantity"][0], CAP_DIGITS))


def cap_outliers(df: DataFrame, caps: Caps) -> DataFrame:
    """Clip at the caps; a line that reaches one is flagged."""
    clipped = df.withColumns({"Price": F.least("Price", F.lit(caps.price)),
                              "Quantity": F.least("Quantity", F.lit(caps.quantity))})
    reached = (F.col("Price") >= caps.price) | (F.col("Quantity") >= caps.quantity)
    return clipped.withColumn("is_outlier_capped", reached.cast("int"))


def dedupe_lines(df: DataFrame, key: list[str] = LINE_KEY, order: list[str] = ROW_ORDER) -> DataFrame:
    """Keep the first line per key.  `df` is read three times and should come from a stored table.

    Hashes of the keys are counted first: a line whose hash is met once has no other line of its
    key, so it passes without being shuffled or sorted.  Only the rest is ordered; with too many
    repeated keys for a broadcast, all lines are.
    """
    hashed = df.withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in key]))
    repeated = materialize(hashed.groupBy("_h").agg(F.count("*").alias("n")).filter("n > 1").select("_h"), "repeated-keys")
    n = repeated.count()
    if not n:
        return df
    if n > REPEATED:
        return first_lines(df, key, order)
    alone = hashed.join(F.broadcast(repeated), "_h", "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
    again = hashed.join(F.broadcast(repeated), "_h", "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return alone.unionAll(first_lines(again, key, order))


def first_lines(df: DataFrame, key: list[str], order: list[str] = ROW_ORDER) -> DataFrame:
    """The first line per key in an order.

    Spark limits each map task to one line per key before the shuffle
    (WindowGroupLimit), so copies of one line do not pile up in one task.
    """
    w = W.partitionBy(*[F.col(f"`{c}`") for c in key]).orderBy(*[F.col(f"`{c}`") for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def flag_iqr_outliers(df: DataFrame, column: str, out: str = "is_outlier",
                      factor: float = 1.5) -> DataFrame:
    """1 where a value lies outside the quartiles by more than `factor` IQRs."""
    q1, q3 = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    if q1 is None:
        return df.withColumn(out, F.lit(0))
    low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
    outside = (F.col(column) < low) | (F.col(column) > high)
    return df.withColumn(out, F.coalesce(outside.cast("int"), F.lit(0)))


def typed_lines(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The contract columns with their types, stored, so that text is parsed once."""
    return materialize(coerce_types(raw.select(*[F.col(f"`{c}`") for c in REQUIRED]), settings), "typed-lines")


def clean_transactions(raw: DataFrame, settings: Settings = DEFAULTS, caps: Caps | None = None) -> DataFrame:
    """The whole cleaning chain; the caps are taken before deduplication."""
    return clean_typed(typed_lines(raw, settings), settings, caps)


def clean_typed(typed: DataFrame, settings: Settings = DEFAULTS, caps: Caps | None = None) -> DataFrame:
    """The cleaning of stored `typed_lines`; the passes for modes and caps read only their columns."""
    lines = drop_missing_critical(typed)
    gaps = lines.agg(F.count_if(F.col("Description").isNull()).alias("text"),
                     F.count_if(F.col("Country").isNull()).alias("country")).first()
    if caps is None:
        caps = find_caps(keep_positive(lines), settings)
    out = lines
    if gaps["country"]:
        out = fill_countries(out)
    if gaps["text"]:
        out = fill_descriptions(out)
    out = keep_positive(bucket_guests(out))
    return dedupe_lines(cap_outliers(out, caps))
