"""Daily demand forecasting for any number of series at once.

A series frame has the columns (series, ds, y).  One series never exceeds a
calendar, so per-series windows and groups are small; the series are what spreads
over the cluster.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scalars import exact_sum
from ..schema import DEFAULTS, Settings
from ..session import materialize
from .calendar import fill_calendar
from .features import daily_sales, rolling_mean
from .recurrent import RecurrentModel, fit_recurrent
from .trend import fit_and_predict, fitted_row, predict_row

LAGS = (1, 7, 14)
LAG_FEATURES = ["lag_1", "lag_7", "lag_14", "rolling_7", "rolling_30", "day_of_week", "month"]
ALL = "all"


# ---- frames --------------------------------------------------------------------

def daily_series(lines: DataFrame, key: str | None = None, smooth: int = 7) -> DataFrame:
    """Gap-free daily sales per series, smoothed by a trailing mean of `smooth` rows."""
    series = F.lit(ALL) if key is None else F.col(f"`{key}`").cast("string")
    daily = lines.groupBy(series.alias("series"), F.to_date("InvoiceDate").alias("ds")).agg(
        exact_sum("TotalAmount").alias("y"))
    filled = fill_calendar(daily, "ds", "y", ["series"])
    return filled.withColumn("y", rolling_mean("y", smooth, ["series"], "ds")) if smooth > 1 else filled


def supervised_frame(series: DataFrame, include_today: bool = False) -> DataFrame:
    """Lags, rolling means and calendar parts; rows without all lags are dropped.

    With `include_today` the rolling means contain the value to be predicted, as in
    the original definition; by default they end the day before.
    """
    w = W.partitionBy("series").orderBy("ds")
    out = series.withColumns({f"lag_{n}": F.lag("y", n).over(w) for n in LAGS})
    value = "y"
    if not include_today:
        out = out.withColumn("_previous", F.lag("y", 1).over(w))
        value = "_previous"
    out = out.withColumns({f"rolling_{n}": rolling_mean(value, n, ["series"], "ds") for n in (7, 30)})
    out = out.withColumns({"day_of_week": F.weekday("ds"), "month": F.month("ds")})
    return out.drop("_previous").dropna()


def chronological_split(series: DataFrame, share: float = DEFAULTS.train_share) -> DataFrame:
    """Mark the first `share` of each series as train, the rest as test."""
    place = F.row_number().over(W.partitionBy("series").orderBy("ds"))
    size = F.count("*").over(W.partitionBy("series"))
    return series.withColumn("part", F.when(place <= F.floor(size * F.lit(share)), "train")
                             .otherwise("test"))


# ---- trend and seasonality -----------------------------------------------------

def trend_season_forecast(series: DataFrame, days: DataFrame) -> DataFrame:
    """Fit each series and predict the (series, ds) rows of `days` with an 80 % interval.

    Linear trend with few slope changes, yearly and weekly seasonality (see `trend`).
    """
    known = series.select("series", "ds", F.col("y").cast("double").alias("y"))
    both = known.unionByName(days.select("series", "ds", F.lit(None).cast("double").alias("y")))
    return both.groupBy("series").applyInPandas(
        fit_and_predict, "series string, ds date, yhat double, yhat_lower double, yhat_upper double")


TREND_ROW = "series string, start double, span double, size double, noise double, knots array<double>, beta array<double>"


def trend_models(series: DataFrame) -> DataFrame:
    """The fitted trend of each series as a row, to be stored."""
    return series.select("series", "ds", F.col("y").cast("double").alias("y")).groupBy("series").applyInPandas(
        fitted_row, TREND_ROW)


def trend_predict(models: DataFrame, days: DataFrame) -> DataFrame:
    """Forecast of (series, ds) by stored `trend_models`, equal to a fresh fit of the same series."""
    return models.groupBy("series").cogroup(days.select("series", "ds").groupBy("series")).applyInPandas(
        predict_row, "series string, ds date, yhat double, yhat_lower double, yhat_upper double")


def future_days(series: DataFrame, horizon: int, origin: str = "last",
                share: float = DEFAULTS.train_share) -> DataFrame:
    """`horizon` days after the last day of each series.

    `origin="train_end"` starts after the training part instead, which is what a
    model fitted on that part predicts when asked for its future.
    """
    if not 1 <= horizon <= 90:
        raise ValueError("horizon must be between 1 and 90 days")
    if origin == "train_end":
        series = chronological_split(series, share).filter("part = 'train'")
    elif origin != "last":
        raise ValueError("origin is 'last' or 'train_end'")
    ends = series.groupBy("series").agg(F.max("ds").alias("_end"))
    return ends.select("series", F.explode(F.sequence(
        F.date_add("_end", 1), F.date_add("_end", horizon))).alias("ds"))


def future_forecast(series: DataFrame, horizon: int = DEFAULTS.forecast_horizon,
                    origin: str = "last", share: float = DEFAULTS.train_share) -> DataFrame:
    """Forecast of the days after each series (see `future_days`)."""
    days = future_days(series, horizon, origin, share)
    if origin == "train_end":
        series = chronological_split(series, share).filter("part = 'train'")
    return trend_season_forecast(series, days)


# ---- learned regressors ---------------------------------------------------------

def boosted_lag_model(train: DataFrame, settings: Settings = DEFAULTS):
    """Boosted trees on the lag features, pooled over all series."""
    rows = VectorAssembler(inputCols=LAG_FEATURES, outputCol="features").transform(train)
    return GBTRegressor(labelCol="y", maxIter=settings.boost_trees, maxDepth=settings.boost_depth,
                        stepSize=settings.boost_rate, seed=settings.seed).fit(rows)


def boosted_lag_forecast(supervised: DataFrame, test_days: DataFrame, model) -> DataFrame:
    """Predictions on the test days; on the last rows of a series when none survive.

    `test_days` has (series, ds).  Series are handled one by one: a series without
    any supervised test row answers with as many of its last rows as it has days, under the
    asked days in their order.
    """
    asked = test_days.groupBy("series").agg(F.count("*").alias("_asked"), F.sort_array(F.collect_list("ds")).alias("_days"))
    marked = supervised.join(test_days.withColumn("_test", F.lit(True)), ["series", "ds"], "left")
    whole = W.partitionBy("series")
    marked = marked.withColumns({
        "_hits": F.count("_test").over(whole),
        "_back": F.row_number().over(whole.orderBy(F.desc("ds")))}).join(asked, "series")
    rows = marked.filter(F.col("_test") | ((F.col("_hits") == 0) & (F.col("_back") <= F.col("_asked")))).withColumn(
        "ds", F.when(F.col("_test"), F.col("ds")).otherwise(F.get("_days", (F.col("_asked") - F.col("_back")).cast("int"))))
    rows = VectorAssembler(inputCols=LAG_FEATURES, outputCol="features").transform(rows)
    return model.transform(rows).select("series", "ds", F.col("prediction").alias("yhat"))


def sequence_frame(series: DataFrame, length: int = DEFAULTS.sequence_length) -> DataFrame:
    """Min-max scaled value and the array of the `length` scaled values before it."""
    whole = W.partitionBy("series")
    low, high = F.min("y").over(whole), F.max("y").over(whole)
    width = F.when(high > low, high - low).otherwise(F.lit(1.0))
    scaled = series.withColumns({"_low": low, "_width": width})
    scaled = scaled.withColumn("scaled", (F.col("y") - F.col("_low")) / F.col("_width"))
    before = W.partitionBy("series").orderBy("ds").rowsBetween(-length, -1)
    return (scaled.withColumn("lags", F.collect_list("scaled").over(before))
            .filter(F.size("lags") == length))


def linear_map(train: DataFrame) -> tuple[np.ndarray, float]:
    """Linear map from the scaled lags to the next scaled value, pooled over series."""
    rows = train.select(array_to_vector("lags").alias("features"), F.col("scaled").alias("label"))
    fitted = LinearRegression(regParam=1e-4).fit(rows)
    return fitted.coefficients.toArray(), float(fitted.intercept)


def sequence_model(train: DataFrame, settings: Settings = DEFAULTS) -> RecurrentModel:
    """A recurrent network over the scaled lags, pooled over series; it starts as the linear map."""
    rows = materialize(train.select("series", "ds", "lags", F.col("scaled").alias("target"))
                       .repartitionByRange("series", "ds").sortWithinPartitions("series", "ds")
                       .select("lags", "target"), "sequences")
    if rows.isEmpty():
        return fit_recurrent(rows, np.zeros(settings.sequence_length), 0.0, settings.sequence_hidden, 0, 0.0, settings.seed)
    skip, level = linear_map(train)
    return fit_recurrent(rows, skip, level, settings.sequence_hidden, settings.sequence_epochs,
                         settings.sequence_rate, settings.seed)


def sequence_forecast(frame: DataFrame, test_days: DataFrame, model: RecurrentModel) -> DataFrame:
    """Next-day predictions on the test days, scaled back."""
    rows = frame.join(test_days.select("series", "ds"), ["series", "ds"], "left_semi")
    return rows.select("series", "ds", (model.predict(F.col("lags")) * F.col("_width") + F.col("_low")).alias("yhat"))


# ---- evaluation and blending -----------------------------------------------------

def guarded_errors(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """MAPE (percent) and MAE of (y, yhat) per key.

    Each denominator is at least the 5 % quantile of y, so near-zero days do not
    dominate.  A zero denominator gives an infinite error, as in plain arithmetic.
    """
    floor = W.partitionBy(*keys)
    rows = pairs.withColumn("_floor", F.percentile("y", F.lit(0.05)).over(floor))
    denominator = F.greatest(F.abs("y"), F.col("_floor"))
    error = F.abs(F.col("y") - F.col("yhat"))
    share = F.when(denominator != 0, error / F.abs(denominator)).when(
        error > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return rows.groupBy(*keys).agg((F.avg(share) * 100).alias("mape"), F.avg(error).alias("mae"))


def ensemble_weights(errors: DataFrame) -> DataFrame:
    """Weight per (series, model), inverse to its MAPE (at least 1 %).

    A model without a MAPE made no predictions and gets no weight.  Where every error is
    infinite, all weights are 0.
    """
    inverse = errors.filter(F.col("mape").isNotNull()).withColumn("_inverse", 1 / F.greatest("mape", F.lit(1.0)))
    return inverse.withColumn(
        "weight", F.coalesce(F.try_divide("_inverse", F.sum("_inverse").over(W.partitionBy("series"))), F.lit(0.0))
    ).select("series", "model", "mape", "weight")


def blend(predictions: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean of the predictions that a day has."""
    joined = predictions.join(weights.select("series", "model", "weight"), ["series", "model"])
    used = joined.filter("yhat is not null")
    total = F.sum(F.col("weight") * F.col("yhat"))
    # Weights are all zero where every model's error is infinite.
    return used.groupBy("series", "ds").agg(F.coalesce(
        F.try_divide(total, F.sum("weight")), total).alias("yhat"))


def align_predictions(test_days: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions on exactly the test days; leading gaps take the first prediction."""
    joined = test_days.select("series", "ds").join(predictions, ["series", "ds"], "left")
    ahead = W.partitionBy("series").orderBy("ds").rowsBetween(0, W.unboundedFollowing)
    return joined.withColumn("yhat", F.first("yhat", ignorenulls=True).over(ahead))


# ---- baseline and report ------------------------------------------------------------

def baseline_forecast(lines: DataFrame, horizon: int = DEFAULTS.forecast_horizon,
                      margin: float = 0.15, days: int = 30) -> DataFrame:
    """Mean of the last sales days, plus and minus a margin, for the days to come."""
    daily = daily_sales(lines.withColumn("sales_date", F.to_date("InvoiceDate")))
    level = daily.orderBy(F.desc("sales_date")).limit(days).agg(F.avg("daily_sales")).scalar()
    last = daily.agg(F.max("sales_date").alias("last"))
    return last.select(
        F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))).alias("ds"),
        level.alias("yhat"), (level * (1 - margin)).alias("yhat_lower"),
        (level * (1 + margin)).alias("yhat_upper"))


def forecast_report(forecast: DataFrame, lines: DataFrame) -> DataFrame:
    """Report names, and the last day the forecast knows of."""
    return forecast.select(
        F.col("ds").alias("ForecastDate"), F.col("yhat").alias("ForecastSales"),
        F.col("yhat_lower").alias("ForecastLower"), F.col("yhat_upper").alias("ForecastUpper"),
        lines.agg(F.to_date(F.max("InvoiceDate"))).scalar().alias("GeneratedFromDataThrough"))
