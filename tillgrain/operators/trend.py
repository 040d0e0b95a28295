"""Trend with few changes and seasonality, for one series at a time.

The trend is a line whose slope may change at candidate days in the first 80 % of the series.  Changes
have a Laplace prior, seasonal terms a normal one; the most likely values follow by coordinate
descent, which sets most changes to exactly zero.  Intervals come from simulated futures in which
the slope goes on to change as often and as much as it did.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGES = 25              # candidate days, at most one for each 20 known days
CHANGE_RANGE = 0.8        # share of the days before which changes may be
PERIODS = ((365.25, 10), (7.0, 3))     # days and order of the seasons
CHANGE_SCALE = 0.05       # of the Laplace prior of a change of slope
SEASON_SCALE = 10.0       # deviation of the normal prior of a seasonal term
SWEEPS, CLOSE = 2000, 1e-9
SIMULATIONS, SHARE = 500, 0.8


def design(days: np.ndarray, start: float, span: float, knots: np.ndarray) -> np.ndarray:
    """Columns: level, slope, a hinge per candidate, seasonal waves.

    Days that cover less than a period cannot tell its waves from the trend, so there are none.
    """
    t = (days - start) / span
    columns = [np.ones_like(t), t, *(np.maximum(t - k, 0.0) for k in knots)]
    for period, order in PERIODS:
        for i in range(1, order + 1 if span >= period else 1):
            columns += [np.sin(2 * np.pi * i * days / period), np.cos(2 * np.pi * i * days / period)]
    return np.column_stack(columns)


def descend(x: np.ndarray, y: np.ndarray, lasso: np.ndarray, ridge: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Minimises |y - x b|^2 / 2 + sum(lasso |b|) + sum(ridge b^2) / 2, one coefficient after another.

    Coefficients without a lasso penalty are solved together in every sweep, as they are highly correlated.
    """
    gram, target = x.T @ x, x.T @ y
    smooth, sparse = np.flatnonzero(lasso == 0), np.flatnonzero(lasso > 0)
    block = gram[np.ix_(smooth, smooth)] + np.diag(ridge[smooth] + 1e-9)
    inverse = np.linalg.inv(block)
    beta = beta.copy()
    # The smooth part follows from the sparse one, so it can be taken out of the problem.
    cross = gram[np.ix_(smooth, sparse)]
    reduced = gram[np.ix_(sparse, sparse)] - cross.T @ inverse @ cross
    wanted = target[sparse] - cross.T @ inverse @ target[smooth]
    b = beta[sparse]
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(sparse)):
            bend = reduced[j, j] + ridge[sparse[j]]
            if bend <= 1e-12:
                continue
            pull = wanted[j] - reduced[j] @ b + reduced[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - lasso[sparse[j]], 0.0) / bend
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved < CLOSE:
            break
    beta[sparse] = b
    beta[smooth] = inverse @ (target[smooth] - cross @ b)
    return beta


class Trend:
    """One fitted series."""

    def __init__(self, days: np.ndarray, y: np.ndarray, change_scale: float = CHANGE_SCALE):
        self.start, self.span = days.min(), max(days.max() - days.min(), 1.0)
        self.size = max(np.abs(y).max(), 1e-9)
        n = int(min(CHANGES, max(0, len(days) // 20)))
        self.knots = np.linspace(0, CHANGE_RANGE, n + 1)[1:] if n else np.empty(0)
        x, scaled = design(days, self.start, self.span, self.knots), y / self.size
        self.changes = slice(2, 2 + n)
        self.beta = np.zeros(x.shape[1])
        noise = max(float(np.std(np.diff(scaled))) / 2 ** 0.5 if len(scaled) > 2 else 0.0, 1e-4)
        for _ in range(3):                               # the noise follows from the fit, and the reverse
            lasso, ridge = np.zeros(len(self.beta)), np.full(len(self.beta), (noise / SEASON_SCALE) ** 2)
            lasso[self.changes] = noise ** 2 / change_scale
            ridge[:2 + n] = 0.0
            self.beta = descend(x, scaled, lasso, ridge, self.beta)
            noise = max(float(np.std(scaled - x @ self.beta)), 1e-4)
        self.lasso, self.ridge, self.noise = lasso, ridge, noise

    def predict(self, days: np.ndarray) -> np.ndarray:
        return design(days, self.start, self.span, self.knots) @ self.beta * self.size

    def interval(self, days: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """The middle SHARE of simulated values around the prediction.

        After the last known day slopes change at the rate of the candidates, by the mean size of
        the changes found.
        """
        draw = np.random.default_rng(seed)
        ahead = np.maximum(days - (self.start + self.span), 0).astype(int)
        reach = int(ahead.max(initial=0))
        change = np.abs(self.beta[self.changes]).mean() if len(self.knots) else 0.0
        rate = len(self.knots) / (CHANGE_RANGE * self.span)
        drift = np.zeros((SIMULATIONS, reach + 1))
        if reach and change > 0:
            happens = draw.random((SIMULATIONS, reach)) < min(1.0, rate)
            slopes = np.cumsum(happens * draw.laplace(0, change, (SIMULATIONS, reach)), axis=1) / self.span
            drift[:, 1:] = np.cumsum(slopes, axis=1)
        made = drift[:, ahead] + draw.normal(0, self.noise, (SIMULATIONS, len(days)))
        low, high = np.quantile(made, [(1 - SHARE) / 2, (1 + SHARE) / 2], axis=0) if len(days) else (made, made)
        middle = self.predict(days)
        return middle + np.minimum(low, 0) * self.size, middle + np.maximum(high, 0) * self.size


def fit_and_predict(pdf: pd.DataFrame) -> pd.DataFrame:
    """Fit a series on its rows with y; (series, ds, yhat, yhat_lower, yhat_upper) of the others."""
    pdf = pdf.sort_values("ds")
    days = pd.to_datetime(pdf["ds"]).to_numpy().astype("datetime64[D]").astype(float)
    known = pdf["y"].notna().to_numpy()
    out = pdf.loc[~known, ["series", "ds"]].copy()
    if not known.any():
        return out.assign(yhat=np.nan, yhat_lower=np.nan, yhat_upper=np.nan)
    model = Trend(days[known], pdf["y"].to_numpy(float)[known])
    low, high = model.interval(days[~known], zlib.crc32(str(pdf["series"].iloc[0]).encode()))
    return out.assign(yhat=model.predict(days[~known]), yhat_lower=low, yhat_upper=high)


def fitted_row(pdf: pd.DataFrame) -> pd.DataFrame:
    """What a fitted series needs to predict, as one row."""
    pdf = pdf[pdf["y"].notna()].sort_values("ds")
    names = ["series", "start", "span", "size", "noise", "knots", "beta"]
    if not len(pdf):
        return pd.DataFrame([], columns=names)
    days = pd.to_datetime(pdf["ds"]).to_numpy().astype("datetime64[D]").astype(float)
    m = Trend(days, pdf["y"].to_numpy(float))
    return pd.DataFrame([(pdf["series"].iloc[0], m.start, m.span, m.size, m.noise, m.knots.tolist(), m.beta.tolist())],
                        columns=names)


def predict_row(model: pd.DataFrame, days: pd.DataFrame) -> pd.DataFrame:
    """Predictions of the days of a series by its stored row; null without one."""
    out = days[["series", "ds"]].sort_values("ds")
    if not len(model) or not len(out):
        return out.assign(yhat=np.nan, yhat_lower=np.nan, yhat_upper=np.nan)
    row, known = model.iloc[0], Trend.__new__(Trend)
    known.start, known.span, known.size, known.noise = (row[c] for c in ("start", "span", "size", "noise"))
    known.knots, known.beta = np.array(row["knots"]), np.array(row["beta"])
    known.changes = slice(2, 2 + len(known.knots))
    at = pd.to_datetime(out["ds"]).to_numpy().astype("datetime64[D]").astype(float)
    low, high = known.interval(at, zlib.crc32(str(row["series"]).encode()))
    return out.assign(yhat=known.predict(at), yhat_lower=low, yhat_upper=high)
