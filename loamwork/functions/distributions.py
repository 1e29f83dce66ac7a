"""Student t and F distributions, in numpy over whole batches of rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def beta_regularized(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction (Lentz's method), for arrays of equal length."""
    a, b, x = (np.array(v, dtype="float64", ndmin=1) for v in (a, b, x))
    mirrored = x > (a + 1.0) / (a + b + 2.0)
    a, b, x = np.where(mirrored, b, a), np.where(mirrored, a, b), np.where(mirrored, 1.0 - x, x)
    value = np.where(np.isnan(a + b + x), np.nan, 0.0)
    inside = np.flatnonzero(x > 0.0)
    if inside.size:
        value[inside] = _fraction(a[inside], b[inside], x[inside])
    return np.where(mirrored, 1.0 - value, value)


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the beta function, once per pair of parameters."""
    pairs, place = np.unique(np.stack([a, b]), axis=1, return_inverse=True)
    logs = [math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q) for p, q in pairs.T.tolist()]
    return np.array(logs)[place.reshape(-1)]


def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The function for 0 < x <= (a + 1) / (a + b + 2). Places leave the loop as they converge."""
    front = np.exp(a * np.log(x) + b * np.log1p(-x) - _log_beta(a, b)) / a
    tiny = 1e-300
    c, d = np.ones_like(x), 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) > tiny, d, tiny)
    value, out, live = d.copy(), np.empty_like(x), np.arange(x.size)
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = np.ones_like(x)
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) > tiny, d, tiny)
            c = 1.0 + term / c
            c = np.where(np.abs(c) > tiny, c, tiny)
            change = c * d
            value = value * change
        open_ = np.abs(change - 1.0) >= 1e-15
        out[live[~open_]] = value[~open_]
        if not open_.any():
            live = live[open_]
            break
        live, a, b, x, c, d, value = (v[open_] for v in (live, a, b, x, c, d, value))
    out[live] = value[: live.size]
    return front * out


def t_cdf_values(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    tail = 0.5 * beta_regularized(df / 2.0, np.full_like(df, 0.5), df / (df + t * t))
    return np.where(t > 0, 1.0 - tail, tail)


def f_cdf_values(f: np.ndarray, df1: np.ndarray, df2: np.ndarray) -> np.ndarray:
    above = np.where(f > 0, f, 0.0)
    return beta_regularized(df1 / 2.0, df2 / 2.0, df1 * above / (df1 * above + df2))


def t_cdf_value(t: float, df: float) -> float:
    return float(t_cdf_values(np.array([float(t)]), np.array([float(df)]))[0])


def f_cdf_value(f: float, df1: float, df2: float) -> float:
    return float(f_cdf_values(np.array([float(f)]), np.array([float(df1)]), np.array([float(df2)]))[0])


def t_ppf_value(p: float, df: float) -> float:
    """Quantile by bisection."""
    low, high = -1.0, 1.0
    while t_cdf_value(low, df) > p:
        low *= 2
    while t_cdf_value(high, df) < p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if t_cdf_value(middle, df) < p:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _apply(function, *series: pd.Series) -> pd.Series:
    rows = zip(*series)
    return pd.Series([None if any(pd.isna(v) for v in row) else function(*map(float, row)) for row in rows], dtype="float64")


def _arrays(function, *series: pd.Series) -> pd.Series:
    """``function`` once per distinct row of a batch; rows with a missing value give none."""
    rows = np.stack([s.to_numpy(dtype="float64", na_value=np.nan) for s in series])
    known = ~np.isnan(rows).any(axis=0)
    found = np.full(rows.shape[1], np.nan)
    if known.any():
        distinct, place = np.unique(rows[:, known], axis=1, return_inverse=True)
        with np.errstate(invalid="ignore", divide="ignore"):
            found[known] = function(*distinct)[place.reshape(-1)]
    return pd.Series(found)


@F.pandas_udf(DoubleType())
def t_cdf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _arrays(t_cdf_values, t, df)


@F.pandas_udf(DoubleType())
def t_ppf(p: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(t_ppf_value, p, df)


@F.pandas_udf(DoubleType())
def f_cdf(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _arrays(f_cdf_values, f, df1, df2)
