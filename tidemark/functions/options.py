"""Option values and sensitivities, vectorised in numpy behind Arrow."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

VOL_LOW, VOL_HIGH, VOL_TOLERANCE = 1e-3, 5.0, 1e-6
DAYS = 365.0


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution, to about 1e-15, by the erfc fraction and series of Cody's ranges."""
    return 0.5 * (1.0 + _erf(x / np.sqrt(2.0)))


def _erf(x: np.ndarray) -> np.ndarray:
    """erf by series below 2.5 and a continued fraction above, both vectorised."""
    a = np.minimum(np.abs(x), 6.5)
    small = a < 2.5
    out = np.empty_like(a)
    s = a[small]
    term = s.copy()
    total = s.copy()
    for n in range(1, 46):
        term *= -s * s / n
        total += term / (2 * n + 1)
    out[small] = 2 / np.sqrt(np.pi) * total
    b = a[~small]
    fraction = np.zeros_like(b)
    for n in range(60, 0, -1):
        fraction = n / 2 / (b + fraction)
    out[~small] = 1 - np.exp(-b * b) / np.sqrt(np.pi) / (b + fraction)
    return np.sign(x) * out


def _d1_d2(s, k, t, r, q, v):
    d1 = (np.log(s / k) + (r - q + v * v / 2) * t) / (v * np.sqrt(t))
    return d1, d1 - v * np.sqrt(t)


def price(s, k, t, r, q, v, call):
    """Black-Scholes-Merton with a continuous dividend yield; arrays or numbers."""
    s, k, t, r, q, v, call = np.broadcast_arrays(*[np.asarray(x, float) for x in (s, k, t, r, q, v)], np.asarray(call, bool))
    d1, d2 = _d1_d2(s, k, t, r, q, v)
    sign = np.where(call, 1.0, -1.0)
    return sign * (s * np.exp(-q * t) * normal_cdf(sign * d1) - k * np.exp(-r * t) * normal_cdf(sign * d2))


def greeks(s, k, t, r, q, v, call) -> dict[str, np.ndarray]:
    """Per unit: delta and gamma; per volatility point: vega; per calendar day: theta; per 1 %: rho."""
    s, k, t, r, q, v, call = np.broadcast_arrays(*[np.asarray(x, float) for x in (s, k, t, r, q, v)], np.asarray(call, bool))
    d1, d2 = _d1_d2(s, k, t, r, q, v)
    sign = np.where(call, 1.0, -1.0)
    density = np.exp(-d1 * d1 / 2) / np.sqrt(2 * np.pi)
    carry, discount = np.exp(-q * t), np.exp(-r * t)
    return {
        "delta": sign * carry * normal_cdf(sign * d1),
        "gamma": carry * density / (s * v * np.sqrt(t)),
        "vega": s * carry * density * np.sqrt(t) / 100,
        "theta": (-s * carry * density * v / (2 * np.sqrt(t)) - sign * r * k * discount * normal_cdf(sign * d2) + sign * q * s * carry * normal_cdf(sign * d1)) / DAYS,
        "rho": sign * k * t * discount * normal_cdf(sign * d2) / 100,
    }


def implied_volatility(s, k, t, r, q, value, call) -> np.ndarray:
    """The volatility that gives ``value``, by bisection of all contracts at once; NaN without a sign change."""
    s, k, t, r, q, value, call = np.broadcast_arrays(*[np.asarray(x, float) for x in (s, k, t, r, q, value)], np.asarray(call, bool))
    low, high = np.full(s.shape, VOL_LOW), np.full(s.shape, VOL_HIGH)
    with np.errstate(all="ignore"):
        known = (price(s, k, t, r, q, low, call) <= value) & (price(s, k, t, r, q, high, call) >= value)
        for _ in range(int(np.ceil(np.log2((VOL_HIGH - VOL_LOW) / VOL_TOLERANCE)))):
            middle = (low + high) / 2
            above = price(s, k, t, r, q, middle, call) > value
            high, low = np.where(above, middle, high), np.where(above, low, middle)
    return np.where(known, (low + high) / 2, np.nan)


def with_iv_and_greeks(df: DataFrame, spot: str, strike: str, years: str, rate: str, dividend_yield: str, value: str, is_call: str) -> DataFrame:
    """``df`` with iv, delta, gamma, vega, theta and rho; null where no volatility gives the value."""

    @F.pandas_udf("iv double, delta double, gamma double, vega double, theta double, rho double")
    def solve(s: pd.Series, k: pd.Series, t: pd.Series, r: pd.Series, q: pd.Series, v: pd.Series, c: pd.Series) -> pd.DataFrame:
        args = [x.to_numpy(float) for x in (s, k, t, r, q)]
        call = c.fillna(True).to_numpy(bool)
        iv = implied_volatility(*args, v.to_numpy(float), call)
        with np.errstate(all="ignore"):
            out = pd.DataFrame({"iv": iv, **greeks(*args, iv, call)})
        return out.astype(object).where(np.isfinite(out), None)

    columns: list[Column] = [F.col(c) for c in (spot, strike, years, rate, dividend_yield, value, is_call)]
    return df.withColumn("_g", solve(*columns)).select("*", "_g.*").drop("_g")
