"""Scalar numerics as native columns: safe division, split factors, buckets, Black-Scholes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DIVIDE_EPSILON, DTE_BUCKETS, SPLIT_FACTORS, SPLIT_TOLERANCE, YEAR_DAYS


def finite(c: Column) -> Column:
    """The value, or null for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def is_missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c.cast("double"))


def is_positive_finite(c: Column) -> Column:
    return F.coalesce(finite(c) > 0, F.lit(False))


def year_fraction(days: Column) -> Column:
    return days / F.lit(YEAR_DAYS)


def moneyness(strike: Column, spot: Column) -> Column:
    return strike / spot


def safe_divide(n: Column, d: Column) -> Column:
    return F.when(F.abs(d) > DIVIDE_EPSILON, n / d)


def nan_mean(*values: Column) -> Column:
    """Mean of the values that are not null; null without any."""
    kept = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in values), F.lit(0))
    return F.when(kept > 0, sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0)) / kept)


def finished_yield(dividends: Column, close: Column) -> Column:
    """Dividends over close; null, NaN and infinite become 0, and so do negative values."""
    return F.greatest(F.coalesce(finite(F.try_divide(dividends, close)), F.lit(0.0)), F.lit(0.0))


def split_factor(ratio: Column) -> Column:
    """The common split factor nearest to a price ratio, within SPLIT_TOLERANCE of it; inverses only below 1."""
    up = [F.lit(f) for f in SPLIT_FACTORS]
    down = [F.lit(1.0 / f) for f in SPLIT_FACTORS]

    def nearest(factors: list[Column]) -> Column:
        gaps = F.array(*(F.struct(F.abs(ratio / f - 1).alias("gap"), F.lit(k).alias("k"), f.alias("factor")) for k, f in enumerate(factors)))
        best = F.array_min(gaps)
        return F.when(best["gap"] <= SPLIT_TOLERANCE, best["factor"])

    return F.when(finite(ratio) > 0, F.when(ratio < 1, nearest(up + down)).otherwise(nearest(up)))


def dte_bucket(dte: Column) -> Column:
    out = None
    for name, (low, high) in DTE_BUCKETS.items():
        hit = dte.between(low, high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def erf(x: Column, terms: int = 160) -> Column:
    """erf by its positive series sgn(x)·exp(-x²)·Σ |x|^(2n+1)/Γ(n+3/2), in Horner's form; within 1e-15 for |x| <= 6."""
    a = F.least(F.abs(x), F.lit(6.0))
    scale = F.array(*(F.lit(1.0 / (n + 1.5)) for n in range(terms - 1, -1, -1)))
    # each term is the one before times x²/(n+3/2)
    series = F.aggregate(scale, F.lit(1.0), lambda acc, s: 1 + acc * s * a * a)
    return F.signum(x) * F.exp(-a * a) * a * series / math.gamma(1.5)


def norm_cdf(x: Column) -> Column:
    return (1 + erf(x / math.sqrt(2))) / 2


def norm_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def _d1(s: Column, k: Column, t: Column, r: Column, v: Column, q: Column) -> Column:
    return (F.log(s / k) + (r - q + v * v / 2) * t) / (v * F.sqrt(t))


def bs_price(s: Column, k: Column, t: Column, r: Column, v: Column, is_call: Column, q: Column) -> Column:
    """Black-Scholes price with a yield; 0 for non-positive inputs, intrinsic value without time."""
    d1 = _d1(s, k, t, r, v, q)
    d2 = d1 - v * F.sqrt(t)
    call = s * F.exp(-q * t) * norm_cdf(d1) - k * F.exp(-r * t) * norm_cdf(d2)
    put = k * F.exp(-r * t) * norm_cdf(-d2) - s * F.exp(-q * t) * norm_cdf(-d1)
    now = F.greatest(F.when(is_call, s - k).otherwise(k - s), F.lit(0.0))
    return F.when((s <= 0) | (k <= 0) | (v <= 0), F.lit(0.0)).when(t <= 0, now).when(is_call, call).otherwise(put)


def bs_greeks(s: Column, k: Column, t: Column, r: Column, v: Column, is_call: Column, q: Column) -> dict[str, Column]:
    """delta, gamma, theta per year, vega per 1.00 of volatility; zeros for non-positive inputs."""
    d1 = _d1(s, k, t, r, v, q)
    d2 = d1 - v * F.sqrt(t)
    dq, dr, sign = F.exp(-q * t), F.exp(-r * t), F.when(is_call, 1.0).otherwise(-1.0)
    decay = -s * dq * norm_pdf(d1) * v / (2 * F.sqrt(t))
    out = {
        "delta": sign * dq * norm_cdf(sign * d1),
        "gamma": dq * norm_pdf(d1) / (s * v * F.sqrt(t)),
        "theta": decay - sign * r * k * dr * norm_cdf(sign * d2) + sign * q * s * dq * norm_cdf(sign * d1),
        "vega": s * dq * norm_pdf(d1) * F.sqrt(t),
    }
    bad = (s <= 0) | (k <= 0) | (v <= 0) | (t <= 0)
    return {g: F.when(bad, F.lit(0.0)).otherwise(c) for g, c in out.items()}
