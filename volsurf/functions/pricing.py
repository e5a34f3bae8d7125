"""Pricing kernels as Arrow UDFs, behind native null guards and cheap native checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..schemas import ARBITRAGE_TOLERANCE, GREEKS
from . import kernels

_GREEKS = StructType([StructField(g, DoubleType()) for g in GREEKS])


def _once(kernel, *inputs: np.ndarray) -> np.ndarray:
    """The kernel's results by row; equal rows of a batch are priced once."""
    _, first, back = np.unique(np.stack([x.astype(float) for x in inputs], axis=1), axis=0, return_index=True, return_inverse=True)
    return kernel(*(x[first] for x in inputs))[..., back.ravel()]


@F.pandas_udf(DoubleType())
def _implied(price: pd.Series, s: pd.Series, k: pd.Series, t: pd.Series, r: pd.Series, call: pd.Series, q: pd.Series) -> pd.Series:
    todo = price.notna().to_numpy()
    out = np.full(len(price), np.nan)
    out[todo] = _once(kernels.implied_vol, *(x[todo].to_numpy() for x in (price, s, k, t, r, call, q)))
    return pd.Series(out).where(~np.isnan(out), None)


@F.pandas_udf(DoubleType())
def american_price(s: pd.Series, k: pd.Series, t: pd.Series, r: pd.Series, v: pd.Series, call: pd.Series, q: pd.Series) -> pd.Series:
    """The tree's price; null where an input is."""
    todo = (s.notna() & k.notna() & t.notna() & r.notna() & v.notna() & call.notna() & q.notna()).to_numpy()
    out = np.full(len(s), np.nan)
    if todo.any():
        out[todo] = kernels.american(*(x[todo].to_numpy(float) for x in (s, k, t, r, v)), call[todo].to_numpy(bool), q[todo].to_numpy(float))
    return pd.Series(out).where(todo, None)


_TREE = StructType([StructField(c, DoubleType()) for c in ("steps", "up", "down", "p", "discount")])


@F.pandas_udf(_TREE)
def tree_parameters(t: pd.Series, r: pd.Series, v: pd.Series, q: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(kernels.tree_parameters(*(x.to_numpy() for x in (t, r, v, q))))


@F.pandas_udf(DoubleType())
def single_tree_price(s: pd.Series, k: pd.Series, t: pd.Series, r: pd.Series, v: pd.Series, call: pd.Series, q: pd.Series) -> pd.Series:
    return pd.Series(kernels.single_tree(*(x.to_numpy() for x in (s, k, t, r, v, call, q))))


def _frame(values: np.ndarray) -> pd.DataFrame:
    """NaN becomes null on the way to Arrow."""
    return pd.DataFrame(dict(zip(GREEKS, values, strict=True)))


@F.pandas_udf(_GREEKS)
def _atm(v: pd.Series, s: pd.Series, t: pd.Series, r: pd.Series, call: pd.Series, q: pd.Series) -> pd.DataFrame:
    todo = (v.notna() & s.notna() & t.notna() & r.notna()).to_numpy()
    out = np.full((4, len(v)), np.nan)
    out[:, todo] = _once(kernels.atm_greeks, *(x[todo].to_numpy() for x in (v, s, t, r, call, q)))
    return _frame(out)


@F.pandas_udf(_GREEKS)
def _own(v: pd.Series, s: pd.Series, k: pd.Series, t: pd.Series, r: pd.Series, call: pd.Series, q: pd.Series) -> pd.DataFrame:
    return _frame(_once(kernels.strike_greeks, *(x.to_numpy(float) if x.dtype != bool else x.to_numpy() for x in (v, s, k, t, r, call, q))))


# a filter on a result must not be pushed below it, as that would run the kernel twice
_implied, _atm, _own = (f.asNondeterministic() for f in (_implied, _atm, _own))


def _nonnegative(q: Column) -> Column:
    return F.greatest(F.coalesce(F.nanvl(q, F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def early_reason(price: str = "close") -> Column:
    """Why a contract can't be solved, as far as cheap checks tell, in their order; null if it may be."""
    s, k, t, r, p = (F.col(c) for c in ("underlying_close", "strike", "time_to_expiry_years", "risk_free_rate", price))
    missing = lambda c: c.isNull() | F.isnan(c)
    call = F.col("option_type") == "call"
    inner = F.greatest(F.when(call, s - k).otherwise(k - s), F.lit(0.0))
    outer = F.when(call, s).otherwise(k)
    return (
        F.when(missing(p) | missing(s) | missing(k), "missing_input")
        .when(missing(t) | (t <= 0), "invalid_expiry")
        .when(missing(r), "missing_risk_free_rate")
        .when((p < inner - ARBITRAGE_TOLERANCE) | (p > outer + ARBITRAGE_TOLERANCE), "arbitrage_bounds")
    )


def with_implied_vol(df: DataFrame, price: str = "close") -> DataFrame:
    """Adds implied_volatility and iv_failure_reason.  Contracts that fail a cheap check never reach Python's solver."""
    early = df.withColumn("_early", early_reason(price))
    asked = F.when(F.col("_early").isNull(), F.col(price))
    call = F.coalesce(F.col("option_type") == "call", F.lit(False))
    iv = _implied(asked, "underlying_close", "strike", "time_to_expiry_years", "risk_free_rate", call, _nonnegative(F.col("dividend_yield")))
    solved = early.withColumn("implied_volatility", iv)
    reason = F.coalesce("_early", F.when(F.col("implied_volatility").isNull(), "no_root_in_range").otherwise("ok"))
    return solved.withColumn("iv_failure_reason", reason).drop("_early")


def with_atm_greeks(df: DataFrame, iv: str = "implied_volatility") -> DataFrame:
    """Adds atm_delta, atm_gamma, atm_theta and atm_vega of the option struck at the spot."""
    call = F.coalesce(F.col("option_type") == "call", F.lit(False))
    g = df.withColumn("_g", _atm(iv, "underlying_close", "time_to_expiry_years", "risk_free_rate", call, _nonnegative(F.col("dividend_yield"))))
    return g.select(*df.columns, *(F.col(f"_g.{x}").alias(f"atm_{x}") for x in GREEKS))


def with_strike_greeks(df: DataFrame) -> DataFrame:
    """Adds delta, gamma, theta and vega at each contract's own strike; stale columns of these names are replaced."""
    df = df.drop(*GREEKS, *(f"atm_{g}" for g in GREEKS))
    call = F.coalesce(F.col("option_type") == "call", F.lit(False))
    g = df.withColumn("_g", _own("implied_volatility", "underlying_close", "strike", "time_to_expiry_years", "risk_free_rate", call, _nonnegative(F.col("dividend_yield"))))
    return g.select(*df.columns, *(F.col(f"_g.{x}").alias(x) for x in GREEKS))
