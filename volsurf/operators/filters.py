"""Row predicates and projections."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import finite, is_positive_finite, moneyness, year_fraction
from ..functions.symbols import parse_options
from ..schemas import GREEKS, MAX_DTE, MIN_CLOSE, MIN_DTE, SUPPORTED_OPTION, UNDERLYING

POSITIVE = ("close", "strike", "underlying_close", "time_to_expiry_years", "implied_volatility")
SOLVED = ("close", "strike", "underlying_close", "time_to_expiry_years", "dividend_yield", "risk_free_rate", "implied_volatility", *GREEKS)


def with_expiry(df: DataFrame) -> DataFrame:
    """Adds dte_days and time_to_expiry_years."""
    days = F.datediff("expiration_date", "trade_date")
    return df.withColumns({"dte_days": days, "time_to_expiry_years": year_fraction(days)})


def traded(volume: Column, close: Column) -> Column:
    """Whether a contract traded; a plain comparison of columns, so that it reaches the file."""
    return (volume > 0) & (close > 0) & ~F.isnan(close)


def eligible(raw: DataFrame, min_dte: int = MIN_DTE, max_dte: int = MAX_DTE, only: str | None = None) -> DataFrame:
    """Raw day rows to parsed contracts of supported underlyings that expire in range and traded.

    ``only`` keeps one underlying, for debugging runs.  Volume and close are
    filtered in the scan; of the symbol one regular expression decides, and the
    expiry is cut out of it.
    """
    return supported(raw.filter(traded(F.col("volume"), F.col("close"))), min_dte, max_dte, only)


def supported(raw: DataFrame, min_dte: int = MIN_DTE, max_dte: int = MAX_DTE, only: str | None = None) -> DataFrame:
    """The part of ``eligible`` that the ticker decides."""
    text = F.upper(F.trim("ticker"))
    parses = text.rlike(SUPPORTED_OPTION if only is None else SUPPORTED_OPTION.replace(UNDERLYING, re.escape(only)))
    days = F.datediff(F.try_to_date(F.substring(text, -15, 6), "yyMMdd"), "trade_date")
    return with_expiry(parse_options(raw.filter(parses & days.between(min_dte, max_dte))))


def strike_eligible(df: DataFrame) -> DataFrame:
    """Contracts that own-strike Greeks can be computed for: numbers present, positive, and solved."""
    present = F.lit(True)
    for c in (*POSITIVE, "risk_free_rate"):
        present = present & F.coalesce(~F.isnan(F.col(c).cast("double")), F.lit(False))
    for c in POSITIVE:
        present = present & (F.col(c) > 0)
    if "iv_failure_reason" in df.columns:
        present = present & (F.lower(F.trim("iv_failure_reason")) == "ok")
    return df.filter(F.coalesce(present, F.lit(False)))


def surface_eligible(df: DataFrame) -> DataFrame:
    """Contracts of the surface, with moneyness: positive inputs, delta and gamma present, expiry in range."""
    ok = F.col("option_type").isin("call", "put") & F.col("trade_date").isNotNull() & F.col("underlying").isNotNull()
    for c in ("strike", "underlying_close", "implied_volatility"):
        ok = ok & is_positive_finite(F.col(c))
    ok = ok & (F.col("dte_days") > 0) & finite(F.col("delta")).isNotNull() & finite(F.col("gamma")).isNotNull()
    kept = df.filter(ok & F.col("dte_days").between(MIN_DTE, MAX_DTE))
    return kept.withColumn("moneyness", moneyness(F.col("strike"), F.col("underlying_close")))


def is_sound(columns: tuple[str, ...] = SOLVED) -> Column:
    """Finite in every numeric column, and positive where prices, times and volatilities must be."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & finite(F.col(c)).isNotNull()
    for c in (*POSITIVE,):
        ok = ok & (F.col(c) > 0)
    return F.coalesce(ok, F.lit(False))


def missing_dte(df: DataFrame, low: int | None, high: int | None, target: int) -> DataFrame:
    """Rows outside the range that an existing shard covers: below its least, or above its largest if the target lies beyond."""
    if low is None or high is None:
        return df
    below = F.col("dte_days") < low
    return df.filter(below | (F.col("dte_days") > high)) if target > MAX_DTE else df.filter(below)


def uncovered(df: DataFrame, existing: DataFrame, min_dte: int = MIN_DTE, max_dte: int = MAX_DTE) -> DataFrame:
    """Rows that each day's existing shard doesn't cover: expiries below its least one (below MIN_DTE for a wider range), and above its largest for a target beyond MAX_DTE.

    Days without an existing row are wanted whole.
    """
    have = existing.filter("dte_days is not null").groupBy("trade_date").agg(F.min("dte_days").alias("_low"), F.max("dte_days").alias("_high"))
    rows = df.filter(F.col("dte_days").between(min_dte, max_dte)).join(have, "trade_date", "left")
    below = F.col("dte_days") < (F.lit(MIN_DTE) if min_dte < MIN_DTE else F.col("_low"))
    wanted = F.col("_low").isNull() | below
    if max_dte > MAX_DTE:
        wanted = wanted | (F.col("dte_days") > F.col("_high"))
    return rows.filter(wanted).drop("_low", "_high")


def dte_bounds(df: DataFrame) -> DataFrame:
    """(trade_date, low, high): the expiries that each day's rows span."""
    return df.groupBy("trade_date").agg(F.min("dte_days").alias("low"), F.max("dte_days").alias("high"))


def close_floor(df: DataFrame, close: str = "close") -> DataFrame:
    return df.filter(F.expr(f"try_cast(`{close}` AS double)") > MIN_CLOSE)


def valid_dates(df: DataFrame, column: str = "trade_date") -> DataFrame:
    """Rows with a readable date, written as ISO text again."""
    text = F.col(column).cast("string")
    day = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "M/d/yyyy"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date"))
    return df.withColumn(column, F.date_format(day, "yyyy-MM-dd")).filter(F.col(column).isNotNull())


def completed_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order: absent ones null, infinite doubles null."""
    kinds = dict(df.dtypes)
    pick = {c: (finite(F.col(c)) if kinds.get(c) == "double" else F.col(c)) if c in kinds else F.lit(None).cast("double") for c in columns}
    return df.select(*(v.alias(k) for k, v in pick.items()))


def present_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(c for c in columns if c in df.columns))
