"""Stock histories: split-safe prices, dividend yields, fetch planning, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import business_days
from ..functions.numeric import finished_yield
from ..operators.filters import close_floor
from ..operators.joins import keep_last


def future_split_factor(symbol: str = "symbol"):
    """Product of the split ratios strictly after a row; a ratio that is not positive counts as 1."""
    after = Window.partitionBy(symbol).orderBy("trade_date").rowsBetween(1, Window.unboundedFollowing)
    return F.coalesce(F.product(F.when(F.coalesce(F.col("splits"), F.lit(0.0)) > 0, F.col("splits")).otherwise(1.0)).over(after), F.lit(1.0))


def trailing_dividends(symbol: str = "symbol"):
    """Dividends of the 365 days that end with a row's day; one paid 365 days before is out."""
    return F.sum(F.coalesce("dividends", F.lit(0.0))).over(Window.partitionBy(symbol).orderBy(F.unix_date("trade_date")).rangeBetween(-364, 0))


#: Prices besides the close that splits change.
PRICES = ("open", "high", "low")


def unsplit(vendor: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Close, and open, high and low where there are any, times the product of all later splits."""
    columns = [c for c in ("close", *PRICES) if c in vendor.columns]
    rows = vendor.withColumn("_factor", future_split_factor(symbol))
    return rows.withColumns({c: F.col(c) * F.col("_factor") for c in columns}).drop("_factor")


def normalized(vendor: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Split-adjusted vendor closes to traded ones, with the trailing yield; low prices go last, so their dividends count.

    One window partition per symbol: a few thousand rows of its own history.
    """
    kept = vendor.filter("trade_date is not null and close is not null")
    out = unsplit(kept, symbol).withColumn("dividend_yield", finished_yield(trailing_dividends(symbol), F.col("close")))
    return close_floor(out)


def normalized_same_day(vendor: DataFrame, symbol: str = "symbol") -> DataFrame:
    """The same, but with the day's own dividend in place of the trailing sum."""
    kept = vendor.filter("trade_date is not null and close is not null").withColumn("adj_close", F.col("close"))
    out = unsplit(kept, symbol).withColumn("dividend_yield", finished_yield(F.col("dividends"), F.col("close")))
    return close_floor(out)


def backfilled_yields(prices: DataFrame, events: DataFrame) -> DataFrame:
    """Prices with yields from dividend events, which may fall on days without a price.

    Events join the price rows as rows of their own, so the trailing sum sees
    them all; then only price rows stay.
    """
    paid = events.groupBy("symbol", "trade_date").agg(F.sum("dividends").alias("dividends"))
    days = prices.drop("dividends", "dividend_yield").withColumn("_price", F.lit(True))
    both = days.join(paid, ["symbol", "trade_date"], "full_outer")
    summed = both.withColumn("_sum", trailing_dividends()).filter("_price")
    return summed.withColumns({"dividends": F.coalesce("dividends", F.lit(0.0)), "dividend_yield": finished_yield(F.col("_sum"), F.col("close"))}).drop("_sum", "_price")


def upserted(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """New rows over old ones by symbol and day."""
    return keep_last([old, new], keys or ["symbol", "trade_date"], ["trade_date"])


def bounds(stocks: DataFrame) -> DataFrame:
    """(symbol, first_day, last_day, has_yield): has_yield is whether all yields are present and not negative."""
    fine = F.coalesce(F.col("dividend_yield") >= 0, F.lit(False))
    return stocks.groupBy("symbol").agg(F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"), F.bool_and(fine).alias("has_yield"))


def covers(stocks: DataFrame, start: str, end: str) -> DataFrame:
    """(symbol) whose history reaches from ``start`` or earlier to ``end`` or later."""
    per = stocks.groupBy("symbol").agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b"))
    return per.filter((F.col("a") <= F.lit(start).cast("date")) & (F.col("b") >= F.lit(end).cast("date"))).select("symbol")


def rebuild_statuses(symbols: DataFrame, existing: DataFrame, fetched: DataFrame, failures: DataFrame, overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """(symbol, status, n) of a rebuild of all histories: exists, dry_run, failed, empty or saved.

    ``existing``: symbols that have a rebuilt history; ``fetched``: rows by
    symbol; ``failures``: symbols whose fetch failed.
    """
    counts = fetched.groupBy("symbol").agg(F.count("*").alias("n"))
    marked = lambda df, c: df.select("symbol", F.lit(True).alias(c)).distinct()
    rows = symbols.select("symbol").distinct().join(marked(existing, "_have"), "symbol", "left").join(marked(failures, "_bad"), "symbol", "left").join(counts, "symbol", "left")
    status = F.when(F.col("_have") & ~F.lit(overwrite), "exists").when(F.lit(dry_run), "dry_run").when(F.col("_bad"), "failed").when(F.col("n").isNull(), "empty").otherwise("saved")
    rows = rows.withColumn("status", status)
    return rows.select("symbol", "status", F.when(F.col("status") == "saved", F.col("n")).alias("n"))


def fetch_ranges(windows: DataFrame, start: str, end: str) -> DataFrame:
    """(symbol, range_start, range_end): the business days that all windows of a symbol span, clipped."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    clipped = windows.select("symbol", F.greatest("start_date", lo).alias("a"), F.least("end_date", hi).alias("b")).filter("a <= b")
    spans = clipped.groupBy("symbol").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    days = business_days(windows.sparkSession, start, end)
    first = F.broadcast(days.select(F.col("day").alias("a"), F.col("first_on_or_after").alias("range_start")))
    last = F.broadcast(days.select(F.col("day").alias("b"), F.col("last_on_or_before").alias("range_end")))
    return spans.join(first, "a").join(last, "b").filter("range_start <= range_end").select("symbol", "range_start", "range_end")


def fetch_plan(ranges: DataFrame, have: DataFrame, start: str, end: str, repair: bool = False) -> DataFrame:
    """(symbol, fetch_start, fetch_end, reason) of the days that a symbol's history lacks; complete symbols have no row.

    reason: full, tail, front or refetch.  With ``repair`` a late start is
    refetched whole instead of stitched at the front.
    """
    days = business_days(ranges.sparkSession, start, end)
    after = F.broadcast(days.select(F.date_sub("day", 1).alias("last_day"), F.col("first_on_or_after").alias("tail_start")))
    before = F.broadcast(days.select(F.date_add("day", 1).alias("first_day"), F.col("last_on_or_before").alias("front_end")))
    rows = ranges.join(have, "symbol", "left").join(after, "last_day", "left").join(before, "first_day", "left")
    a, b, lo, hi = (F.col(c) for c in ("first_day", "last_day", "range_start", "range_end"))
    none = a.isNull() | ~F.coalesce("has_yield", F.lit(False))
    reason = F.when(none, "full").when((a <= lo) & (b >= hi), "none").when(a <= lo, "tail")
    reason = (reason if repair else reason.when(b >= hi, "front")).otherwise("refetch")
    out = rows.withColumn("reason", reason)
    out = out.select("symbol", F.when(F.col("reason") == "tail", F.col("tail_start")).otherwise(lo).alias("fetch_start"), F.when(F.col("reason") == "front", F.col("front_end")).otherwise(hi).alias("fetch_end"), "reason")
    return out.filter("reason != 'none' and fetch_start <= fetch_end")
