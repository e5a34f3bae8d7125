"""Joins: latest-before (as-of), intervals, snapshot membership, keyed lookups with a rule for repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RATE_LOOKBACK_DAYS

def last_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the last in the order of ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, *(F.col(f"_r.{c}") for c in rest))


def one_per_day(stocks: DataFrame, columns: list[str]) -> DataFrame:
    """(symbol, trade_date, columns): the last row of each symbol's day by ``ordinal``; tables without one have their greatest row."""
    order = F.struct("ordinal", *columns) if "ordinal" in stocks.columns else F.struct(*columns)
    picked = stocks.groupBy("symbol", "trade_date").agg(F.max_by(F.struct(*columns), order).alias("_r"))
    return picked.select("symbol", "trade_date", *(F.col(f"_r.{c}") for c in columns))


def with_stock_data(contracts: DataFrame, stocks: DataFrame) -> DataFrame:
    """Adds underlying_close (null if the day is missing) and dividend_yield (then 0).

    Of a symbol's repeated day the last row counts (see ``one_per_day``), so
    contracts are never multiplied.
    """
    side = one_per_day(stocks, ["close", "dividend_yield"])
    side = side.select(F.col("symbol").alias("underlying"), "trade_date", F.col("close").alias("underlying_close"), F.greatest(F.coalesce(F.nanvl("dividend_yield", F.lit(0.0)), F.lit(0.0)), F.lit(0.0)).alias("_q"))
    joined = contracts.join(side, ["underlying", "trade_date"], "left")
    return joined.withColumn("dividend_yield", F.coalesce("_q", F.lit(0.0))).drop("_q")


def with_each_close(contracts: DataFrame, stocks: DataFrame) -> DataFrame:
    """Contracts met with every row of their underlying's day, as ``with_stock_data`` names the columns; those without one are left out."""
    q = F.greatest(F.coalesce(F.nanvl("dividend_yield", F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    side = stocks.select(F.col("symbol").alias("underlying"), "trade_date", F.col("close").alias("underlying_close"), q.alias("dividend_yield"))
    return contracts.join(side, ["underlying", "trade_date"])


def day_closes(stocks: DataFrame) -> DataFrame:
    """(underlying, trade_date, closes): the different closes of a symbol's day, in order."""
    return stocks.filter("close > 0").groupBy(F.col("symbol").alias("underlying"), "trade_date").agg(F.array_sort(F.collect_set("close")).alias("closes"))


def asof_rates(days: DataFrame, rates: DataFrame, lookback: int = RATE_LOOKBACK_DAYS) -> DataFrame:
    """(trade_date, risk_free_rate): the latest rate on or before each day.

    Rates older than ``lookback`` days before the first day don't count.  Both
    sides are a row per calendar day, so they meet in one small ordered window.
    """
    days = days.select("trade_date").distinct()
    first = days.agg(F.min("trade_date").alias("first"))
    known = rates.join(first, F.col("rate_date") >= F.date_sub("first", lookback)).select(F.col("rate_date").alias("day"), "rate", F.lit(None).cast("date").alias("trade_date"))
    both = known.unionByName(days.select(F.col("trade_date").alias("day"), F.lit(None).cast("double").alias("rate"), "trade_date"))
    order = Window.orderBy(F.col("day"), F.col("trade_date").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("risk_free_rate", F.last("rate", ignorenulls=True).over(order)).filter("trade_date is not null").select("trade_date", "risk_free_rate")


def with_rates(contracts: DataFrame, rates: DataFrame, strict: bool = True, days: DataFrame | None = None) -> DataFrame:
    """Adds risk_free_rate; with ``strict``, a day without any rate fails the job.

    The days come from ``days`` (the raw table, of which only the date is read),
    so that the contracts are computed once.
    """
    found = asof_rates(contracts if days is None else days, rates)
    if strict:
        message = F.concat(F.lit("no risk-free rate on or before "), F.col("trade_date").cast("string"))
        found = found.withColumn("risk_free_rate", F.coalesce("risk_free_rate", F.raise_error(message).cast("double")))
    # a row per trade date
    return contracts.drop("risk_free_rate").join(F.broadcast(found), "trade_date", "left")


def membership_windows(snapshots: DataFrame, start: str, end: str) -> DataFrame:
    """(symbol, start_date, end_date): each snapshot holds until the day before the next; touching intervals are merged."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    dates = snapshots.select("snapshot_date").distinct()
    # a row per snapshot
    spans = dates.withColumn("until", F.lead("snapshot_date").over(Window.orderBy("snapshot_date")))
    spans = spans.select("snapshot_date", F.greatest("snapshot_date", lo).alias("a"), F.least(F.coalesce(F.date_sub("until", 1), hi), hi).alias("b")).filter("a <= b")
    held = snapshots.select("snapshot_date", "symbol").distinct().join(F.broadcast(spans), "snapshot_date")
    by = Window.partitionBy("symbol").orderBy("a")
    marked = held.withColumn("new", F.coalesce(F.col("a") > F.date_add(F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1)), 1), F.lit(True)).cast("int"))
    island = marked.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy("symbol", "island").agg(F.min("a").alias("start_date"), F.max("b").alias("end_date")).drop("island")


def active_in_windows(df: DataFrame, windows: DataFrame, symbol: str = "underlying", day: str = "trade_date") -> DataFrame:
    """Rows whose symbol is a member on their day; both ends of a window count."""
    w = windows.select(F.col("symbol").alias("_s"), "start_date", "end_date")
    return df.join(w, (F.col(symbol) == F.col("_s")) & F.col(day).between(F.col("start_date"), F.col("end_date")), "left_semi")


def snapshot_of(days: DataFrame, snapshots: DataFrame, strict: bool = True) -> DataFrame:
    """(trade_date, snapshot_date): the latest snapshot on or before each day; with ``strict``, none is an error."""
    dates = snapshots.select(F.col("snapshot_date").alias("day")).distinct()
    days = days.select("trade_date").distinct()
    both = dates.select("day", F.lit(None).cast("date").alias("trade_date")).unionByName(days.select(F.col("trade_date").alias("day"), "trade_date"))
    order = Window.orderBy(F.col("day"), F.col("trade_date").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("trade_date").isNull(), F.col("day"))
    found = both.withColumn("snapshot_date", F.last(own, ignorenulls=True).over(order)).filter("trade_date is not null").select("trade_date", "snapshot_date")
    if strict:
        message = F.concat(F.lit("no snapshot on or before "), F.col("trade_date").cast("string"))
        found = found.withColumn("snapshot_date", F.coalesce("snapshot_date", F.raise_error(message).cast("date")))
    return found


def _memberships(snapshots: DataFrame) -> DataFrame:
    """(_s, _from, _until): each member of a snapshot, until the day of the next one."""
    dates = snapshots.select("snapshot_date").distinct()
    # a row per snapshot
    spans = dates.withColumn("_until", F.coalesce(F.lead("snapshot_date").over(Window.orderBy("snapshot_date")), F.lit("9999-12-31").cast("date")))
    return snapshots.select("snapshot_date", F.col("symbol").alias("_s")).distinct().join(F.broadcast(spans), "snapshot_date").withColumnRenamed("snapshot_date", "_from")


def _not_before_snapshots(df: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``df``; a day before the first snapshot fails the job."""
    first = snapshots.agg(F.min("snapshot_date")).first()[0]
    early = F.lit(True) if first is None else F.col("trade_date") < F.lit(first)
    message = F.concat(F.lit("no snapshot on or before "), F.col("trade_date").cast("string"))
    return df.filter(F.when(early, F.raise_error(message).cast("boolean")).otherwise(True))


def active_asof(df: DataFrame, snapshots: DataFrame, symbol: str = "underlying", strict: bool = True) -> DataFrame:
    """Rows whose symbol is in the latest snapshot on or before their day; with ``strict``, a day before the first is an error.

    A snapshot holds until the next one, so this is a join by symbol and
    interval: the rows are read once, and not for their days first.
    """
    if strict:
        df = _not_before_snapshots(df, snapshots)
    held = (F.col("trade_date") >= F.col("_from")) & (F.col("trade_date") < F.col("_until"))
    return df.join(_memberships(snapshots), (F.col(symbol) == F.col("_s")) & held, "left_semi")


def allowed(df: DataFrame, snapshots: DataFrame | None, requested: DataFrame | None, symbol: str = "underlying") -> DataFrame:
    """Rows whose symbol is active on its day and among the requested ones; either condition may be absent."""
    out = active_asof(df, snapshots, symbol) if snapshots is not None else df
    if requested is None:
        return out
    # lists of requested symbols are typed by hand
    return out.join(requested.select(F.col("symbol").alias("_s")).distinct(), F.col(symbol) == F.col("_s"), "left_semi")


def limited(snapshots: DataFrame, n: int) -> DataFrame:
    """Snapshots of the first n symbols, in their order, of all there are."""
    first = snapshots.select("symbol").distinct().orderBy("symbol").limit(n)
    # n rows, a number typed by hand
    return snapshots.join(F.broadcast(first), "symbol", "left_semi").select(*snapshots.columns)


def call_put_outer(contracts: DataFrame, values: list[str]) -> DataFrame:
    """Per stock and day: the mean of each value for calls and for puts, null where a side is absent.

    A table that lacks one side altogether is an error.
    """
    sides = {s: F.col("option_type") == s for s in ("call", "put")}
    out = contracts.filter("option_type in ('call', 'put')").groupBy("trade_date", "underlying").agg(
        *(F.avg(F.when(w, F.col(v))).alias(f"{v}_{s[0]}") for v in values for s, w in sides.items()), *(F.nullif(F.count_if(w), F.lit(0)).alias(f"n_{s}") for s, w in sides.items())
    )
    absent = contracts.agg(*(F.count_if(w).alias(s) for s, w in sides.items())).filter("call = 0 or put = 0")
    if not absent.isEmpty():
        raise ValueError("no calls or no puts at all")
    return out


def with_membership(df: DataFrame, snapshots: DataFrame, flag: str, symbol: str = "underlying", strict: bool = True) -> DataFrame:
    """``df`` with whether each row's symbol is in the latest snapshot on or before its day; no row is multiplied."""
    if strict:
        df = _not_before_snapshots(df, snapshots)
    held = (F.col("trade_date") >= F.col("_from")) & (F.col("trade_date") < F.col("_until"))
    out = df.join(_memberships(snapshots), (F.col(symbol) == F.col("_s")) & held, "left")
    return out.withColumn(flag, F.col("_s").isNotNull()).drop("_s", "_from", "_until")


def with_alias_close(df: DataFrame, stocks: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Adds the close of the symbol, or of its alias where the symbol has no history at all."""
    known = stocks.select("symbol").distinct()
    alias = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)) if aliases else F.create_map().cast("map<string,string>")
    named = df.join(known.withColumnRenamed("symbol", "_known"), F.col("underlying") == F.col("_known"), "left")
    named = named.withColumn("_s", F.coalesce("_known", alias[F.col("underlying")], "underlying")).drop("_known")
    side = one_per_day(stocks, ["close"]).select(F.col("symbol").alias("_s"), "trade_date", F.col("close").alias("underlying_close"))
    return named.join(side, ["_s", "trade_date"], "left").drop("_s")


def without(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def replaced(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` without the keys of ``new``, then ``new``; columns either lacks are null."""
    return without(old, new, [key]).unionByName(new, allowMissingColumns=True)


def keep_last(parts: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """Parts on top of each other; of equal keys the last part's last row stays."""
    tagged = [p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    by = Window.partitionBy(*keys).orderBy(F.desc("_part"), *(F.desc(c) for c in order))
    return out.withColumn("_n", F.row_number().over(by)).filter("_n = 1").drop("_n", "_part")
