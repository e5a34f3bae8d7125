"""Data-quality reports: completeness rules, hard verification, solver quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import snapshot_schedule
from ..functions.numeric import finite
from ..functions.pricing import american_price, with_implied_vol
from ..functions.symbols import parse_options, simple_ticker
from ..operators.dealing import dealt
from ..operators.filters import SOLVED, traded, with_expiry
from ..operators.joins import with_membership, with_stock_data
from ..operators.quantiles import exact_quantiles
from ..schemas import ISSUES
from ..sources.sinks import staged


def issue(df: DataFrame, severity: str, area: str, item: Column, message: Column | str) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return df.select(F.lit(severity).alias("severity"), F.lit(area).alias("area"), item.cast("string").alias("item"), text.alias("message"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def snapshot_issues(snapshots: DataFrame, start: str, end: str) -> DataFrame:
    """Expected snapshots that are absent."""
    due = snapshot_schedule(snapshots.sparkSession, start, end)
    missing = due.join(snapshots.select("snapshot_date").distinct(), "snapshot_date", "left_anti")
    return issue(missing, "error", "constituency", F.col("snapshot_date"), "missing snapshot")


def stock_issues(stocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rules on each expected symbol's history: present, long enough, and clean in every column.

    All rules of a symbol come from one aggregation of its rows.
    """
    cols = set(stocks.columns)
    bad = lambda c, w: F.count_if(w(F.col(c))) if c in cols else F.lit(0)
    null, negative = (lambda c: c.isNull() | F.isnan(c)), (lambda c: c < 0)
    checks = {"close": ("warning", "stocks", None), "dividends": ("warning", "stocks", "warning"), "dividend_yield": ("error", "stocks", "error"), "splits": ("warning", "splits", "error")}
    aggs = [F.min("trade_date").alias("a"), F.max("trade_date").alias("b"), F.count("trade_date").alias("dated")]
    aggs += [bad(c, null).alias(f"{c}_null") for c in checks] + [bad(c, negative).alias(f"{c}_negative") for c in checks]
    per = stocks.groupBy("symbol").agg(*aggs, F.lit(True).alias("present"))
    rows = ranges.join(per, "symbol", "left")
    have = rows.filter("present and dated > 0")
    s = F.col("symbol")
    parts = [
        issue(rows.filter("present is null"), "error", "stocks", s, "missing history"),
        issue(rows.filter("present and dated = 0"), "error", "stocks", s, "no readable dates"),
        issue(have.filter("a > range_start"), "error", "stocks", s, F.concat(F.lit("starts late: "), F.col("a").cast("string"))),
        issue(have.filter("b < range_end"), "error", "stocks", s, F.concat(F.lit("ends early: "), F.col("b").cast("string"))),
    ]
    for c, (on_null, area, on_negative) in checks.items():
        if c not in cols:
            parts.append(issue(have, {"close": "error"}.get(c, on_null), area, s, f"no column {c}"))
            continue
        parts.append(issue(have.filter(f"{c}_null > 0"), on_null, area, s, f"{c} has nulls"))
        if on_negative:
            parts.append(issue(have.filter(f"{c}_negative > 0"), on_negative, area, s, f"{c} has negative values"))
    return _all(parts)


def split_issues(mismatches: DataFrame, ledger: DataFrame) -> DataFrame:
    """Mismatches left over, and repairs that didn't succeed, by status."""
    left = mismatches.agg(F.count("*").alias("n")).filter("n > 0")
    open_ = ledger.withColumn("status", F.lower(F.trim("status"))).filter("status != 'repaired'").groupBy("status").agg(F.count("*").alias("n"))
    return _all(
        [
            issue(left, "error", "splits", F.lit("mismatches"), F.concat(F.col("n").cast("string"), F.lit(" rows"))),
            issue(open_, "warning", "splits", F.col("status"), F.concat(F.col("n").cast("string"), F.lit(" repairs"))),
        ]
    )


def raw_issues(raw: DataFrame, last_day: str, sample: int = 1000) -> DataFrame:
    """Rules on raw days: some exist, the latest is recent, and the first rows of each day are numeric."""
    order = Window.partitionBy("trade_date").orderBy("ordinal")
    head = raw.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample)
    numbers = [c for c in ("volume", "open", "close", "high", "low", "transactions") if c in raw.columns]
    per = head.groupBy("trade_date").agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in numbers))
    span = raw.agg(F.max("trade_date").alias("b"))
    parts = [
        issue(span.filter("b is null"), "error", "options", F.lit("raw"), "no raw days"),
        issue(span.filter(F.col("b") < F.lit(last_day).cast("date")), "error", "options", F.lit("raw"), F.concat(F.lit("latest day is "), F.col("b").cast("string"))),
    ]
    parts += [issue(per.filter(f"`{c}` > 0"), "warning", "options", F.col("trade_date"), f"{c} has nulls") for c in numbers]
    return _all(parts)


RAW_COLUMNS = ("ticker", "volume", "open", "close", "high", "low", "window_start", "transactions")


def _header(files: DataFrame) -> DataFrame:
    return files.withColumn("_columns", F.transform(F.split(F.lower("header"), ","), lambda c: F.trim(c)))


def raw_file_issues(files: DataFrame) -> DataFrame:
    """Rules on raw files: readable to their end, with a header, with rows, and with the required columns.

    ``files``: item, header, rows (see ``readers.probed``), and error, if they were inspected (``readers.raw_files`` with a ledger).
    """
    if "error" in files.columns:
        damaged = issue(files.filter("error is not null"), "error", "options", F.col("item"), F.concat(F.lit("unreadable: "), F.col("error")))
        return damaged.unionByName(raw_file_issues(files.filter("error is null").drop("error")))
    rows = _header(files).withColumn("_missing", F.array_sort(F.array_except(F.array(*map(F.lit, RAW_COLUMNS)), "_columns")))
    some = rows.filter("header != '' and rows > 0")
    return _all(
        [
            issue(rows.filter("header = ''"), "error", "options", F.col("item"), "unreadable"),
            issue(rows.filter("header != '' and rows = 0"), "warning", "options", F.col("item"), "no rows"),
            issue(some.filter(F.size("_missing") > 0), "error", "options", F.col("item"), F.concat(F.lit("missing columns: "), F.array_join("_missing", ", "))),
        ]
    )


def snapshot_file_issues(files: DataFrame, members: DataFrame) -> DataFrame:
    """Rules on snapshot files: readable, not empty, with a ticker column; and some members at all."""
    rows = _header(files)
    bare = rows.filter("header != ''").filter(~F.array_contains("_columns", "ticker"))
    none = members.agg(F.count("*").alias("n")).filter("n = 0")
    return _all(
        [
            issue(rows.filter("header = ''"), "error", "constituency", F.col("item"), "unreadable"),
            issue(rows.filter("header != '' and rows = 0"), "error", "constituency", F.col("item"), "no rows"),
            issue(bare, "error", "constituency", F.col("item"), "no ticker column"),
            issue(none, "error", "constituency", F.lit("snapshots"), "no usable snapshots"),
        ]
    )


def issue_sample(issues: DataFrame, n: int = 20) -> DataFrame:
    """The first n issues: errors first, then by area and item."""
    return issues.orderBy(F.col("severity") != "error", "area", "item", "message").limit(n)


def duplicate_keys(rows: DataFrame, key: str = "ticker") -> DataFrame:
    """(trade_date, duplicates): rows beyond the first of each key."""
    return rows.groupBy("trade_date").agg((F.count("*") - F.count_distinct(key)).alias("duplicates"))


def distinct_count(rows: DataFrame, column: str = "underlying") -> DataFrame:
    return rows.agg(F.count_distinct(column).alias("n"))


def no_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ISSUES)


def has_errors(issues: DataFrame) -> bool:
    return not issues.filter("severity = 'error'").isEmpty()


def verification(contracts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Per day: rows outside the universe, rows with a missing number, and repeated keys beyond the first."""
    rows = with_membership(contracts.withColumn("underlying", simple_ticker(F.col("underlying"))), snapshots, "_in")
    bad = F.lit(False)
    for c in SOLVED:
        if c != "dividend_yield":
            bad = bad | finite(F.col(c)).isNull()
    flagged = rows.withColumn("_bad", bad)
    return flagged.groupBy("trade_date").agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col("_in")).alias("outside"), F.count_if("_bad").alias("invalid"), (F.count("*") - F.count_distinct("ticker")).alias("duplicates")
    )


def verified(contracts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The same report, or an error if any day fails."""
    fails = (F.col("outside") > 0) | (F.col("invalid") > 0) | (F.col("duplicates") > 0)
    message = F.concat(F.lit("verification failed on "), F.col("trade_date").cast("string"))
    return verification(contracts, snapshots).withColumn("n_rows", F.when(fails, F.raise_error(message).cast("long")).otherwise(F.col("n_rows")))


#: Solver quality is measured at one rate and without yield, whatever the data says.
QA_RATE, QA_YIELD = 0.05, 0.0


def nearest_atm(contracts: DataFrame) -> DataFrame:
    """Per day, stock and type: the contract nearest to the money, then of the highest volume, then by ticker."""
    gap = F.abs(F.col("strike") / F.col("underlying_close") - 1)
    by = Window.partitionBy("trade_date", "underlying", "option_type").orderBy(gap, F.desc("volume"), "ticker", "ordinal")
    return contracts.withColumn("_n", F.row_number().over(by)).filter("_n = 1").drop("_n")


def nearest_atm_of_closes(contracts: DataFrame, closes: DataFrame) -> DataFrame:
    """The same where a stock's day may have several closes (see ``joins.day_closes``), and a contract counts with each of them.

    (trade_date, underlying, option_type, ticker, ordinal, strike, underlying_close).
    A contract finds its own nearest close first, in its row, so that rows are
    never multiplied by closes; one aggregation then picks the contract.
    """
    volume = F.col("volume")
    at = F.array_min(F.transform("closes", lambda c: F.struct(F.abs(F.col("strike") / c - 1).alias("gap"), c.alias("close"))))
    pick = F.struct(F.col("_at.gap").alias("gap"), volume.isNull().alias("none"), (-volume).alias("volume"), "ticker", "ordinal", "strike", F.col("_at.close").alias("close"))
    best = contracts.join(closes, ["underlying", "trade_date"]).withColumn("_at", at).groupBy("trade_date", "underlying", "option_type").agg(F.min(pick).alias("p"))
    return best.select("trade_date", "underlying", "option_type", "p.ticker", "p.ordinal", "p.strike", F.col("p.close").alias("underlying_close"))


def solver_samples(contracts: DataFrame) -> DataFrame:
    """Near-the-money samples with the solved volatility and the error of pricing it back."""
    rows = nearest_atm(contracts).withColumns({"risk_free_rate": F.lit(QA_RATE), "dividend_yield": F.lit(QA_YIELD)})
    done = with_implied_vol(dealt(rows))
    call = F.col("option_type") == "call"
    # without a volatility there is nothing to price back
    back = american_price("underlying_close", "strike", "time_to_expiry_years", "risk_free_rate", "implied_volatility", call, "dividend_yield")
    return done.withColumn("reprice", back).withColumn("abs_error", F.abs(F.col("reprice") - F.col("close")))


def solver_report(samples: DataFrame) -> DataFrame:
    """Per stock: samples, solved, failed, solve rate in percent, mean and 95th percentile of the absolute error."""
    samples = staged(samples.select("underlying", "iv_failure_reason", "abs_error"), "samples")
    ok = F.col("iv_failure_reason") == "ok"
    counts = samples.groupBy("underlying").agg(
        F.count("*").alias("samples"), F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), (100 * F.avg(ok.cast("double"))).alias("solve_rate"), F.avg("abs_error").alias("mean_error")
    )
    return counts.join(exact_quantiles(samples, ["underlying"], "abs_error", {"p95_error": 0.95}), "underlying", "left")


def solver_metrics(samples: DataFrame) -> DataFrame:
    """One row for all stocks: counts, the solve rate in percent to four digits, mean and 95th percentile of the absolute error to ten, stocks by solve rate, and failures by reason as JSON."""
    samples = staged(samples.select("underlying", "iv_failure_reason", "abs_error"), "samples")
    ok = F.col("iv_failure_reason") == "ok"
    rates = samples.groupBy("underlying").agg((100 * F.avg(ok.cast("double"))).alias("solve_rate"))
    totals = samples.agg(F.count("*").alias("sampled"), F.round(100 * F.avg(ok.cast("double")), 4).alias("overall_solve_rate"), F.round(F.avg("abs_error"), 10).alias("mean_error"))
    worst = exact_quantiles(samples.withColumn("all", F.lit(1)), ["all"], "abs_error", {"p95_error": 0.95}).select(F.round("p95_error", 10).alias("p95_error"))
    reasons = solver_failures(samples).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("iv_failure_reason", "n"))))).alias("fail_reasons"))
    # one row each; without an error there is no percentile
    return solver_summary(rates).join(F.broadcast(totals)).join(F.broadcast(worst), how="left").join(F.broadcast(reasons))


def solver_summary(report: DataFrame) -> DataFrame:
    rate = F.col("solve_rate")
    return report.agg(F.count("*").alias("stocks"), F.count_if(rate >= 95).alias("at_least_95"), F.count_if(rate >= 99).alias("at_least_99"), F.count_if(rate < 90).alias("below_90"))


def solver_failures(samples: DataFrame) -> DataFrame:
    """(iv_failure_reason, n) of the samples that were not solved."""
    return samples.filter("iv_failure_reason != 'ok'").groupBy("iv_failure_reason").agg(F.count("*").alias("n"))


def extremes(report: DataFrame, n: int = 15, worst: bool = True) -> DataFrame:
    """The n stocks of lowest (or highest) solve rate; among equals, those of fewer (or more) samples."""
    way = F.asc if worst else F.desc
    return report.orderBy(way("solve_rate"), way("samples"), "underlying").limit(n)


def funnel(raw: DataFrame, stocks: DataFrame) -> DataFrame:
    """One row of counts: raw, parsed, in range, traded, with a close, and sampled (a contract for each day, stock and type); from one pass over the rows."""
    rows = with_stock_data(with_expiry(parse_options(raw)), stocks)
    a = F.coalesce(F.col("option_type").isNotNull(), F.lit(False))
    b = a & F.coalesce(F.col("dte_days").between(30, 90), F.lit(False))
    c = b & traded(F.col("volume"), F.col("close"))
    d = c & F.col("underlying_close").isNotNull()
    return rows.agg(F.count("*").alias("raw"), F.count_if(a).alias("parsed"), F.count_if(b).alias("in_range"), F.count_if(c).alias("traded"), F.count_if(d).alias("with_close"), F.count_distinct(F.when(d, F.struct("trade_date", "underlying", "option_type"))).alias("sampled"))
