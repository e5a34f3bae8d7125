"""Edge rows of parsing, filters, joins and calendars."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from volsurf.functions import calendar, numeric, symbols
from volsurf.functions.pricing import early_reason, with_atm_greeks, with_implied_vol
from volsurf.operators import dealing, filters, joins
from volsurf.operators.quantiles import exact_quantiles
from volsurf.plans import features, quality, stocks
from volsurf.sources import buckets, readers
from volsurf.streaming import incremental

D = dt.date


def test_option_symbols(spark):
    names = ["o:aapl250117c00150000 ", "O:AAPL1250117C00150000", "O:ABCDEF250117P00001500", "O:AAPL251399C00150000", None, "", "O:AAPL250117X00150000"]
    got = symbols.parse_options(spark.createDataFrame([(n,) for n in names], "ticker string")).collect()
    assert got[0][1:] == ("AAPL", D(2025, 1, 17), "call", 150.0)
    assert got[1][1:] == (None,) * 4 and got[4][1:] == (None,) * 4 and got[5][1:] == (None,) * 4 and got[6][1:] == (None,) * 4
    assert got[2].underlying == "ABCDEF" and got[3].expiration_date is None
    kept = symbols.parse_options(spark.createDataFrame([(n,) for n in names], "ticker string")).filter(symbols.supported_underlying(F.col("underlying")))
    assert "ABCDEF" not in [r.underlying for r in kept.collect()]


def test_eligible_boundaries(spark):
    day = D(2024, 1, 2)
    rows = []
    for dte in (29, 30, 90, 91):
        rows.append((f"O:AAPL{day + dt.timedelta(dte):%y%m%d}C00150000", 5, 1.0, day))
    near = f"O:AAPL{day + dt.timedelta(40):%y%m%d}C00150000"
    rows += [(near, None, 1.0, day), (near, 0, 1.0, day), (near, 1, None, day), (near, 1, 0.0, day), (near, 1, float("nan"), day)]
    got = filters.eligible(spark.createDataFrame(rows, "ticker string, volume long, close double, trade_date date"))
    assert sorted(r.dte_days for r in got.collect()) == [30, 90]


def test_reasons_come_in_order(spark):
    ddl = "close double, underlying_close double, strike double, time_to_expiry_years double, risk_free_rate double, option_type string, dividend_yield double"
    rows = [(5.0, None, 100.0, 0.1, 0.05, "call", 0.0), (5.0, float("nan"), 100.0, 0.1, 0.05, "call", 0.0), (5.0, 100.0, 100.0, 0.0, 0.05, "call", 0.0), (5.0, 100.0, 100.0, 0.1, None, "call", 0.0)]
    rows += [(0.5, 110.0, 100.0, 0.1, 0.05, "call", 0.0), (111.0, 110.0, 100.0, 0.1, 0.05, "call", 0.0), (20.0, 120.0, 100.0, 60 / 365.25, 0.05, "call", 0.0), (5.0, 100.0, 100.0, 60 / 365.25, 0.05, "put", None)]
    df = spark.createDataFrame(rows, ddl)
    assert [r[0] for r in df.select(early_reason()).collect()] == ["missing_input", "missing_input", "invalid_expiry", "missing_risk_free_rate", "arbitrage_bounds", "arbitrage_bounds", None, None]
    done = with_implied_vol(df).collect()
    assert done[6].iv_failure_reason == "no_root_in_range" and done[7].iv_failure_reason == "ok" and done[0].implied_volatility is None
    greeks = with_atm_greeks(with_implied_vol(df)).collect()
    assert greeks[0].atm_delta is None and greeks[7].atm_delta < 0


def test_split_factors(spark):
    df = spark.createDataFrame([(2.15,), (2.17,), (0.5,), (1.0,), (float("nan"),), (0.0,), (-2.0,), (None,)], "r double")
    assert [r[0] for r in df.select(numeric.split_factor(F.col("r"))).collect()] == [2.0, None, 0.5, None, None, None, None, None]


def test_split_day_is_not_adjusted(spark):
    rows = [("A", D(2024, 1, 2), 10.0, 0.0, 0.0), ("A", D(2024, 1, 3), 11.0, 0.0, 2.0), ("A", D(2024, 1, 4), 12.0, 0.0, None)]
    got = stocks.normalized(spark.createDataFrame(rows, "symbol string, trade_date date, close double, dividends double, splits double")).orderBy("trade_date").collect()
    assert [r.close for r in got] == [20.0, 11.0, 12.0]


def test_dividend_window_and_floor(spark):
    day = D(2024, 6, 1)
    rows = [("A", day - dt.timedelta(365), 10.0, 1.0, 0.0), ("A", day - dt.timedelta(364), 5.0, 2.0, 0.0), ("A", day, 5.01, 0.0, 0.0)]
    got = stocks.normalized(spark.createDataFrame(rows, "symbol string, trade_date date, close double, dividends double, splits double")).orderBy("trade_date").collect()
    # the row at 5.00 goes, its dividend stays
    assert [r.trade_date for r in got] == [day - dt.timedelta(365), day]
    assert got[1].dividend_yield == pytest.approx(2 / 5.01)


def test_asof_rates(spark):
    rates = spark.createDataFrame([(D(2024, 1, 1), 0.05), (D(2024, 1, 5), 0.06)], "rate_date date, rate double")
    days = spark.createDataFrame([(D(2024, 1, 4),), (D(2024, 1, 5),), (D(2024, 2, 5),)], "trade_date date")
    assert [r.risk_free_rate for r in joins.asof_rates(days, rates).orderBy("trade_date").collect()] == [0.05, 0.06, 0.06]
    early = spark.createDataFrame([(D(2023, 12, 1),)], "trade_date date")
    with pytest.raises(Exception, match="no risk-free rate"):
        joins.with_rates(early, rates).collect()


def test_membership(spark):
    snaps = spark.createDataFrame([(D(2024, 1, 1), "A"), (D(2024, 4, 1), "A"), (D(2024, 7, 1), "B"), (D(2024, 10, 1), "A")], "snapshot_date date, symbol string")
    got = joins.membership_windows(snaps, "2024-01-15", "2024-12-31").orderBy("symbol", "start_date").collect()
    assert [tuple(r) for r in got] == [("A", D(2024, 1, 15), D(2024, 6, 30)), ("A", D(2024, 10, 1), D(2024, 12, 31)), ("B", D(2024, 7, 1), D(2024, 9, 30))]
    rows = spark.createDataFrame([("A", D(2024, 6, 30)), ("A", D(2024, 7, 1)), ("B", D(2024, 7, 1))], "underlying string, trade_date date")
    assert joins.active_asof(rows, snaps).count() == 2
    early = spark.createDataFrame([("A", D(2023, 1, 1))], "underlying string, trade_date date")
    assert joins.active_in_windows(early, joins.membership_windows(snaps, "2024-01-15", "2024-12-31")).count() == 0
    with pytest.raises(Exception, match="no snapshot"):
        joins.active_asof(early, snaps).collect()


def test_last_row_wins(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, None), ("B", 1, 7.0)], "s string, o int, x double")
    assert {r.s: r.x for r in joins.last_by(df, ["s"], "o").collect()} == {"A": None, "B": 7.0}


def test_business_days(spark):
    days = {r.day: r.is_business for r in calendar.business_days(spark, "2021-12-01", "2025-02-01").collect()}
    assert days[D(2021, 12, 31)] and not days[D(2024, 3, 29)] and not days[D(2025, 1, 9)] and not days[D(2022, 12, 26)] and days[D(2024, 1, 9)]


def test_surface_ties_and_gaps(spark):
    ddl = "trade_date date, underlying string, option_type string, strike double, underlying_close double, dte_days int, implied_volatility double, delta double, gamma double, theta double, vega double, expiration_date date, ticker string, ordinal long"
    base = (D(2024, 1, 2), "A")
    rows = [
        (*base, "call", 100.0, 100.0, 30, 0.2, 0.5, 0.01, -1.0, 5.0, D(2024, 2, 1), "x", 2),
        (*base, "call", 105.0, 100.0, 30, 0.3, 0.5, 0.02, -1.0, 5.0, D(2024, 2, 1), "y", 1),
        (*base, "call", 130.0, 100.0, 45, 0.4, 0.375, 0.0, -1.0, 5.0, D(2024, 2, 16), "z", 3),
        (*base, "call", 100.0, 100.0, 20, 0.4, 0.5, 0.0, -1.0, 5.0, D(2024, 2, 16), "w", 4),
    ]
    got = features.surface_features(spark.createDataFrame(rows, ddl)).collect()[0]
    assert len(got) == 111 and list(got.asDict()) == features.SURFACE_COLUMNS
    assert got.atm_call_iv_30d == 0.3 and got.call_25_delta_iv_30d is None and got.n_contracts_30d == 3 and got.n_contracts_total == 3
    assert got.put_gamma_sum_raw == 0 and got.put_gamma_mean is None and got.skew_slope is None and got.atm_iv == 0.3


def test_only_puts(spark):
    df = spark.createDataFrame([(D(2024, 1, 2), "A", "put", 0.2, -0.5, 0.1, float("nan"), 1.0)], "trade_date date, underlying string, option_type string, implied_volatility double, atm_delta double, atm_gamma double, atm_theta double, atm_vega double")
    got = features.daily_features(df).collect()[0]
    assert got.avg_call_iv is None and got.avg_put_iv == 0.2 and got.avg_put_theta is None


def test_symbols_are_parsed_once(spark, tmp_path):
    spark.sql("SELECT 'O:AAPL250117C00150000' AS ticker, 1L AS volume, 2D AS close, DATE '2024-12-01' AS trade_date").write.parquet(str(tmp_path / "raw"))
    plan = filters.eligible(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(volume,0)" in plan and "GreaterThan(c" in plan and "regexp_extract" not in plan
    assert filters.eligible(spark.read.parquet(str(tmp_path / "raw")), only="AAPL").count() == 1 and filters.eligible(spark.read.parquet(str(tmp_path / "raw")), only="AAP").count() == 0


def test_both_sides_are_needed(spark):
    rows = spark.createDataFrame([(D(2024, 1, 2), "A", "call", 0.5)], "trade_date date, underlying string, option_type string, delta double")
    with pytest.raises(ValueError, match="no calls or no puts"):
        joins.call_put_outer(rows, ["delta"])


def test_first_row_of_a_ticker_wins(spark):
    rows = spark.createDataFrame([(D(2024, 1, 1), "X.N;Y.N;Z.N", "A;A;C", None), (D(2024, 2, 1), "Y.N", "A", None)], "day date, r string, t string, n string")
    got = sorted((r.day, r.ticker, r.original_ric) for r in symbols.exploded_members(rows, "r", "t", "n").collect())
    assert got == [(D(2024, 1, 1), "A", "X.N"), (D(2024, 1, 1), "C", "Z.N"), (D(2024, 2, 1), "A", "Y.N")]


def test_wider_coverage(spark):
    rows = spark.createDataFrame([(D(2024, 1, 2), d) for d in (20, 29, 30, 44, 50, 80, 95)] + [(D(2024, 1, 3), 50)], "trade_date date, dte_days int")
    have = rows.filter("dte_days in (44, 50, 80) and trade_date = '2024-01-02'")
    assert sorted((r.trade_date.day, r.dte_days) for r in filters.uncovered(rows, have, 20, 120).collect()) == [(2, 20), (2, 29), (2, 95), (3, 50)]
    assert sorted((r.trade_date.day, r.dte_days) for r in filters.uncovered(rows, have).collect()) == [(2, 30), (3, 50)]


def sound_rows(spark, **changes):
    row = {"trade_date": D(2024, 1, 2), "ticker": "T", "underlying": "A", "option_type": "put", "close": 5.0, "strike": 100.0, "underlying_close": 100.0, "time_to_expiry_years": 60 / 365.25, "dividend_yield": 0.0, "risk_free_rate": 0.05, "implied_volatility": 0.3, "delta": -0.5, "gamma": 0.1, "theta": -1.0, "vega": 9.0} | changes
    return spark.createDataFrame([row])


def test_verification_fails_the_job(spark):
    snaps = spark.createDataFrame([(D(2024, 1, 1), "A")], "snapshot_date date, symbol string")
    assert quality.verified(sound_rows(spark), snaps).count() == 1
    for bad in (sound_rows(spark, underlying="B"), sound_rows(spark, gamma=float("nan")), sound_rows(spark).union(sound_rows(spark))):
        with pytest.raises(Exception, match="verification failed"):
            quality.verified(bad, snaps).collect()
    assert not quality.has_errors(quality.no_issues(spark))
    assert quality.has_errors(spark.createDataFrame([("error", "a", "b", "c")], "severity string, area string, item string, message string"))


def test_features_of_mean_inputs(spark):
    rows = sound_rows(spark, implied_volatility=0.2).union(sound_rows(spark, implied_volatility=0.4))
    whole = features.daily_features(with_atm_greeks(sound_rows(spark))).collect()[0]
    means = features.daily_features_from_means(rows).collect()[0]
    assert means.avg_put_iv == pytest.approx(0.3) and means.avg_put_delta == pytest.approx(whole.avg_put_delta) and means.avg_call_iv is None


def test_final_tables(spark):
    out = features.final_tables(features.daily_features(with_atm_greeks(sound_rows(spark))).drop("avg_call_vega"))
    assert len(out) == 10 and out["avg_put_iv"].columns == ["trade_date", "underlying", "avg_put_iv"] and out["avg_put_iv"].count() == 1
    assert out["avg_call_vega"].columns[-1] == "avg_call_vega" and out["avg_call_vega"].count() == 0


def test_snapshot_of_each_day(spark):
    snaps = spark.createDataFrame([(D(2024, 1, 1), "A"), (D(2024, 4, 1), "B")], "snapshot_date date, symbol string")
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 3, 31),), (D(2024, 4, 2),)], "trade_date date")
    assert sorted(tuple(r) for r in joins.snapshot_of(days, snaps).collect()) == [(D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 3, 31), D(2024, 1, 1)), (D(2024, 4, 2), D(2024, 4, 1))]
    with pytest.raises(Exception, match="no snapshot"):
        joins.snapshot_of(days.limit(0).union(spark.createDataFrame([(D(2023, 1, 1),)], "trade_date date")), snaps).collect()


def test_manifest_says_which_days_are_valid(spark):
    rows = incremental.manifest_rows(sound_rows(spark), "own", 3, 7, 30, 90)
    assert [(r.dataset, r.trade_date, r.schema_version, r.source_version, r.min_dte, r.max_dte, r["rows"]) for r in rows.collect()] == [("own", D(2024, 1, 2), 3, 7, 30, 90, 1)]
    days = spark.createDataFrame([(D(2024, 1, 2), 7), (D(2024, 1, 3), 7)], "trade_date date, source_version long")
    stale = lambda **k: [r.trade_date for r in incremental.stale_days(days, rows, "own", 3, **k).collect()]
    assert stale(min_dte=30, max_dte=90) == [D(2024, 1, 3)] and len(stale(min_dte=20, max_dte=90)) == 2


def test_cleaned_codes(spark):
    got = spark.createDataFrame([(" A.N ",), (" ",), (None,)], "c string").select(symbols.cleaned_code(F.col("c"))).collect()
    assert [r[0] for r in got] == ["A.N", None, None]


def test_memberships_flag_rows_once(spark):
    snaps = spark.createDataFrame([(D(2024, 1, 1), "A"), (D(2024, 1, 1), "A"), (D(2024, 4, 1), "A"), (D(2024, 7, 1), "B")], "snapshot_date date, symbol string")
    rows = spark.createDataFrame([("A", D(2024, 4, 1)), ("A", D(2024, 7, 1)), ("B", D(2024, 7, 1)), ("C", D(2024, 7, 1))], "underlying string, trade_date date")
    assert [r.inside for r in joins.with_membership(rows, snaps, "inside").orderBy("trade_date", "underlying").collect()] == [True, False, True, False]


def test_exact_quantiles(spark):
    r = random.Random(3)
    rows = [(r.choice("abc"), r.choice([None, 0.5, r.uniform(-5, 5), float(r.randint(0, 3))])) for _ in range(3000)] + [("one", 7.0), ("none", None)]
    # one group has most of the rows
    rows += [("hot", float(k % 997)) for k in range(6000)]
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {tuple(x)[0]: tuple(x)[1:] for x in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", shares).collect()}
    want = {k: tuple(np.quantile([v for g, v in rows if g == k and v is not None], list(shares.values()))) for k in ("a", "b", "c", "one", "hot")}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert exact_quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", shares).count() == 0


def test_solver_rows_are_dealt_by_cost(spark):
    r = random.Random(4)
    # one crowded expiry, one of few rows but deep trees
    rows = [(f"T{k}", D(2024, 1, 2), r.choice([30, 31, 31, 31, 31, 90])) for k in range(4000)] + [(None, None, None), ("U", D(2024, 1, 2), 400)]
    out = dealing.dealt(spark.createDataFrame(rows, "ticker string, trade_date date, dte_days int"), parts=16)
    got = out.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(dealing.tree_steps(F.col("dte_days")) ** 2).alias("cost"), F.count("*").alias("n"), F.count_distinct("dte_days").alias("depths")).collect()
    costs = sorted(x.cost for x in got)
    assert sum(x.n for x in got) == len(rows) and len(got) == 16
    assert costs[-1] < 1.3 * costs[len(costs) // 2] and max(x.depths for x in got) <= 3
    assert dealing.dealt(out.limit(0)).count() == 0


def test_bucketed_upserts_need_no_exchange(spark, tmp_path):
    old = spark.createDataFrame([(D(2024, 1, 1 + k % 3), f"T{k % 40}", k, float(k)) for k in range(200)], "trade_date date, ticker string, n int, x double")
    new = spark.createDataFrame([(D(2024, 1, 1 + k % 3), f"T{k % 50}", k, "y") for k in range(60)], "trade_date date, ticker string, n int, note string")
    keys = ["trade_date", "ticker"]
    for name, df in (("b_old", old), ("b_new", new)):
        buckets.write_bucketed(df, name, keys, 4, str(tmp_path / name))
    got = buckets.upserted_table(spark, "b_old", "b_new", keys, ["n"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = joins.keep_last([old, new], keys, ["n"])
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    # a day's shard that isn't bucketed goes to the old table's buckets; the old one stays where it is
    plan = buckets.upserted(spark.table("b_old"), new, keys, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    for name in ("b_old", "b_new"):
        spark.sql(f"DROP TABLE {name}")


def test_vendor_requests_shrink_with_the_query(spark, tmp_path):
    for symbol in ("A.N", "B.N", "C.N"):
        for year in (2022, 2023, 2024):
            rows = [{"symbol": symbol[0], "trade_date": f"{year}-0{m}-15", "close": year + m / 10} for m in (1, 2)]
            (tmp_path / f"{symbol}-{year}.json").write_text(json.dumps(rows))
    # what the query doesn't need can't even be parsed
    for bad in ("C.N-2023", "A.N-2022", "B.N-2024"):
        (tmp_path / f"{bad}.json").write_text("[{")
    spark.dataSource.register(readers.VendorSource)
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, True)
    try:
        df = spark.read.format("vendor").options(fixture=str(tmp_path), symbols="A.X|A.N,B.N,C.N", push="true").load()
        got = df.filter("symbol in ('A', 'B') and trade_date >= '2023-01-20' and trade_date < '2023-12-31' and close > 0")
        assert sorted((r.symbol, r.trade_date) for r in got.collect()) == [("A", "2023-02-15"), ("B", "2023-02-15")]
        reader = readers._PushingReader({"symbols": "A.X|A.N,B.N,C.N"}, ["symbol"])
        left = list(reader.pushFilters([readers.In(("symbol",), ("A", "B")), readers.EqualTo(("symbol",), "B"), readers.GreaterThanOrEqual(("trade_date",), "2023-01-20"), readers.LessThan(("trade_date",), "2023-12-31")]))
        assert len(left) == 4 and (reader.first, reader.last) == ("2023-01-20", "2023-12-31") and [str(p.value) for p in reader.partitions()] == ["B.N"]
    finally:
        spark.conf.set(key, before)


def test_only_one_stock_is_looked_up(spark):
    from volsurf.plans.contracts import priced_inputs

    raw = spark.createDataFrame([("O:A240315C00050000", D(2024, 1, 22), 5, 1.5), ("O:B240315C00050000", D(2024, 1, 22), 5, 1.5)], "ticker string, trade_date date, volume long, close double")
    stocks = spark.createDataFrame([(s, D(2024, 1, 22), 50.0, 0.0, 1) for s in "AB"], "symbol string, trade_date date, close double, dividend_yield double, ordinal long")
    rates = spark.createDataFrame([(D(2024, 1, 19), 0.05)], "rate_date date, rate double")
    got = priced_inputs(raw, stocks, rates, only="A").collect()
    assert [(r.underlying, r.underlying_close) for r in got] == [("A", 50.0)]
