"""What tasks hold and what is shuffled does not follow the rows of one group or one day."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_oracles import SF

from volsurf import fixtures, queries
from volsurf.operators import joins, quantiles
from volsurf.plans import features, maintenance, quality
from volsurf.queries import QUERIES
from volsurf.sources import sinks, versions


def test_equal_values_are_counted_before_they_are_sorted(spark, monkeypatch):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), (F.col("id") * F.col("id") % 23).cast("double").alias("x"))
    written = []
    monkeypatch.setattr(quantiles, "staged", lambda df, tag: written.append(sinks.staged(df, tag)) or written[-1])
    found = {r.k: (r.low, r.mid, r.high) for r in quantiles.exact_quantiles(rows, ["k"], "x", {"low": 0.013, "mid": 0.5, "high": 1.0}).collect()}
    assert written[0].count() <= 3 * 23
    by = rows.toPandas()
    for k, own in ((None, by[by.k.isna()].x), (1, by[by.k == 1].x), (2, by[by.k == 2].x)):
        np.testing.assert_allclose(found[k], np.quantile(own, [0.013, 0.5, 1.0]), rtol=1e-12)


def _big_day(spark):
    text = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, 40_000, numPartitions=8).select(F.lit("2024-01-02").cast("date").alias("trade_date"), text.alias("underlying"), "id")


def test_a_large_day_is_cut_among_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        assert sinks.write_days(_big_day(spark), str(tmp_path / "days")) == {"written": 40_000, "undated": 0}
        table = versions.Table(spark, str(tmp_path / "table"))
        table.write_days(_big_day(spark), table.newest(), sort=("underlying",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for out in (spark.read.parquet(str(tmp_path / "days")), table.read("underlying string, id long")):
        assert out.select("id").distinct().count() == out.count() == 40_000
        assert out.select(F.input_file_name()).distinct().count() > 1


def _several_closes(spark):
    """(contracts, closes, both met row by row): 400 contracts of two stocks, whose days have up to seven closes."""
    rows = spark.range(400).selectExpr("concat('O:', id % 97) AS ticker", "DATE '2024-01-02' AS trade_date", "IF(id % 2 = 0, 'AAA', 'AAB') AS underlying", "IF(id % 3 = 0, 'call', 'put') AS option_type", "60.0D + id * 7 % 83 AS strike")
    rows = rows.selectExpr("*", "DATE '2024-03-01' + CAST(strike % 3 AS INT) AS expiration_date", "CAST(strike * 31 % 50 AS BIGINT) AS ordinal", "CAST(strike % 4 AS BIGINT) AS volume", "30 + CAST(strike AS INT) % 61 AS dte_days", "0.1D + strike % 5 / 10 AS implied_volatility")
    stocks = spark.range(14).selectExpr("IF(id % 2 = 0, 'AAA', 'AAB') AS symbol", "DATE '2024-01-02' AS trade_date", "80.0D + id * id % 11 * 3 AS close")
    met = rows.join(stocks.withColumnsRenamed({"symbol": "underlying", "close": "underlying_close"}), ["underlying", "trade_date"])
    return rows, joins.day_closes(stocks), met.selectExpr("*", *(f"{t} AS {g}" for g, t in _greeks("underlying_close").items()))


def _greeks(close):
    return fixtures.greeks(close, "strike", "implied_volatility", "option_type")


def test_selected_contracts_are_not_multiplied_by_closes(spark):
    rows, closes, met = _several_closes(spark)
    assert met.count() > 2000
    ours = features.selection_long(features.selected_of_closes(rows, closes, _greeks))
    theirs = features.selection_long(features.selected(met))
    assert len(ours.collect()) > 10
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.select(*ours.columns).collect()))


def test_nearest_contract_is_not_multiplied_by_closes(spark):
    rows, closes, met = _several_closes(spark)
    ours = quality.nearest_atm_of_closes(rows, closes)
    theirs = quality.nearest_atm(met).select(*ours.columns)
    assert len(ours.collect()) == 4
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_lines_are_shuffled_once_and_before_they_multiply(spark):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in "win04_delta_selection agg14_skew_slope df08_bucket_metrics win05_nearest_atm agg09_solver_failures".split():
            text = plan(QUERIES[name](spark, SF))
            assert text.count("MergeJoin [") + text.count("HashJoin [") == 1, name
            assert "Window" not in text, name
        # lines and both sides of stocks
        assert plan(fixtures.load(spark, SF, "own")).count("Exchange hashpartitioning(") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_union_shuffles_lines_once_and_before_they_multiply(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = QUERIES["set02_schema_union"](spark, SF)
        assert found.count()
        found.collect()
        first, last = (found._jdf.queryExecution().executedPlan().toString().split(f"== {x} Plan ==")[-1] for x in ("Initial", "Final"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a join in each half, the second over the first one's shuffle, and no sort
    assert first.count("MergeJoin [") + first.count("HashJoin [") == 2
    assert "ReusedExchange" in last.split("== Initial Plan ==")[0]
    assert "Sort [" not in first
    # numbers are not taken to their decimal texts
    assert " round(" not in first and "(round(" not in first


def test_a_repair_keeps_affected_days_only(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(maintenance, "staged", lambda df, tag: kept.setdefault(tag, sinks.staged(df, tag)))
    QUERIES["df14_repaired_contracts"](spark, SF)
    assert {str(r[0]) for tag in ("raw", "contracts") for r in kept[tag].select("trade_date").distinct().collect()} == {"2024-01-04"}


def test_a_day_of_a_file_is_not_sorted(spark, tmp_path):
    def peak(**options):
        # what the tasks of the write held at most
        known = {t for t in _stages(spark)}
        sinks.day_files(_big_day(spark), str(tmp_path / f"days{len(options)}"), ["underlying", "id"], **options)
        return max(_stages(spark)[t] for t in _stages(spark) if t not in known)

    assert peak() < 0.5 * peak(sort=["id"])
    rows = spark.read.option("header", True).csv(str(tmp_path / "days0" / "2024" / "01" / "2024-01-02.csv.gz"))
    assert rows.count() == rows.select("id").distinct().count() == 40_000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def _stages(spark):
    """Of each stage that has run, the bytes that a task held at most."""
    store, out, k, missing = spark.sparkContext._jsc.sc().statusStore(), {}, 0, 0
    while missing < 50:
        try:
            stage = store.lastStageAttempt(k)
            missing, tasks = 0, store.taskList(k, stage.attemptId(), 1000)
            out[k] = max((tasks.apply(j).taskMetrics().get().peakExecutionMemory() for j in range(tasks.size()) if tasks.apply(j).taskMetrics().isDefined()), default=0)
        except Exception:  # noqa: BLE001
            missing += 1
        k += 1
    return out


def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_means_are_taken_before_rows_repeat(spark):
    text = _plan(spark, "agg13_nan_mean")
    # the last step repeats rows, whose numbers are done, and no number is taken to its decimal text
    assert text.index("Generate") < text.index("rint(")
    assert "(round(" not in text and " round(" not in text and "aggregate(" not in text


def test_lines_are_sorted_before_they_multiply(spark):
    text = _plan(spark, "srt03_sorted_contracts")
    assert text.index("Generate") < text.index("Sort [") < text.index("Join")
    assert text.count("Generate") == 2 and " round(" not in text and "(round(" not in text
    rows = [tuple(r)[:5] for r in QUERIES["srt03_sorted_contracts"](spark, SF).select("trade_date", "underlying", "expiration_date", "option_type", "strike").collect()]
    assert rows == sorted(rows)


def test_lines_are_spliced_before_they_multiply(spark):
    text = _plan(spark, "df14_splice")
    assert text.rindex("Generate") < text.index("LeftAnti")
    assert " round(" not in text and "(round(" not in text


def test_tickers_are_parsed_before_lines_multiply(spark):
    text = _plan(spark, "df06_uncovered_rows")
    # quotes come last, and a ticker's conditions are not taken back to its parts
    assert text.index("explode(coalesce(closes") < text.index("RLIKE")
    assert "RLIKE(upper(trim(concat(" not in text


def test_rows_of_a_day_file_are_made_behind_its_sort(spark, tmp_path):
    rows = spark.range(3000).select(F.date_add(F.lit("2024-01-02").cast("date"), F.col("id").cast("int") % 3).alias("trade_date"), (F.col("id") * 7919 % 3000).alias("id"))
    sinks.day_files(rows, str(tmp_path / "days"), ["id", "k"], sort=["id"], spread=lambda r: r.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")))
    for day in ("02", "03", "04"):
        lines = gzip.open(tmp_path / "days" / "2024" / "01" / f"2024-01-{day}.csv.gz", "rt").read().split()[1:]
        found = [tuple(map(int, x.split(","))) for x in lines]
        assert len(found) == 10_000 and found == sorted(found)


def test_lines_of_one_place_share_an_order_of_closes(spark):
    kinds = "_day string, ordinal long, ticker string, closes array<double>, base double, option_type string, strike double, vol double, t double, l_partkey long, volume long, close double"
    line = lambda n, closes, volume: ("2024-01-02", n, "T", closes, 80.0, "call", 90.0, 0.2, 0.1, 1, volume, None)
    lines = spark.createDataFrame([line(1, [140.0, 120.0], 1), line(1, [130.0], 2), line(2, None, 3)], kinds)
    found = queries._quoted_in_order(lines.repartition(1).sortWithinPartitions("_day", "ordinal", "ticker")).collect()
    assert [(r.ordinal, r.volume) for r in found] == [(1, 1), (1, 2), (1, 1), (2, 3)]
    assert found[0].close < found[1].close < found[2].close


def test_rows_of_a_day_are_made_and_counted_behind_its_shuffle(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 7 != 0, F.lit("2024-01-02").cast("date")).alias("trade_date"), F.col("id").cast("string").alias("underlying"))
    made = []
    with pytest.warns(UserWarning):
        counts = sinks.write_days(rows, str(tmp_path / "days"), spread=lambda r: made.append(r) or r.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")))
    assert counts == {"written": 25_710, "undated": 4_290}
    assert "RebalancePartitions" in made[0]._jdf.queryExecution().analyzed().toString()
    found = spark.read.parquet(str(tmp_path / "days"))
    assert found.count() == found.select("underlying", "k").distinct().count() == 25_710


def test_rows_of_a_shard_are_made_behind_its_shuffle(spark, tmp_path):
    rows = spark.range(300).select(F.lit("2024-01-02").cast("date").alias("trade_date"), F.col("id").cast("string").alias("underlying"))
    table, made = versions.Table(spark, str(tmp_path / "table")), []
    table.write_days(rows, 0, sort=("underlying",), spread=lambda r: made.append(r) or r.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")))
    assert "RebalancePartitions" in made[0]._jdf.queryExecution().analyzed().toString()
    found = table.read("trade_date date, underlying string, k int")
    assert found.count() == found.distinct().count() == table.live()[0]["rows"] == 3000
