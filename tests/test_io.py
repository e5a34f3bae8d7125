import datetime as dt
import gzip
import json
import shutil

import pytest
from pyspark.sql import functions as F

from volsurf.operators import joins
from volsurf.plans import maintenance, quality, runs
from volsurf.sources import readers, sinks, versions
from volsurf.streaming import incremental

D = dt.date


def day_file(root, day, rows):
    path = root / f"{day:%Y/%m}"
    path.mkdir(parents=True, exist_ok=True)
    with gzip.open(path / f"{day}.csv.gz", "wt") as f:
        f.write("ticker,volume,open,close,high,low,window_start,transactions\n" + "".join(f"{t},{v},1,1.5,2,1,0,1\n" for t, v in rows))


def test_raw_days(spark, tmp_path):
    for k in (2, 3, 4):
        day_file(tmp_path, D(2024, 1, k), [(f"T{k}", k)])
    with gzip.open(tmp_path / "notes.csv.gz", "wt") as f:
        f.write("ticker\nx\n")
    got = readers.raw_days(spark, str(tmp_path), "2024-01-03").collect()
    assert sorted((r.trade_date, r.ticker, r.volume) for r in got) == [(D(2024, 1, 3), "T3", 3), (D(2024, 1, 4), "T4", 4)]
    with pytest.raises(Exception, match="no date in"):
        readers.raw_days(spark, str(tmp_path), strict=True).collect()
    assert readers.every_nth(readers.listed_days(spark, str(tmp_path)).filter("trade_date is not null"), 2).count() == 2


def test_stock_history(spark, tmp_path):
    (tmp_path / "aapl_stock_data.csv").write_text("Date,Close,TR.CLOSEPRICE(Adjusted=0),dividend_yield\n2024-01-02,1,185.5,\n2024-01-03,1,x,0.1\n2024-01-04,1,186,-1\n")
    got = sorted(readers.stock_history(spark, str(tmp_path)).collect())
    assert [tuple(r)[:4] for r in got] == [("AAPL", D(2024, 1, 2), 185.5, 0.0), ("AAPL", D(2024, 1, 4), 186.0, 0.0)]
    assert readers.stock_history(spark, str(tmp_path / "none")).count() == 0


def test_rates_and_snapshots(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-02", "5.2", "X"), ("2024-01-03", ".", "X"), ("2024-01-02", "9", "Y")], "Date string, value string, series_id string")
    assert [tuple(r) for r in readers.resolved_rates(df, "X").collect()] == [(D(2024, 1, 2), pytest.approx(0.052))]
    body = spark.createDataFrame([(json.dumps({"observations": [{"date": "2024-01-02", "value": "5"}, {"date": "2024-01-03", "value": "."}]}),)], "body string")
    assert [r.rate for r in readers.parsed_rate_response(body).collect()] == [0.05, None]
    (tmp_path / "constituency_2024-01-01.csv").write_text("Ticker,name\nbrk.b,x\nGOOG,y\n,z\n")
    assert sorted(r.symbol for r in readers.snapshots(spark, str(tmp_path)).collect()) == ["BRK", "GOOG"]
    assert sorted(r.symbol for r in readers.snapshots(spark, str(tmp_path), strict=True).collect()) == ["BRK.B", "GOOG"]
    with pytest.raises(ValueError, match="no snapshots"):
        readers.snapshots(spark, str(tmp_path / "none"), strict=True)


def test_vendor_source(spark, tmp_path):
    (tmp_path / "A.N.json").write_text(json.dumps([{"symbol": "A", "trade_date": "2024-01-02", "close": 1.5}]))
    spark.dataSource.register(readers.VendorSource)
    got = spark.read.format("vendor").option("fixture", str(tmp_path)).option("symbols", "A.X|A.N,B.N").load().collect()
    assert [tuple(r) for r in got] == [("A", "2024-01-02", 1.5)]


def test_day_partitions_and_backup(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(D(2024, 1, 2), "B", 1), (D(2024, 1, 3), "A", 2), (None, "C", 3)], "trade_date date, underlying string, x int")
    sinks.require_writable(spark, out)
    sinks.write_days(df, out)
    sinks.write_days(df.filter("x = 1").withColumn("x", F.lit(9)), out)
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [2, 9]
    assert sinks.backup_once(spark, out, str(tmp_path / "old")) and not sinks.backup_once(spark, out, str(tmp_path / "old"))
    sinks.report(df.limit(0), str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report")).count() == 0
    sinks.swap(spark, str(tmp_path / "old"), out)
    assert not sinks.exists(spark, str(tmp_path / "old")) and sinks.exists(spark, out)


def test_stream_follows_new_days(spark, tmp_path):
    raw, out, mark = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "mark")
    build = lambda batch: batch.groupBy("trade_date").agg(F.sum("volume").alias("volume"))
    for k in (2, 3):
        day_file(raw, D(2024, 1, k), [("T", k), ("U", 1)])
        incremental.follow(spark, str(raw), mark, build, out).awaitTermination()
    assert {r.trade_date: r.volume for r in spark.read.parquet(out).collect()} == {D(2024, 1, 2): 3, D(2024, 1, 3): 4}


def test_pending_days_without_checkpoint(spark):
    days = spark.createDataFrame([(D(2024, 1, 2),), (D(2024, 1, 3),)], "trade_date date")
    none = days.limit(0)
    assert [r.trade_date for r in incremental.pending_days(days, none, none).collect()] == [D(2024, 1, 3)]


def test_histories_of_mixed_layouts(spark, tmp_path):
    (tmp_path / "A_stock_data.csv").write_text("Date,dividend_yield,Open,Close\n2024-01-02,0.1,1,5\n2024-01-02,0.2,1,6\n")
    (tmp_path / "b_stock_data.csv").write_text('\ufeffname,Close,day of date,dividend_yield\r\n"x, y",7,1/3/2024,\r\n')
    (tmp_path / "C_stock_data.csv").write_text("Date,Open\n2024-01-02,1\n")
    (tmp_path / "D_stock_data.csv").write_text("")
    got = readers.stock_history(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [("A", D(2024, 1, 2), 5.0, 0.1, 1), ("A", D(2024, 1, 2), 6.0, 0.2, 2), ("B", D(2024, 1, 3), 7.0, 0.0, 1)]
    assert sorted(r.symbol for r in readers.stock_symbols(spark, str(tmp_path)).collect()) == ["A", "B", "C"]  # Spark lists no files without a byte
    rows = spark.createDataFrame([("A", D(2024, 1, 2))], "underlying string, trade_date date")
    assert [(r.underlying_close, r.dividend_yield) for r in joins.with_stock_data(rows, got).collect()] == [(6.0, 0.2)]


def test_optional_and_probed_files(spark, tmp_path):
    assert readers.optional(spark, str(tmp_path / "none"), "a string").count() == 0
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 and nothing more")
    assert readers.optional(spark, str(tmp_path / "broken.parquet"), "a string", "parquet").count() == 0
    day_file(tmp_path / "raw", D(2024, 1, 2), [("T", 1), ("U", 2)])
    day_file(tmp_path / "raw", D(2024, 1, 3), [])
    with gzip.open(tmp_path / "raw/2024-01-04.csv.gz", "wt"):
        pass
    got = {r.item[-17:-7]: (r.header.split(",")[0], r.rows) for r in readers.probed(spark, str(tmp_path / "raw")).collect()}
    assert got == {"2024-01-02": ("ticker", 2), "2024-01-03": ("ticker", 0), "2024-01-04": ("", 0)}
    assert sorted(r.trade_date for r in readers.completed_days(spark, str(tmp_path / "raw")).collect()) == [D(2024, 1, k) for k in (2, 3, 4)]


def test_vendor_batches_wait_when_throttled():
    class Busy(readers._VendorReader):
        asked = 0

        def request(self, candidate):
            Busy.asked += 1
            if Busy.asked < 3:
                raise readers.Throttled
            return [{"symbol": candidate}] if candidate != "none" else []

    reader = Busy({"symbols": ",".join(f"S{k}" for k in range(23)), "pause": "0"}, ["symbol"])
    parts = reader.partitions()
    assert [len(str(p.value).split(",")) for p in parts] == [10, 10, 3]
    assert list(reader.read(readers.InputPartition("none|A,B"))) == [("A",), ("B",)] and Busy.asked == 5
    Busy.asked = -9
    with pytest.raises(readers.Throttled):
        list(reader.read(readers.InputPartition("A")))


def test_rate_files_and_key(spark, tmp_path, monkeypatch):
    (tmp_path / "r.json").write_text(json.dumps({"observations": [{"date": "2024-01-02", "value": "5"}]}))
    assert [tuple(r) for r in readers.rate_responses(spark, str(tmp_path)).collect()] == [(D(2024, 1, 2), 0.05)]
    monkeypatch.delenv("RATE_KEY", raising=False)
    with pytest.raises(OSError, match="RATE_KEY"):
        readers.rate_key()
    monkeypatch.setenv("RATE_KEY", " k ")
    assert readers.rate_key() == "k"


def test_flattened_and_silent_answers(spark):
    df = spark.sql("SELECT struct(1 AS Open, 2 AS Close) AS AAPL, 3 AS ` Date `")
    assert readers.flattened(df).columns == ["AAPL_Open", "AAPL_Close", "Date"]
    rows = spark.createDataFrame([(D(2024, 1, 1), 1, None, None, "x"), (D(2024, 1, 1), 2, "A.N", "A", "y")], "snapshot_date date, request int, ric string, ticker string, name string")
    members, mute = readers.snapshot_rows(rows)
    assert [r.ticker for r in members.collect()] == ["A"] and [r.request for r in mute.collect()] == [1]


def test_a_broken_swap_is_recovered(spark, tmp_path):
    (tmp_path / "live.old").mkdir()
    (tmp_path / "live.old" / "x").write_text("old")
    assert sinks.recovered(spark, str(tmp_path / "live")) and (tmp_path / "live" / "x").read_text() == "old"
    (tmp_path / "new").mkdir()
    sinks.swap(spark, str(tmp_path / "new"), str(tmp_path / "live"))
    assert not (tmp_path / "live.old").exists() and not (tmp_path / "live" / "x").exists()
    with pytest.raises(OSError, match="absent"):
        sinks.swap(spark, str(tmp_path / "absent"), str(tmp_path / "live"))
    assert (tmp_path / "live").exists()


def test_stored_fixtures_are_read(spark, tmp_path):
    from volsurf import fixtures

    fixtures.write(spark, "/root/testdata/sf0.001", str(tmp_path), "rates")
    spark.conf.set(fixtures.STORED, str(tmp_path))
    try:
        assert fixtures.load(spark, "/nowhere", "rates").count() > 0
    finally:
        spark.conf.unset(fixtures.STORED)


def text_file(path, text, cut=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    body = gzip.compress(text.encode()) if path.suffix == ".gz" else text.encode()
    path.write_bytes(body[:cut] if cut else body)


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    text_file(tmp_path / "a b/2024-01-02.csv.gz", "ticker,volume,close\nA,1,1.5\nB,,x\n")
    text_file(tmp_path / "2024-01-03.csv.gz", '﻿close, Volume ,note,TICKER,ticker\r\n2.5,7,"x, y",C,wrong\r\n')
    text_file(tmp_path / "2024-01-04.csv.gz", "ticker,volume,close\n")
    text_file(tmp_path / "2024-01-05.csv.gz", "")
    got = readers.raw_days(spark, str(tmp_path)).collect()
    assert sorted(((r.trade_date.day, r.ticker, r.volume, r.close, r.open) for r in got), key=str) == [(2, "A", 1, 1.5, None), (2, "B", None, None, None), (3, "C", 7, 2.5, None)]
    assert readers.raw_days(spark, str(tmp_path / "none")).count() == 0
    assert [r.ticker for r in readers.raw_days(spark, str(tmp_path), "2024-01-03", "2024-01-03").collect()] == ["C"]


def test_a_broken_file_costs_only_itself(spark, tmp_path):
    line = "".join(f"T{k},{k},{k * 7919 % 977}.5\n" for k in range(3000))
    text_file(tmp_path / "2024-01-02.csv.gz", f"ticker,volume,close\n{line}")
    text_file(tmp_path / "2024-01-03.csv.gz", f"ticker,volume,close\n{line}", cut=9000)
    text_file(tmp_path / "2024-01-04.csv.gz", "ticker,volume,close\nA,1,1")
    (tmp_path / "2024-01-05.csv.gz").write_bytes(b"no gzip file at all")
    ledger = str(tmp_path / "ledger")
    files = {r.trade_date.day: (r.rows if r.error is None else None, r.error) for r in readers.raw_files(spark, str(tmp_path), ledger=ledger).collect()}
    assert files == {2: (3000, None), 3: (None, "truncated"), 4: (1, None), 5: (None, "damaged")}
    got = readers.raw_days(spark, str(tmp_path), ledger=ledger).groupBy("trade_date").count().collect()
    assert sorted((r.trade_date.day, r["count"]) for r in got) == [(2, 3000), (4, 1)]
    issues = quality.raw_file_issues(readers.raw_files(spark, str(tmp_path), ledger=ledger).select(F.col("path").alias("item"), "header", "rows", "error").filter("error is not null")).collect()
    assert sorted(i.message for i in issues) == ["unreadable: damaged", "unreadable: truncated"]
    entries = spark.read.parquet(ledger).count()
    # a mended file is inspected again, the others aren't
    text_file(tmp_path / "2024-01-03.csv.gz", "ticker,volume,close\nB,2,2\n")
    assert readers.raw_days(spark, str(tmp_path), "2024-01-03", ledger=ledger).count() == 2
    assert entries == 4 and spark.read.parquet(ledger).count() == 5


def test_heads_stop_early(spark, tmp_path):
    text_file(tmp_path / "2024-01-02.csv.gz", "volume,ticker\n" + "".join(f"{k},T{k}\n" for k in range(20000)))
    text_file(tmp_path / "2024-01-03.csv.gz", "ticker,volume\nA,x\n")
    got = sorted((r.trade_date.day, r.ordinal, r.ticker, r.volume) for r in readers.raw_heads(spark, str(tmp_path), 3).collect())
    assert got == [(2, 0, "T0", 0), (2, 1, "T1", 1), (2, 2, "T2", 2), (3, 0, "A", None)]
    assert [i.message for i in quality.raw_issues(readers.raw_heads(spark, str(tmp_path), 3), "2024-01-03").collect()].count("volume has nulls") == 1
    assert readers.raw_heads(spark, str(tmp_path / "none")).count() == 0


def test_snapshots_by_name_and_optional_files(spark, tmp_path):
    text_file(tmp_path / "constituency_2024-01-01.csv", "ticker,name,RIC\nAAA,x,A\nBBB,y,B\n")
    text_file(tmp_path / "constituency_2024-02-01.csv", "name,RIC,Ticker\nx,A,AAA.N\n")
    text_file(tmp_path / "constituency_2024-03-01.csv", "name,RIC\nx,A\n")
    text_file(tmp_path / "constituency_notes.csv", "ticker\nZZZ\n")
    assert sorted((r.snapshot_date.month, r.symbol) for r in readers.snapshots(spark, str(tmp_path)).collect()) == [(1, "AAA"), (1, "BBB"), (2, "AAA")]
    (tmp_path / "t").mkdir()
    spark.range(5).write.parquet(str(tmp_path / "t/good"))
    (tmp_path / "t/good/part-bad.parquet").write_bytes(b"PAR1 and nothing more")
    assert readers.optional(spark, str(tmp_path / "t/good"), "id long", "parquet").count() == 5


def test_versions(spark, tmp_path):
    table = versions.Table(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(D(2024, 1, k), f"S{k}", k) for k in (2, 3)] + [(None, "x", 0)], "trade_date date, underlying string, x int")
    assert table.newest() == 0 and table.read(rows.schema).count() == 0 and table.manifest().count() == 0
    assert table.write_days(rows, 0, days=spark.createDataFrame([(D(2024, 1, 2), 7), (D(2024, 1, 9), 8)], "trade_date date, source_version long"), marks={"stream": "a", "batch": 1}) == 1
    assert {(m.trade_date.day, m.source_version, m.rows) for m in table.manifest().collect()} == {(2, 7, 1), (3, None, 1), (9, 8, 0)}
    assert table.write_days(rows.filter("x = 3").withColumn("x", F.lit(30)), 1) == 2
    assert sorted(r.x for r in table.read(rows.schema).collect()) == [2, 30] and sorted(r.x for r in table.read(rows.schema, 1).collect()) == [2, 3]
    # two runs from one version: the later one loses, and no reader sees its folder
    with pytest.raises(versions.Conflict):
        table.write_days(rows.withColumn("x", F.lit(99)), 1)
    assert sorted(r.x for r in table.read(rows.schema).collect()) == [2, 30]
    assert table.marked(stream="a") and not table.marked(stream="a", batch=2)

    # a run that dies between its data and its commit leaves the table as it was, and can be repeated
    def dies(folder):
        rows.write.parquet(folder)
        raise OSError("killed")

    with pytest.raises(OSError, match="killed"):
        table.publish(dies, 2)
    assert sorted(r.x for r in table.read(rows.schema).collect()) == [2, 30]
    # a commit that was left half written is none, and its number is not used again
    (tmp_path / "t/log/000000000003.json").write_text('{"shards": [')
    assert table.newest() == 3 and sorted(r.x for r in table.read(rows.schema).collect()) == [2, 30]
    assert table.publish(lambda folder: rows.write.parquet(folder), 3) == 4 and table.read(rows.schema).count() == 3
    assert len(table.vacuum()) == 4 and table.read(rows.schema).count() == 3
    assert table.append(rows.limit(1), 4) == 5 and table.read(rows.schema).count() == 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    raw, table = tmp_path / "raw", versions.Table(spark, str(tmp_path / "t"))
    build = lambda batch: batch.groupBy("trade_date").agg(F.sum("volume").alias("volume"))
    for k in (2, 3):
        day_file(raw, D(2024, 1, k), [("T", k), ("U", 1)])
    incremental.follow_table(spark, str(raw), str(tmp_path / "mark"), build, table).awaitTermination()
    schema = "trade_date date, volume long"
    assert {r.trade_date.day: r.volume for r in table.read(schema).collect()} == {2: 3, 3: 4} and table.newest() == 1
    # the stream died before its checkpoint knew of the commit
    shutil.rmtree(tmp_path / "mark/commits")
    incremental.follow_table(spark, str(raw), str(tmp_path / "mark"), build, table).awaitTermination()
    assert table.newest() == 1
    text_file(raw / "2024-01-04.csv.gz", "volume,ticker\n5,T\n")
    incremental.follow_table(spark, str(raw), str(tmp_path / "mark"), build, table).awaitTermination()
    assert {r.trade_date.day: r.volume for r in table.read(schema).collect()} == {2: 3, 3: 4, 4: 5} and table.newest() == 2


def test_repairs_of_a_stream(spark, tmp_path):
    table = versions.Table(spark, str(tmp_path / "ledger"))
    found = spark.createDataFrame([(D(2024, 1, 2), "A"), (D(2024, 1, 2), "B"), (D(2024, 1, 3), "A")], "trade_date date, symbol string")
    found.write.parquet(str(tmp_path / "found"))
    asked = []

    def repair(pairs):
        asked.append(sorted((r.trade_date.day, r.symbol) for r in pairs.collect()))
        return maintenance.ledger_entries({"repaired": pairs.filter("symbol = 'A'"), "failed": pairs.filter("symbol != 'A'")})

    run = lambda: incremental.follow_repairs(spark.readStream.schema(found.schema).parquet(str(tmp_path / "found")), str(tmp_path / "mark"), table, repair).awaitTermination()
    run()
    shutil.rmtree(tmp_path / "mark/commits")
    run()
    assert asked == [[(2, "A"), (2, "B"), (3, "A")]]
    assert incremental.repair_batch(found, 0, table, repair, "repairs") is None
    # a later batch with the same pairs tries only those that no repair has finished
    incremental.repair_batch(found, 7, table, repair, "repairs")
    assert asked[1:] == [[(2, "B")]]


def test_a_run_that_died_between_its_tables_is_continued(spark, tmp_path):
    rows = spark.createDataFrame([(D(2024, 1, k), "S", float(k)) for k in (2, 3)], "trade_date date, underlying string, x double")
    contracts, table = versions.Table(spark, str(tmp_path / "c")), versions.Table(spark, str(tmp_path / "f"))
    sources = rows.select("trade_date", F.lit(1).cast("long").alias("source_version"))
    built = []

    def build(part):
        built.append(part.count())
        return part

    def broken(_):
        raise OSError("killed")

    run = lambda f, s=sources: runs.daily_run(lambda days: rows.join(days, "trade_date", "left_semi"), s, contracts, table, build, f, rows.schema, rows.schema)
    with pytest.raises(OSError, match="killed"):
        run(broken)
    got = run(lambda part: part)
    assert built == [2, 0] and (got.contracts_version, got.features_version) == (1, 1) and got.lost.count() == 0
    assert table.read(rows.schema).count() == 2
    newer = sources.withColumn("source_version", F.when(F.dayofmonth("trade_date") == 3, 2).otherwise(1).cast("long"))
    got = run(lambda part: part.filter("x < 3"), newer)
    assert built == [2, 0, 1] and [(r.trade_date.day, r.underlying) for r in got.lost.collect()] == [(3, "S")]
    assert got.counters.values()["contracts"] == {"rows": 1, "undated": 0} and table.read(rows.schema).count() == 1
    # nothing is due: nothing is committed
    again = run(lambda part: part, newer)
    assert (again.contracts_version, again.features_version) == (2, 2) and again.counters.values() == {}


def test_undated_rows_are_counted(spark, tmp_path):
    df = spark.createDataFrame([(D(2024, 1, 2), "B"), (None, "C")], "trade_date date, underlying string")
    with pytest.warns(UserWarning, match="1 rows without"):
        assert sinks.write_days(df, str(tmp_path / "out")) == {"written": 1, "undated": 1}
