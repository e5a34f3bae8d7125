"""Readers of raw days, stock histories, rates and snapshots, and a pluggable vendor source."""

from __future__ import annotations

import contextlib
import csv
import json
import os
import re
import time
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..functions.symbols import exploded_members, index_ticker, simple_ticker
from ..schemas import RAW_OPTION_DAY, STOCK_HISTORY
from . import csv_files


def day_of_file(path: Column) -> Column:
    """The date in a file's name; null if there is none."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})\.csv(?:\.gz)?$", 1), F.lit("")), "yyyy-MM-dd")


def raw_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, strict: bool = False, ledger: str | None = None) -> DataFrame:
    """Raw day files below a folder, with trade_date from their names; both bounds count, each is optional.

    Columns are found by name, file by file.  Files out of range are not opened.
    Unreadable names fail the call if ``strict``, and are skipped otherwise.
    With a ``ledger`` (a folder) files are inspected first, and damaged ones left
    out whole; see ``raw_files``.
    """
    files = raw_files(spark, path, start, end, strict, ledger)
    layouts = csv_files.sound(files) if ledger else csv_files.headers(spark, [r.path for r in files.select("path").collect()])
    return dated_rows(spark, layouts)


def dated_rows(spark: SparkSession, layouts: dict[str, list[str]]) -> DataFrame:
    """The rows of raw day files by layout (see ``csv_files``), with trade_date and ordinal."""
    rows = csv_files.by_name(spark, layouts, RAW_OPTION_DAY)
    # an order within a file, for rules such as "the first row of equals"
    return rows.withColumn("trade_date", day_of_file(F.col("_file"))).drop("_file").withColumn("ordinal", F.monotonically_increasing_id())


def raw_files(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, strict: bool = False, ledger: str | None = None) -> DataFrame:
    """(path, length, modified, trade_date) of the raw day files in range; with a ledger also header, rows and error."""
    files = csv_files.listed(spark, path).withColumn("trade_date", day_of_file(F.col("path")))
    if strict:
        odd = files.filter("trade_date is null").select("path").orderBy("path").first()
        if odd:
            raise ValueError(f"no date in {odd.path}")
    files = files.filter("trade_date is not null")
    if start:
        files = files.filter(F.col("trade_date") >= F.lit(start).cast("date"))
    if end:
        files = files.filter(F.col("trade_date") <= F.lit(end).cast("date"))
    return csv_files.ledgered(spark, files.drop("trade_date"), ledger).withColumn("trade_date", day_of_file(F.col("path"))) if ledger else files


def raw_heads(spark: SparkSession, path: str, rows: int = 1000, start: str | None = None, end: str | None = None) -> DataFrame:
    """The first rows of each raw day file, as ``raw_days`` has them; reading stops behind them.

    ``ordinal`` is a row's place in its file.
    """
    files = [r.path for r in raw_files(spark, path, start, end).select("path").collect()]
    if not files:
        return dated_rows(spark, {})
    # of a file's head the lines go on as text, each to be parsed by its own header
    lines = csv_files.prefixes(spark, files, rows + 1)
    fields = StructType.fromDDL(RAW_OPTION_DAY)
    parsed = F.when(F.lit(False), F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields)))
    for (header,) in lines.filter("n = 0").select("header").distinct().collect():
        names = [c.lower() for c in csv_files.columns_of(header)]
        line = F.from_csv("line", ", ".join(f"_{k} string" for k in range(len(names))), {"mode": "PERMISSIVE"})
        values = [(line[f"_{names.index(f.name)}"] if f.name in names else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in fields]
        parsed = parsed.when(F.col("header") == header, F.struct(*values))
    found = lines.filter("n > 0").select("path", "n", parsed.alias("p"))
    return found.select("p.*", day_of_file(F.col("path")).alias("trade_date"), (F.col("n") - 1).alias("ordinal"))


def listed_days(spark: SparkSession, path: str) -> DataFrame:
    """(path, trade_date) of the raw files below a folder, in order of their paths; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv.gz").load(path)
    return files.select("path", day_of_file(F.col("path")).alias("trade_date")).orderBy("path")


def every_nth(files: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th file, from the first one, in the order of their paths."""
    return files.withColumn("_n", F.row_number().over(Window.orderBy("path")) - 1).filter(F.col("_n") % stride == 0).drop("_n")


def completed_days(spark: SparkSession, path: str) -> DataFrame:
    """(trade_date) of the day files below a folder, from their names; contents stay unread, other names are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").load(path)
    return files.select(day_of_file(F.col("path")).alias("trade_date")).dropna().distinct()


def raw_span(raw: DataFrame) -> DataFrame:
    """(low, high): the first and the last raw day."""
    return raw.agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high"))


def newest_day(raw: DataFrame) -> DataFrame:
    """The rows of the newest raw day."""
    newest = raw.agg(F.max("trade_date").alias("trade_date"))
    # one row
    return raw.join(F.broadcast(newest), "trade_date", "left_semi")


def first_files(files: DataFrame, n: int) -> DataFrame:
    """The first n files in the order of their paths."""
    return files.orderBy("path").limit(n)


def probed(spark: SparkSession, path: str, glob: str = "*.csv.gz") -> DataFrame:
    """(item, header, rows) of every text file below a folder: its first line and how many follow.

    A file without content has an empty header; files without a single byte are not listed by Spark.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select(F.col("path").alias("item"), "length")
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path).select(F.col("_metadata.file_path").alias("item"), "value", F.monotonically_increasing_id().alias("n"))
    seen = lines.groupBy("item").agg(F.min_by("value", "n").alias("header"), (F.count("*") - 1).alias("rows"))
    return listed.join(seen, "item", "left").select("item", F.coalesce("header", F.lit("")).alias("header"), F.coalesce("rows", F.lit(0)).alias("rows"))


def find_column(columns: Sequence[str], names: Sequence[str], contains: str | None = None) -> str | None:
    """A column by any of several names, whatever its case, blanks, dots and underscores; else one that contains a word."""
    plain = lambda x: re.sub(r"[\s._]", "", x).lower()
    by = {plain(c): c for c in reversed(columns)}
    for n in names:
        if plain(n) in by:
            return by[plain(n)]
    return next((c for c in columns if contains and contains in c.lower()), None)


def _number(text: Column) -> Column:
    return F.trim(text.cast("string")).try_cast("double")


def _day(value: Column) -> Column:
    """A date from any of the forms in which histories and rates come; null if none fits."""
    text = F.trim(value.cast("string"))
    forms = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXXX")
    days = [F.try_to_date(text, f) for f in ("yyyy-MM-dd", "M/d/yyyy", "yyyy/MM/dd", "yyyyMMdd", "d-MMM-yyyy", "MMM d, yyyy")]
    # the written day counts, whatever the zone behind it
    return F.coalesce(days[0], *(F.when(F.try_to_timestamp(text, F.lit(f)).isNotNull(), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")) for f in forms), *days[1:])


def history_columns(columns: Sequence[str]) -> tuple[str, str, str | None] | None:
    """(date, close, yield) columns of a history; None without a close.

    The unadjusted close is preferred; else the first column with "close" in its
    name that isn't the date.
    """
    if not columns:
        return None
    day = next((c for c in columns if "date" in c.lower()), columns[0])
    close = find_column([c for c in columns if c != day], ["TR.CLOSEPRICE(Adjusted=0)"], "close")
    return (day, close, next((c for c in columns if c.lower() == "dividend_yield"), None)) if close else None


def _clean_yield(text: Column) -> Column:
    return F.greatest(F.coalesce(F.nanvl(_number(text), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def resolved_history(df: DataFrame, symbol: Column) -> DataFrame:
    """Any history table as (symbol, trade_date, close, dividend_yield); missing or negative yields are 0."""
    found = history_columns(df.columns)
    if found is None:
        return df.sparkSession.createDataFrame([], STOCK_HISTORY)
    day, close, yields = (F.col(f"`{c}`") if c else None for c in found)
    y = _clean_yield(yields) if yields is not None else F.lit(0.0)
    return df.select(symbol.alias("symbol"), _day(day).alias("trade_date"), _number(close).alias("close"), y.alias("dividend_yield")).dropna(subset=["trade_date", "close"])


_HISTORY_FILE = r"^(.*)_stock_data\.csv$"


def stock_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(symbol) of the history files of a folder, from their names."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*_stock_data.csv").load(path)
    except AnalysisException:
        return spark.createDataFrame([], "symbol string")
    return files.select(F.upper(F.regexp_extract(F.element_at(F.split("path", "/"), -1), _HISTORY_FILE, 1)).alias("symbol")).distinct()


def stock_history(spark: SparkSession, path: str) -> DataFrame:
    """All ``{SYMBOL}_stock_data.csv`` files of a folder as (symbol, trade_date, close, dividend_yield, ordinal).

    Every file is read by its own header, so layouts may be mixed; ``ordinal``
    is a row's place in its file, by which the last row of a day is known.  A
    file holds one symbol's history and is small enough for one row.  There are
    few headers: only they reach the driver.
    """
    try:
        files = spark.read.option("pathGlobFilter", "*_stock_data.csv").text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], f"{STOCK_HISTORY}, ordinal long")
    symbol = F.upper(F.regexp_extract(F.col("_metadata.file_name"), _HISTORY_FILE, 1))
    return parsed_histories(files.select(symbol.alias("symbol"), F.col("value").alias("body")))


def parsed_histories(files: DataFrame) -> DataFrame:
    """The rows of history files (symbol, body), each read by its own header; see ``stock_history``."""
    spark, schema = files.sparkSession, f"{STOCK_HISTORY}, ordinal long"
    body = F.regexp_replace(F.regexp_replace("body", "^\ufeff", ""), "\r", "")
    files = files.select("symbol", body.alias("body")).withColumn("header", F.substring_index("body", "\n", 1))
    known = []
    for (header,) in files.select("header").distinct().collect():
        columns = [c.strip() for c in next(csv.reader([header]), [])]
        found = history_columns(columns)
        if found:
            known.append((header, columns, found))
    if not known:
        return spark.createDataFrame([], schema)
    rows = files.select("symbol", "header", F.posexplode(F.split("body", "\n")).alias("ordinal", "line")).filter("ordinal > 0 and trim(line) != ''")
    parsed = F
    for header, columns, found in known:
        line = F.from_csv("line", ", ".join(f"c{k} string" for k in range(len(columns))), {"mode": "PERMISSIVE"})
        day, close, yields = (line[f"c{columns.index(c)}"] if c else F.lit(None).cast("string") for c in found)
        parsed = parsed.when(F.col("header") == header, F.struct(day.alias("day"), close.alias("close"), yields.alias("y")))
    rows = rows.withColumn("p", parsed).filter("p is not null")
    out = rows.select("symbol", _day(F.col("p.day")).alias("trade_date"), _number(F.col("p.close")).alias("close"), _clean_yield(F.col("p.y")).alias("dividend_yield"), F.col("ordinal").cast("long"))
    return out.dropna(subset=["trade_date", "close"])


def resolved_rates(df: DataFrame, series: str | None = None) -> DataFrame:
    """Any rate table as (rate_date, rate): decimal columns first, percentages divided by 100, optionally one series."""
    lower = {c.lower(): c for c in df.columns}
    day = lower.get("date", df.columns[0])
    decimal = next((lower[c] for c in ("risk_free_rate", "rate") if c in lower), None)
    percent = next((lower[c] for c in ("risk_free_rate_percent", "value") if c in lower), None)
    if decimal is None and percent is None:
        raise ValueError("no rate column")
    if series and "series_id" in lower:
        df = df.filter(F.col(lower["series_id"]) == series)
    rate = _number(F.col(f"`{decimal}`")) if decimal else _number(F.col(f"`{percent}`")) / 100
    return df.select(_day(F.col(f"`{day}`")).alias("rate_date"), rate.alias("rate")).dropna().orderBy("rate_date")


def snapshots(spark: SparkSession, path: str, strict: bool = False, ledger: str | None = None) -> DataFrame:
    """``constituency_YYYY-MM-DD.csv`` files of a folder as (snapshot_date, symbol).

    Every file's ticker column is found by its own header; files without one,
    without a date or without rows give no members, and with a ``ledger`` (a
    folder) neither do damaged ones.  ``strict`` keeps tickers as they are but
    for case and blanks, and fails without any snapshot; otherwise they are cut
    as index tickers are.
    """
    files = csv_files.listed(spark, path, "constituency_*.csv*", recursive=False)
    layouts = csv_files.sound(csv_files.ledgered(spark, files, ledger)) if ledger else csv_files.headers(spark, [r.path for r in files.select("path").collect()])
    layouts = csv_files.having(layouts, "ticker")
    if strict and not layouts:
        raise ValueError(f"no snapshots in {path}")
    rows = csv_files.by_name(spark, layouts, "ticker string")
    name = simple_ticker(F.col("ticker")) if strict else index_ticker(F.col("ticker"))
    return rows.select(day_of_file(F.col("_file")).alias("snapshot_date"), name.alias("symbol")).dropna().filter("symbol != ''").distinct()


def optional(spark: SparkSession, path: str, schema: StructType | str, form: str = "csv") -> DataFrame:
    """A table that may be absent or hold files that can't be read: these give no rows, the others do."""
    try:
        return spark.read.schema(schema).option("header", True).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).format(form).load(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def has_columns(df: DataFrame, required: Sequence[str]) -> bool:
    return set(required) <= set(df.columns)


def parsed_rate_response(df: DataFrame, column: str = "body") -> DataFrame:
    """(rate_date, rate) from JSON answers {"observations": [{"date", "value"}]}; values that are no numbers are null."""
    body = F.from_json(column, "observations array<struct<date: string, value: string>>")
    each = df.select(F.explode(body["observations"]).alias("o"))
    return each.select(F.try_to_date(F.col("o.date"), "yyyy-MM-dd").alias("rate_date"), (F.expr("try_cast(o.value AS double)") / 100).alias("rate"))


def rate_responses(spark: SparkSession, path: str) -> DataFrame:
    """(rate_date, rate) from files that hold one JSON answer each."""
    return parsed_rate_response(spark.read.text(path, wholetext=True).withColumnRenamed("value", "body"))


def rate_key() -> str:
    """The key of the rate service, from the environment alone."""
    key = os.environ.get("RATE_KEY", "").strip()
    if not key:
        raise OSError("RATE_KEY is not set")
    return key


def snapshot_rows(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of index snapshots from the answers to several request shapes.

    ``responses``: snapshot_date, request (its number), ric, ticker, name, whose
    cells may hold several values.  Of a snapshot's requests the first that names
    a ticker counts: (snapshot_date, ticker, original_ric, name).  The second
    table has the rows of answers that named none, for debugging.
    """
    rows = exploded_members(responses.withColumn("_order", F.xxhash64("ric", "ticker", "name")), "ric", "ticker", "name", "_order")
    first = rows.groupBy("snapshot_date").agg(F.min("request").alias("request"))
    members = rows.join(first, ["snapshot_date", "request"]).select("snapshot_date", "ticker", "original_ric", "name").dropDuplicates(["snapshot_date", "ticker"])
    mute = responses.join(rows.select("snapshot_date", "request").distinct(), ["snapshot_date", "request"], "left_anti")
    return members, mute


def first_usable_histories(targets: DataFrame, answers: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Histories of repair targets from the answers to their candidate codes, and a report of what became of each target.

    ``targets``: symbol, codes (an array, in order of trust), start, end.
    ``answers``: ric, trade_date, close, dividends as texts.  ``errors``: ric,
    error, for requests that failed.  Of a target's codes the first counts that
    has a row with a readable date in range and a readable close; equal days
    keep their greatest row.  First table: (symbol, ric, trade_date, close,
    dividends); second: (symbol, ric, rows, error), where error names the last
    code that was tried and what was wrong with it, null for a target with rows.
    """
    tried = targets.select("symbol", "start", "end", F.posexplode("codes").alias("_k", "ric"))
    rows = answers.select("ric", _day(F.col("trade_date")).alias("trade_date"), F.nanvl(_number(F.col("close")), F.lit(None).cast("double")).alias("close"), F.coalesce(_number(F.col("dividends")), F.lit(0.0)).alias("dividends")).dropna(subset=["trade_date", "close"])
    usable = tried.join(rows, "ric").filter(F.col("trade_date").between(F.col("start"), F.col("end")))
    usable = usable.groupBy("symbol", "_k", "ric", "trade_date").agg(F.max(F.struct("close", "dividends")).alias("_r"))
    first = usable.groupBy("symbol").agg(F.min("_k").alias("_k"))
    histories = usable.join(first, ["symbol", "_k"]).select("symbol", "ric", "trade_date", "_r.close", "_r.dividends")
    found = histories.groupBy("symbol").agg(F.first("ric").alias("ric"), F.count("*").alias("rows"))
    # a target fails with the last of its codes
    said = tried.join(errors.groupBy("ric").agg(F.min("error").alias("error")), "ric", "left")
    last = said.groupBy("symbol").agg(F.max_by(F.concat("ric", F.lit(": "), F.coalesce("error", F.lit("no usable rows"))), "_k").alias("_said"))
    report = targets.select("symbol").join(found, "symbol", "left").join(last, "symbol", "left")
    error = F.when(F.col("rows").isNull(), F.coalesce("_said", F.lit("no candidate codes")))
    return histories, report.select("symbol", "ric", F.coalesce("rows", F.lit(0)).alias("rows"), error.alias("error"))


#: Days before the first price day from which dividends are fetched, so that the first trailing sum is whole.
DIVIDEND_LEAD = 370


def dividend_events(rows: DataFrame, start: str, end: str) -> DataFrame:
    """(symbol, trade_date, dividends) from vendor rows: the lead-in before ``start`` included, what is no number counts 0."""
    days = rows.select("symbol", _day(F.col("trade_date")).alias("trade_date"), F.coalesce(_number(F.col("dividends")), F.lit(0.0)).alias("dividends"))
    return days.filter(F.col("trade_date").between(F.date_sub(F.lit(start).cast("date"), DIVIDEND_LEAD), F.lit(end).cast("date")))


def flattened(df: DataFrame) -> DataFrame:
    """Columns of structs as columns of their own, named by both levels; other names are trimmed."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            out += [F.col(f"`{f.name}`").getField(x).alias("_".join(p.strip() for p in (f.name, x) if p.strip())) for x in f.dataType.fieldNames()]
        else:
            out.append(F.col(f"`{f.name}`").alias(f.name.strip()))
    return df.select(*out)


class Throttled(Exception):
    """The vendor asks to wait."""


class VendorSource(DataSource):
    """``spark.read.format("vendor")``: rows that a request for each symbol returns.

    Options: ``fixture``, a folder of JSON files named by symbol, for runs
    without a network; ``symbols``, comma-separated; ``fields``, the schema as
    DDL.  Credentials come from the environment alone (VENDOR_KEY).  A subclass
    overrides ``request``; of a symbol's candidates the first with rows wins.
    With ``push`` true (and spark.sql.python.filterPushdown.enabled in the
    session) conditions on symbols and on days shrink the requests.
    """

    @classmethod
    def name(cls) -> str:
        return "vendor"

    def schema(self) -> str:
        return self.options.get("fields", "symbol string, trade_date string, close double")

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = _PushingReader if self.options.get("push", "").lower() == "true" else _VendorReader
        return kind(dict(self.options), schema.fieldNames())


class _VendorReader(DataSourceReader):
    """BATCH symbols a task; a throttled request is repeated after a pause, ``attempts`` times at most."""

    BATCH, PAUSE, ATTEMPTS = 10, 300.0, 5

    def __init__(self, options: dict, fields: list[str]):
        self.options, self.fields, self.key = options, fields, os.environ.get("VENDOR_KEY")

    def partitions(self) -> list[InputPartition]:
        symbols = [s for s in self.options.get("symbols", "").split(",") if s]
        size = int(self.options.get("batch", self.BATCH))
        return [InputPartition(",".join(symbols[at : at + size])) for at in range(0, len(symbols), size)]

    def request(self, candidate: str) -> list[dict]:
        try:
            with open(os.path.join(self.options["fixture"], f"{candidate}.json")) as f:
                return json.load(f)
        except (KeyError, OSError, ValueError):
            return []

    def patient(self, candidate: str) -> list[dict]:
        for attempt in range(int(self.options.get("attempts", self.ATTEMPTS))):
            if attempt:
                time.sleep(float(self.options.get("pause", self.PAUSE)))
            with contextlib.suppress(Throttled):
                return self.request(candidate)
        raise Throttled(candidate)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for symbol in str(partition.value).split(","):
            rows = next(filter(None, map(self.patient, symbol.split("|"))), [])
            yield from (tuple(r.get(f) for f in self.fields) for r in rows)


class _PushingReader(_VendorReader):
    """A reader whose requests shrink with the query: of ``symbol`` by its values, of ``trade_date`` by its bounds.

    A symbol with candidates (``A.N|A``) answers to each of them and to its part
    before the full stop.  Days are texts in ISO form.  Other conditions stay
    with Spark; so do those on days that a vendor may answer too widely.
    """

    def __init__(self, options: dict, fields: list[str]):
        super().__init__(options, fields)
        self.first, self.last, self.only = options.get("start", ""), options.get("end", ""), None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and len(f.attribute) == 1 else None
            if name == "symbol" and isinstance(f, (EqualTo, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.only = values if self.only is None else self.only & values
            elif name == "trade_date" and not isinstance(f, In):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.first = max(self.first, str(f.value))
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.last = min(self.last or str(f.value), str(f.value))
            # a request may bring more than was asked for
            yield f

    def partitions(self) -> list[InputPartition]:
        if self.only is not None:
            asked = [s for s in self.options.get("symbols", "").split(",") if s]
            self.options["symbols"] = ",".join(s for s in asked if self.only & {x for c in s.split("|") for x in (c, c.split(".")[0])})
        return super().partitions()

    def request(self, candidate: str) -> list[dict]:
        """Fixtures may be cut by year: ``{candidate}-{YYYY}.json``; of these only the years in range are opened."""
        years = range(int(self.first[:4]), int(self.last[:4]) + 1) if self.first and self.last else ()
        rows = [r for y in years for r in super(_PushingReader, self).request(f"{candidate}-{y}")] or super().request(candidate)
        day = lambda r: str(r.get("trade_date") or "")
        return [r for r in rows if (not self.first or day(r) >= self.first) and (not self.last or day(r)[:10] <= self.last)]
