"""Writers: day partitions, upserts, ledgers, reports, backups; each publishes whole or not at all."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import day_path


def write_days(df: DataFrame, path: str, sort: tuple[str, ...] = ("underlying",), spread: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """One partition per trade date; only the days in ``df`` are replaced.

    Rows without a date are left out, with a warning.  Returns how many rows were
    written and left out, counted by the plan that writes.  A large day is cut
    among tasks, each of which sorts and writes its own file.  ``spread`` makes
    several rows of one there, behind the sort, as in ``day_files``; its rows are counted.
    """
    counters = Counters()
    watch = lambda rows: counters.watch(rows, "days", undated=F.count_if(F.col("trade_date").isNull())).filter("trade_date is not null")
    dealt = lambda rows: rows.hint("rebalance", "trade_date").sortWithinPartitions("trade_date", *sort)
    rows = watch(spread(dealt(df))) if spread else dealt(watch(df))
    with _set(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(_DAYS_OPEN) if spread else "0"):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trade_date").parquet(path)
    seen = counters.values()["days"]
    if seen["undated"]:
        warnings.warn(f"{seen['undated']} rows without a trade_date are left out of {path}", stacklevel=2)
    return {"written": seen["rows"] - seen["undated"], "undated": seen["undated"]}


class Counters:
    """Counts of rows at the steps of a run, taken by the plans that do the work: no second pass.

    A step that is watched keeps filters behind it from reaching the scan before
    it, so a scan's own rows are better taken from the files' ledger.  Counts are
    of the first action over a step; a stage that is repeated after a loss may
    count its rows again.
    """

    def __init__(self) -> None:
        self._steps: dict[str, tuple[Observation, list[str]]] = {}

    def watch(self, df: DataFrame, step: str, **counts: Column) -> DataFrame:
        """``df``, whose rows are counted as ``rows`` and by further aggregates."""
        seen = Observation(f"{step}-{uuid.uuid4().hex}")
        self._steps[step] = seen, ["rows", *counts]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in counts.items()))

    def values(self) -> dict[str, dict[str, int]]:
        """The counts of each step, once the actions over them have ended."""
        out = {}
        for step, (seen, names) in self._steps.items():
            try:
                out[step] = dict(seen.get)
            except Py4JJavaError:
                # a plan that turns out to be empty while it runs is cut short, and its counts are never taken
                out[step] = dict.fromkeys(names, 0)
        return out

    def without(self, *steps: str) -> None:
        """Forgets steps over which no action will run; their counts would be waited for without end."""
        for step in steps:
            self._steps.pop(step, None)

    def rows(self, spark: SparkSession) -> DataFrame:
        """(step, counter, n)."""
        flat = [(step, c, int(n)) for step, seen in self.values().items() for c, n in seen.items()]
        return spark.createDataFrame(flat, "step string, counter string, n long")


def raw_day_name(day: str) -> str:
    return f"{day[:4]}/{day[5:7]}/{day}.csv.gz"


@contextlib.contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


#: Days that a task writes side by side; of more, it would sort the rest.
_DAYS_OPEN = 100


def day_files(df: DataFrame, path: str, columns: Sequence[str], day: str = "trade_date", sort: Sequence[str] = (), name: Callable[[str], str] = raw_day_name, spread: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """A gzip CSV with a header for each day, by default named as raw days are; the driver gives each its name.

    A day's rows go straight to its file, as they come, and a task holds none of
    them.  If their order counts, they are sorted in that task first.  ``spread``
    makes several rows of one there, behind the sort: they are neither shuffled
    nor sorted, and stay in its order for up to _DAYS_OPEN days of a task.
    """
    spark = df.sparkSession
    work = f"{path.rstrip('/')}/.parts-{uuid.uuid4().hex}"
    rows = df.filter(F.col(day).isNotNull()).withColumn("_day", F.col(day).cast("string")).repartition("_day")
    if sort:
        rows = rows.sortWithinPartitions("_day", *sort)
    rows = spread(rows) if spread else rows
    # otherwise the writer has all rows sorted by day
    with _set(spark, "spark.sql.maxConcurrentOutputFileWriters", "0" if sort and not spread else str(_DAYS_OPEN)):
        rows.select(*columns, "_day").write.option("header", True).option("compression", "gzip").partitionBy("_day").csv(work)
    fs, p = _hadoop(spark, work)
    for folder in fs.listStatus(p):
        if folder.getPath().getName().startswith("_day="):
            part = next(f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().endswith(".csv.gz"))
            target = _hadoop(spark, f"{path.rstrip('/')}/{name(folder.getPath().getName()[5:])}")[1]
            fs.mkdirs(target.getParent())
            fs.rename(part, target)
    fs.delete(p, True)


@functools.lru_cache(maxsize=1)
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='volsurf-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share; a temporary one of this process in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set")
    return _own_dir()


def staged(df: DataFrame, tag: str, spark: SparkSession | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back (by another session, if given): several later steps use it, and their plans start from the table."""
    path = f"{shared_dir(df.sparkSession)}/staged/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def report(df: DataFrame, path: str) -> None:
    """Replaces a report, by an empty one if there is nothing to say; it is as wide as its input."""
    df.write.mode("overwrite").parquet(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def require_writable(spark: SparkSession, path: str) -> None:
    """Fails before a job starts rather than at its end."""
    fs, p = _hadoop(spark, f"{path.rstrip('/')}/.writable")
    fs.create(p, True).close()
    fs.delete(p, False)


def backup_once(spark: SparkSession, path: str, to: str) -> bool:
    """Copies a folder unless a copy exists; whether it did."""
    if not exists(spark, path) or exists(spark, to):
        return False
    fs, p = _hadoop(spark, path)
    target_fs, target = _hadoop(spark, to)
    return bool(spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, target_fs, target, False, spark._jsc.hadoopConfiguration()))


def swap(spark: SparkSession, new: str, live: str) -> None:
    """Puts a finished folder in the place of the live one; ``recovered`` mends a swap that broke off in between."""
    fs, source = _hadoop(spark, new)
    _, target = _hadoop(spark, live)
    old = _hadoop(spark, f"{live.rstrip('/')}.old")[1]
    recovered(spark, live)
    if not fs.exists(source):
        raise OSError(f"{new} can't be moved to {live}: it is absent")
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(source, target):
        if fs.exists(old):
            fs.rename(old, target)
        raise OSError(f"{new} could not be moved to {live}")
    fs.delete(old, True)


def recovered(spark: SparkSession, live: str) -> bool:
    """After a swap that broke off: puts the old folder back if there is no live one, else removes it.  Whether a live folder exists."""
    fs, target = _hadoop(spark, live)
    old = _hadoop(spark, f"{live.rstrip('/')}.old")[1]
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            fs.rename(old, target)
    return fs.exists(target)


def copy_plan(days: DataFrame, present: DataFrame, source: str, target: str, overwrite: bool = False) -> DataFrame:
    """(day, source, target, action) for mirroring day files: business days whose copy is absent, or all of them."""
    due = days.filter("is_business").select("day")
    have = present.select(F.col("trade_date").alias("day"), F.lit(True).alias("_have")).distinct()
    action = F.when(F.col("_have") & ~F.lit(overwrite), "skip").otherwise("copy")
    return due.join(have, "day", "left").select("day", day_path(F.col("day"), source).alias("source"), day_path(F.col("day"), target).alias("target"), action.alias("action"))


def fetch_outcomes(plan: DataFrame, answers: DataFrame) -> DataFrame:
    """(day, outcome) of a run over a copy plan, in the order of days.

    ``answers``: day, code (an HTTP status).  200 is downloaded, 404 skipped, any
    other a failure; from the first 403 on the run has stopped.  Days that the
    plan skips exist already.
    """
    due = plan.join(answers, "day", "left")
    stop = due.filter("action = 'copy' and code = 403").agg(F.min("day").alias("_stop"))
    code = F.col("code")
    outcome = (
        F.when(F.col("action") == "skip", "exists")
        .when(F.col("day") == F.col("_stop"), "forbidden")
        .when(F.col("day") > F.col("_stop"), "not_tried")
        .when(code == 200, "downloaded")
        .when(code == 404, "skipped")
        .otherwise("failed")
    )
    # one row
    return due.join(F.broadcast(stop)).select("day", outcome.alias("outcome"))


def result_document(outcomes: DataFrame) -> DataFrame:
    """(status, body): 200 if nothing failed, else 207, and the counts by outcome as JSON."""
    counts = outcomes.groupBy("outcome").agg(F.count("*").alias("n"))
    bad = F.coalesce(F.sum(F.when(F.col("outcome").isin("failed", "forbidden", "not_tried"), F.col("n"))), F.lit(0))
    body = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))))
    return counts.agg(F.when(bad > 0, 207).otherwise(200).alias("status"), body.alias("body"))
