"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; any path that Spark's readers open will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=1)
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='volsurf-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only where the session names none and is in local mode (tests) is it a
    temporary folder of this process.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set")
    return _own_dir()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches have BATCH_ROWS rows at most: whole texts go to Python in them, twice per executor core."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    return df


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    This cuts the lineage with files that outlive executors: a lost executor
    costs the tasks it was running, never a recomputation of earlier stages.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._volsurf_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of materialized tables that no later plan reads."""
    for df in tables:
        path = getattr(df, "_volsurf_path", None)
        if not path:
            continue
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """``df`` with the places of its rows, from 1, in the given order; rows are sorted by range, never in one task.

    A partition's rows are numbered as they lie in the written table; only the
    partitions' sizes are summed up in one place.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lying = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("_place", 33)
    sizes = lying.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row for each partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return lying.withColumn("_part", part).join(F.broadcast(before), "_part").select(*df.columns, place.alias(name))


def extended(schema: StructType, ddl: str) -> StructType:
    """The schema with the fields of a DDL string after it."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])
