"""Tables bucketed by key: upserts of old and new shards join bucket with bucket, without a shuffle of the old one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Saves a table of ``buckets`` buckets, each one sorted file; ``path`` makes it an external one."""
    writer = df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def _one_each(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; in a bucketed table the rows of a key lie together already."""
    by = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("_n", F.row_number().over(by)).filter("_n = 1").drop("_n")


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` over it: of a key ``new``'s last row, else ``old``'s, as ``joins.keep_last`` has it.

    Both sides are reduced within their buckets and meet in a merge join; a side
    that isn't bucketed alike is shuffled to the other's buckets, which for a
    day's shard against a long history is the small one.  Keys are not null.
    Columns that one side lacks are null in its rows.
    """
    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    sides = []
    for df, tag in ((old, "o"), (new, "n")):
        rest = [c for c in df.columns if c not in keys]
        row = F.struct(*(F.col(f"`{c}`") for c in rest), F.lit(True).alias("_is"))
        sides.append(_one_each(df, keys, order).select(*keys, row.alias(f"_{tag}")))
    both = sides[0].join(sides[1], list(keys), "full_outer")

    def value(c: str):
        kind = (new if c in new.columns else old).schema[c].dataType
        mine, theirs = (F.col(f"_{tag}.`{c}`") if c in df.columns else F.lit(None).cast(kind) for tag, df in (("o", old), ("n", new)))
        return F.when(F.col("_n._is"), theirs).otherwise(mine).alias(c)

    return both.select(*(F.col(c) if c in keys else value(c) for c in columns))


def upserted_table(spark: SparkSession, old: str, new: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return upserted(spark.table(old), spark.table(new), keys, order)
