"""Exact quantiles by rank: values are counted, sorted by range and counted up, and only the wanted ranks are looked up.

No group's values meet in one task, however many rows one group holds, and
equal values of a group are one row with a count before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.sinks import staged


def _counted_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds _to: the rows up to each value, of all in the partition."""
    whole = 0
    for batch in batches:
        to = np.cumsum(batch.column("_c").to_numpy()) + whole
        whole = to[-1] if len(to) else whole
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.int64())], [*batch.schema.names, "_to"])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """For each group, a column for each share of ``shares`` (name: between 0 and 1), interpolated between neighbouring values; nulls don't count.

    The sorted values are written once, with their counts.  A row for each group
    in each partition says which ranks lie there; so a wanted rank is a place in
    a partition, and values are fetched by place.  Groups without values are absent.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    ordered = rows.repartitionByRange(n, *keys, "_v").sortWithinPartitions(*keys, "_v")
    lying = staged(ordered.mapInArrow(_counted_up, StructType([*rows.schema.fields, StructField("_to", LongType())])).withColumn("_part", F.spark_partition_id()), "sorted")
    runs = lying.groupBy(*keys, "_part").agg(F.min(F.col("_to") - F.col("_c")).alias("_first"), F.sum("_c").alias("_n"))
    group = Window.partitionBy(*keys)
    runs = runs.withColumns({"_before": F.sum("_n").over(group.orderBy("_part")) - F.col("_n"), "_all": F.sum("_n").over(group)})
    rank = lambda q: F.lit(q) * (F.col("_all") - 1)
    ends = [F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), f(rank(q)).cast("long").alias("rank"), (rank(q) - F.floor(rank(q))).alias("part")) for name, q in shares.items() for side, f in (("low", F.floor), ("high", F.ceil))]
    wanted = runs.withColumn("_w", F.explode(F.array(*ends))).filter((F.col("_w.rank") >= F.col("_before")) & (F.col("_w.rank") < F.col("_before") + F.col("_n")))
    places = wanted.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_part").alias("_in"), (F.col("_first") + F.col("_w.rank") - F.col("_before")).alias("_place"), F.col("_w.name").alias("_name"), F.col("_w.side").alias("_side"), F.col("_w.part").alias("_between"))
    here = (F.col("_part") == F.col("_in")) & (F.col("_place") >= F.col("_to") - F.col("_c")) & (F.col("_place") < F.col("_to"))
    for k in keys:
        here = here & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    found = lying.join(places, here)
    at = lambda name, side: F.max(F.when((F.col("_name") == name) & (F.col("_side") == side), F.col("_v")))
    between = lambda name: F.max(F.when(F.col("_name") == name, F.col("_between")))
    mixed = [F.when(at(s, "low") == at(s, "high"), at(s, "low")).otherwise(at(s, "low") * (1 - between(s)) + at(s, "high") * between(s)).alias(s) for s in shares]
    return found.groupBy(*keys).agg(*mixed)
