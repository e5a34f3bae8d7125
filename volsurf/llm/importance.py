"""Importance resampling of documents towards a target text collection.

A document's features are its words and the runs of two and three of them, each
hashed into one of ``buckets`` by CRC-32.  Over all documents and over all
target texts the buckets are counted; a bucket's gain is the log of how much
more often the target fills it.  A document's weight is the sum of its
features' gains, its score the weight and a Gumbel draw that depends on its id
alone, and the highest scores are the sample (without replacement, in
proportion to the exponential of the weight).

Each task runs DuckDB over slices of its texts: SQL unnests the words, a window
pairs them with the two after them, and a registered function takes the CRC.
What a task has counted leaves as rows, a document's buckets and the task's own
totals, and is written as Parquet by Spark's committer to the shared folder:
DuckDB itself writes no file.  Spark merges the totals and scores the documents
from that table, so texts are read and cut up once.

Scaling: totals are one row of ``buckets`` numbers a task; documents are never
shuffled, and their scores (a few numbers each) once, by range, for the ranks.
A task holds one slice (about 1 MB of text, or one longer text: some 200 bytes
a word) in DuckDB.

Edge cases: a null or wordless text has no features, weight 0 and is never
drawn; a null id draws as an empty one and comes first among ties; rows with
equal ids and texts have equal scores and take adjacent ranks; without rows the result
is empty; without target texts all gains compare with empty buckets.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, numbered, small_batches
from .words import slices

BUCKETS, SHARE, LEAST_WORDS, SEED = 10_000, (5, 100), 20, 42

#: What is no word, as characters of a regular expression: all of ASCII but digits and lower-case letters.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CUT = f"""
CREATE OR REPLACE TEMP TABLE hashed AS
WITH cut AS (SELECT doc, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words FROM slice),
word AS (SELECT doc, unnest(words) AS a, generate_subscripts(words, 1) AS place FROM cut),
run AS (SELECT doc, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM word WINDOW w AS (PARTITION BY doc ORDER BY place)),
feature AS (SELECT doc, unnest([1, 0, 0]) AS is_word, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c]) AS f FROM run)
SELECT doc, is_word, bucket_of(f) AS bucket FROM feature WHERE f IS NOT NULL
"""
_DOCUMENTS = "SELECT doc, sum(is_word)::BIGINT AS n_words, list(bucket) AS buckets FROM hashed GROUP BY doc"
_TOTALS = "SELECT bucket, count(*) AS n FROM hashed GROUP BY bucket"
_ROWS = "doc_id long, n_words long, n_features long, buckets array<int>, totals array<long>"


def _bucket_function(buckets: int):
    """CRC-32 of strings modulo ``buckets``, as an Arrow function for DuckDB."""

    def bucket_of(column: pa.ChunkedArray | pa.Array) -> pa.Array:
        texts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if not len(texts):
            return pa.array([], pa.int32())
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = memoryview(texts.buffers()[2])[at[0] : at[-1]].tobytes() if texts.buffers()[2] else b""
        ends = (at - at[0]).tolist()
        crc = zlib.crc32
        codes = np.array([crc(data[a:b]) for a, b in zip(ends, ends[1:])], np.int64)
        return pa.array((codes % buckets).astype(np.int32))

    return bucket_of


def bucketed(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The buckets of every document's features, one row each, and one row of totals (null id, null buckets) for each task.

    (doc_id, n_words, n_features, buckets, totals); ``buckets`` has a place for each feature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        totals = np.zeros(buckets, np.int64)
        with duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""}) as db:
            db.create_function("bucket_of", _bucket_function(buckets), ["VARCHAR"], "INTEGER", type="arrow")
            for batch in slices(batches):
                n = batch.num_rows
                db.register("slice", pa.table({"doc": pa.array(np.arange(n)), "text": batch.column("text")}))
                db.execute(_CUT)
                found, counts = db.sql(_DOCUMENTS).to_arrow_table().combine_chunks(), db.sql(_TOTALS).fetchnumpy()
                db.unregister("slice")
                totals[counts["bucket"]] += counts["n"]
                words, rows = np.zeros(n, np.int64), np.full(n, -1, np.int64)
                at = found["doc"].to_numpy()
                words[at], rows[at] = found["n_words"].to_numpy(), np.arange(len(at))
                lists = found["buckets"].combine_chunks() if isinstance(found["buckets"], pa.ChunkedArray) else found["buckets"]
                # a document without words has no row: its place stays null and becomes an empty list
                taken = lists.take(pa.array(rows, mask=rows < 0)) if len(lists) else pa.nulls(n, pa.list_(pa.int32()))
                sizes = taken.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                full = pa.ListArray.from_arrays(pa.array(offsets), taken.flatten().cast(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(sizes), full, pa.nulls(n, pa.list_(pa.int64()))], _NAMES)
        one = lambda kind: pa.nulls(1, kind)
        yield pa.RecordBatch.from_arrays([one(pa.int64()), one(pa.int64()), one(pa.int64()), one(pa.list_(pa.int32())), pa.array([totals], pa.list_(pa.int64()))], _NAMES)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, _ROWS)


_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def totals(rows: DataFrame, name: str) -> DataFrame:
    """(bucket, name): the tasks' totals, summed."""
    return rows.filter("totals is not null").select(F.posexplode("totals").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias(name))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: the log of the ratio of smoothed shares, in thousandths, rounded down."""
    spark = corpus.sparkSession
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(totals(corpus, "s"), "bucket", "left").join(totals(target, "t"), "bucket", "left").fillna(0, ["s", "t"])
    sums = both.agg(F.sum("s").cast("double").alias("s_all"), F.sum("t").cast("double").alias("t_all"))
    ratio = (F.col("t").cast("double") + 1) * (F.col("s_all") + buckets) / ((F.col("s").cast("double") + 1) * (F.col("t_all") + buckets))
    # one row
    return both.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel draw in thousandths, rounded down, from 32 bits of the id's SHA-256."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of bucketed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            at = lists.offsets.to_numpy().astype(np.int64)
            summed = np.concatenate([[0], np.cumsum(gain[lists.values.to_numpy()[at[0] : at[-1]]])])
            at -= at[0]
            weight = summed[at[1:]] - summed[at[:-1]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return rows.filter("totals is null").drop("totals").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null unless drawn.

    Drawn are the ``share`` (numerator, denominator; rounded down) of documents of
    ``least_words`` words or more, by score, ties to the smaller id.
    """
    corpus = materialize(bucketed(docs, buckets, id_col, text_col), "bucketed")
    wanted = materialize(bucketed(target.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")), buckets), "bucketed")
    # ``buckets`` rows
    gain = np.zeros(buckets, np.int64)
    for bucket, value in gains(corpus, wanted, buckets).collect():
        gain[bucket] = value
    fit = F.col("n_words") >= least_words
    scored = weighed(corpus, gain).select("doc_id", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"), fit.alias("_fit"))
    ranked = numbered(scored, F.desc("_fit"), F.desc("score"), F.asc_nulls_first("doc_id"), name="rank")
    n = ranked.filter("_fit").count()
    discard(corpus, wanted)
    drawn = F.col("_fit") & (F.col("rank") <= n * share[0] // share[1])
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("rank")).alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, with all their columns; ids are taken to be unique."""
    ids = resample(docs, target, id_col=id_col, **options).filter("rank is not null").select(F.col("doc_id").alias(id_col))
    return docs.join(ids, id_col, "left_semi")
