"""Best-fit packing of token sequences, by a plan over sizes.

The largest size that is still unplaced goes first.  Its documents are matched
with the smallest gaps that hold them, run by run: sizes are whole numbers up to
the capacity, so sorted documents and sorted gaps are runs of equal numbers, and
one step of a sweep moves a whole run.  Within a run conflicts can't arise, as
document number r of a size takes gap number r.  When no gap is left that fits,
new sequences are opened.

The sweep needs only how many documents each size has: CAPACITY counts, whatever
the corpus, so it is done at once on the driver (``plan``), and fills a plan of
at most a few rows per pair of sizes; every document then finds its place in it
by its size and rank alone, on the cluster.  Rounds that are jobs of their own, one for
each sweep of all sizes, would give the same kind of packing in many more jobs;
the README has their figures.

Ranks come from a range sort of small rows (no text, no ids unless asked to
carry them) by size: within a partition by position, across partitions by the
counts of each (partition, size) before it - at most partitions + CAPACITY
numbers reach the driver.  A size that a third of all documents share spans
many partitions.  The ranked rows are written to the shared folder, so the
places never depend on a second run of the sort.

Edge cases: null and empty texts have the end id alone.  A document longer than
the capacity is cut into whole pieces, the first one shorter if need be.
Repeated rows are packed once each.  An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, materialize
from .tokens import Encoder, with_end
from .words import slices

CAPACITY = 1024
#: The tokenizer works best on more text at once than other operators.
SLICE_BYTES = 4 << 20
_RANK_BITS = 44
_PIECES = "doc_id long, piece int, start long, length long, ids binary"


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of all pieces of documents of these sizes."""
    n = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = sizes - (n - 1) * capacity
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, first[doc], capacity)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, keeps_space: bool = True, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): ids are little-endian uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, keeps_space)
        for batch in slices(batches, length=SLICE_BYTES):
            ids, ends = with_end(*encoder.encode(batch.column("text")), end_id)
            doc, piece, start, length = cut(np.diff(ends), capacity)
            at = np.concatenate([[0], np.cumsum(length)]) * 4
            values = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), values], ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _PIECES)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Rows (size, first rank, first sequence, offset), sorted: ranks from the first one on take consecutive sequences.

    counts[s]: the number of documents of size s.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, how many)
    out, opened = [], 0
    for size in range(capacity, 0, -1):
        rank, left = 0, int(counts[size])
        while left:
            fits = min((g for g, r in runs.items() if g >= size and r), default=None)
            if fits is None:
                # as many new sequences as this size needs by itself
                runs[capacity].append((opened, -(-left // (capacity // size))))
                opened += runs[capacity][-1][1]
                fits = capacity
            first, n = runs[fits].pop()
            if n > left:
                runs[fits].append((first + left, n - left))
                n = left
            out.append((size, rank, first, capacity - fits))
            if fits > size:
                runs[fits - size].append((first, n))
            rank, left = rank + n, left - n
    return np.array(out, np.int64).reshape(-1, 4)


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (doc_id, piece, length and whatever else) with sequence_id and offset.

    ``rows`` is read more than once: pass a table, not a computation.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["length", "doc_id", "piece"]
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            size = batch.column("length").to_numpy()
            here = np.bincount(size, minlength=capacity + 1)
            # rows are sorted by size, so a row's number among its size is its distance from the size's first row
            inner = np.arange(len(size)) - (np.cumsum(here) - here)[size] + seen[size]
            seen += here
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), part, np.int32)), pa.array(inner)], [*batch.schema.names, "_part", "_rank"])

    ranked = materialize(ordered.mapInArrow(number, extended(ordered.schema, "_part int, _rank long")), "ranked")
    base: dict[tuple[int, int], int] = {}
    counts = np.zeros(capacity + 1, np.int64)
    for part, size, k in sorted(map(tuple, ranked.groupBy("_part", "length").count().collect())):
        base[part, size] = int(counts[size])
        counts[size] += k
    moves = plan(counts, capacity)
    order = np.lexsort((moves[:, 1], moves[:, 0]))
    moves = moves[order]
    steps = (moves[:, 0] << _RANK_BITS) + moves[:, 1]
    schema = extended(rows.schema, "sequence_id long, offset long")
    names = rows.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, part = batch.column("length").to_numpy(), batch.column("_part").to_numpy()
            if not len(size):
                continue
            both, at = np.unique((part.astype(np.int64) << 32) + size, return_inverse=True)
            before = np.array([base[int(b) >> 32, int(b) & 0xFFFFFFFF] for b in both], np.int64)
            rank = batch.column("_rank").to_numpy() + before[at]
            row = np.searchsorted(steps, (size << _RANK_BITS) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(moves[row, 2] + rank - moves[row, 1]), pa.array(moves[row, 3])], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens, doc_ids) of packed rows that carry their ids; at most CAPACITY ids per row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("p.ids", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return grouped.select("sequence_id", joined.alias("ids"), "n_tokens", F.col("p.doc_id").alias("doc_ids"))


def packed_digests(docs: DataFrame, tokenizer: str, end_id: int, keeps_space: bool = True, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): ids become checksums before the sort."""
    cut_up = pieces(docs, tokenizer, end_id, keeps_space, capacity)
    small = materialize(cut_up.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(small, capacity)
