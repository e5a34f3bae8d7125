"""Token ids in directly addressable codes.

File format.  A store is a table of segments; each row holds the ids of
consecutive documents in one binary value that needs nothing else to be read:

    magic ``DAC1``, number of levels (uint8), chunk bits (uint8), 2 spare bytes,
    number of ids (uint64), number of documents (uint32), 4 spare bytes;
    document ends (uint64 each, counted in ids from the segment's start);
    per level: number of entries (uint64), the low CHUNK bits of each entry
    (uint8), continuation bitmap (bits from the lowest, padded to 8 bytes),
    rank directory (uint32: set bits before each block of BLOCK bits).

Every id is cut into chunks from the low end.  Level 0 has the first chunk of
every id; a set continuation bit says that another chunk follows, and its rank
among set bits is the entry's place on the next level.  One id is read with a
lookup and a rank per level: no block of ids is ever decoded for it.

Scale: documents are range-partitioned by id once, as text, and encoded after
that shuffle.  A segment holds about SEGMENT_IDS ids.  A document's start in
the whole corpus is its place in the segment plus the ids of all segments
before, which is a running sum within a partition plus one number for each
partition, so no task ever sees all segments.

Edge cases: null and empty texts have the end id alone.  Documents with equal
ids keep their order by text.  Null ids come first.  A document longer than a
segment has one to itself.  An empty table makes an empty store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import Encoder, with_end
from .words import slices

CHUNK, BLOCK, SEGMENT_IDS = 8, 512, 1 << 21
#: Nothing else is held here, so more words and longer slices fit than elsewhere.
KEEP, SLICE_BYTES = 400_000, 8 << 20
_HEAD, _MAGIC = "<4sBB2xQI4x", b"DAC1"
SEGMENT_SCHEMA = "part int, segment int, first_id long, doc_ids array<long>, n_docs long, n_tokens long, data binary"


def write_dac(ids: np.ndarray, doc_ends: np.ndarray) -> bytes:
    """One segment of the format above."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = (rest >> CHUNK) > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)])
        per_block = np.add.reduceat(np.bitwise_count(bits), np.arange(0, len(bits), BLOCK // 8), dtype=np.uint32) if len(bits) else np.zeros(0, np.uint32)
        ranks = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u4") if len(per_block) else per_block
        levels.append(struct.pack("<Q", len(rest)) + rest.astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> CHUNK
    head = struct.pack(_HEAD, _MAGIC, len(levels), CHUNK, len(ids), len(doc_ends))
    return b"".join([head, np.asarray(doc_ends, "<u8").tobytes(), *levels])


class DacReader:
    """Random access to a segment's ids; keeps views of the bytes and decodes only what is asked for."""

    def __init__(self, data: bytes):
        magic, n_levels, chunk, self.n_ids, self.n_docs = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC or chunk != CHUNK:
            raise ValueError("not a DAC1 segment")
        at = struct.calcsize(_HEAD)
        self.doc_ends = np.frombuffer(data, "<u8", self.n_docs, at).astype(np.int64)
        at += 8 * self.n_docs
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            size = (n + 63) // 64 * 8
            low = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, size, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", -(-size * 8 // BLOCK), at + 8 + n + size)
            self.levels.append((low, bits, ranks))
            at += 8 + n + size + 4 * len(ranks)

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit i."""
        block = i // BLOCK
        if block == len(ranks):
            block -= 1
        at = block * BLOCK // 8
        whole, rest = divmod(i, 8)
        count = int(ranks[block]) + int(np.bitwise_count(bits[at:whole]).sum(dtype=np.int64))
        return count + (int(bits[whole]) & ((1 << rest) - 1)).bit_count() if rest else count

    def get(self, i: int) -> int:
        """Id number i of the segment."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        out = 0
        for k, (low, bits, ranks) in enumerate(self.levels):
            out |= int(low[i]) << (CHUNK * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                return out
            i = self._rank(bits, ranks, i)
        raise ValueError("a chunk goes on beyond the last level")

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop - 1; on each level their chunks are one run, found by two ranks."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if stop <= start:
            return np.zeros(0, np.uint32)
        runs, lo, hi = [], start, stop
        for low, bits, ranks in self.levels:
            more = np.unpackbits(bits[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 :][: hi - lo].astype(bool)
            runs.append((low[lo:hi], more))
            if not more.any():
                break
            lo = self._rank(bits, ranks, lo)
            hi = lo + int(np.count_nonzero(more))
        value = np.zeros(0, np.uint32)
        for low, more in reversed(runs):
            out = low.astype(np.uint32)
            out[more] |= value << CHUNK
            value = out
        return value

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.doc_ends[k - 1]) if k else 0, int(self.doc_ends[k]))


def _segments(path: str, end_id: int, keeps_space: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encoder = Encoder(path, keeps_space, KEEP)
        held, docs, ends, n = [], [], [], 0

        def flush():
            nonlocal held, docs, ends, n, number
            doc_ends = np.concatenate(ends)
            row = [[part], [number], [docs[0]], [docs], [len(docs)], [n], [write_dac(np.concatenate(held), doc_ends)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
            held, docs, ends, n, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "segment", "first_id", "doc_ids", "n_docs", "n_tokens", "data"])

        for batch in slices(batches, length=SLICE_BYTES):
            ids, at = with_end(*encoder.encode(batch.column("text")), end_id)
            keys = batch.column("doc_id").to_pylist()
            first = 0
            while first < len(keys):
                last = max(first + 1, int(np.searchsorted(at, at[first] + SEGMENT_IDS - n, side="right")) - 1)
                if docs and at[last] - at[first] + n > SEGMENT_IDS:
                    yield flush()
                    continue
                held.append(ids[at[first] : at[last]])
                ends.append(at[first + 1 : last + 1] - at[first] + n)
                docs += keys[first:last]
                n += int(at[last] - at[first])
                first = last
                if n >= SEGMENT_IDS:
                    yield flush()
        if docs:
            yield flush()

    return run


#: Characters of a text by which equal ids are ordered, before its hash.
HEAD_CHARS = 32


def write_store(docs: DataFrame, out: str, tokenizer: str, end_id: int, keeps_space: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes whole texts and writes the segments in ascending order of ids to the folder ``out``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by text too: an id that repeats (null, say) goes to as many tasks as it fills, and equal ids have one order whatever the run
    # (the bounds of ranges are samples of the keys, which whole texts must not be)
    keys = ["doc_id", "_head", "_hash", "text"]
    rows = rows.withColumns({"_head": F.substring("text", 1, HEAD_CHARS), "_hash": F.xxhash64("text")})
    ordered = rows.repartitionByRange(n, *keys[:3]).sortWithinPartitions(*keys).drop("_head", "_hash")
    ordered.mapInArrow(_segments(tokenizer, end_id, keeps_space), SEGMENT_SCHEMA).write.option("compression", "zstd").parquet(out)


def _places(seg: DataFrame) -> DataFrame:
    """(part, segment, base): the number of ids in all segments before each."""
    small = seg.select("part", "segment", "n_tokens")
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the store, whatever the number of segments
    sums = small.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inner = small.select("part", "segment", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("inner"))
    return inner.join(before, "part").select("part", "segment", (F.col("first") + F.col("inner")).alias("base"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store."""
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def _each_document(segments: DataFrame, value, ddl: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, value(reader, k)) of all documents.

    Starts within a segment come from the segment alone; what lies before it is
    joined to the finished small rows, so segments themselves are not shuffled.
    """
    name, kind = ddl.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.binary() if kind == "binary" else pa.int64()
        for batch in batches:
            for part, number, keys, data in zip(*(batch.column(c) for c in ("part", "segment", "doc_ids", "data")), strict=True):
                reader = DacReader(data.as_buffer())
                begins = np.concatenate([[0], reader.doc_ends[:-1]])
                for lo in range(0, reader.n_docs, 1024):
                    hi = min(lo + 1024, reader.n_docs)
                    ends = reader.doc_ends[lo:hi]
                    columns = [keys.values.slice(lo, hi - lo), pa.array(begins[lo:hi]), pa.array(ends - begins[lo:hi]), pa.array([value(reader, k) for k in range(lo, hi)], of)]
                    fixed = [pa.array(np.full(hi - lo, x.as_py(), np.int32)) for x in (part, number)]
                    yield pa.RecordBatch.from_arrays(columns + fixed, ["doc_id", "inner", "n_tokens", name, "part", "segment"])

    rows = segments.select("part", "segment", "doc_ids", "data").mapInArrow(run, f"doc_id long, inner long, n_tokens long, {ddl}, part int, segment int")
    return rows.join(_places(segments), ["part", "segment"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", name)


def documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document's ids as little-endian uint32, by random access to its segment."""
    return _each_document(segments, lambda reader, k: reader.document(k).astype("<u4").tobytes(), "ids binary")


def digests(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the stored documents, without sending ids back to the JVM."""
    return _each_document(segments, lambda reader, k: zlib.crc32(reader.document(k).astype("<u4")), "ids_crc32 long")
