"""Audit of how the sources of a language differ in their words.

A language's vocabulary is the terms that at least ``least_docs`` of its documents hold.  A
group is a (lang, source) pair; its vector has a whole number p for every term
of the vocabulary: p = 1 + floor(UNIT * (count + 2) / (N + 2 V)), with N the
sum of its counts.  Two vectors differ at a term by f = floor((p - q)**2 / (p + q)),
and as a whole by the sum of f.  All arithmetic is on whole numbers.

The groups of a language are dealt to BLOCKS seats, and the vocabulary is cut
into slices, so that a partition holds a block's vectors in one slice.  Vectors
are sparse and compressed.  Seats stay where they are and meet in a round-robin
tournament: in every round each seat is paired with one other, and one block of
each pair travels to the other's partition.  A meeting fills the places of both
directions.  In the first round each seat meets itself and the language's own
vector, against which a heap of each group keeps its foremost terms.  A round's
results are written to the shared folder before the next one begins, so a lost
executor costs tasks of one round.

Scaling: texts are counted where they lie, slice by slice of a task, so that a
source with a third of all rows arrives at the shuffle as sums.  The number of
slices grows with the number of (lang, source, term) counts; the number of
rounds is BLOCKS, whatever the input.  A vector travels half of the rounds at
most.  Meetings cost pairs of groups times the terms that either holds.

Edge cases: null texts, languages and sources count as empty ones; a group without
terms takes part with all counts zero; a language without a vocabulary gives
pairs of value 0; a language of one source gives no pairs; repeated rows count
each time; an empty table gives no rows.  Columns of other names are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, small_batches
from .words import encode_lists, slices

LEAST_DOCS, TOP, UNIT = 10, 10, 1_000_000_000
#: Seats of the tournament, an even number.
BLOCKS = 8
#: Counts of groups that a slice of the vocabulary has about.
SLICE_COUNTS = 200_000

#: What separates terms: ASCII but letters.
_BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed over slices of tasks; a group's own row has a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            groups, which = _codes(batch.column("lang"), batch.column("source"))
            lowered = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
            words, index, offsets = encode_lists(pc.split_pattern_regex(lowered, _BREAK))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            width = max(len(words), 1)
            # a word counts once for each row in ``docs``, and as often as it stands there in ``n``
            cell, times = np.unique(row * width + index, return_counts=True)
            pair, at = np.unique(which[cell // width] * width + cell % width, return_inverse=True)
            n = np.bincount(at, weights=times, minlength=len(pair)).astype(np.int64)
            seen = np.bincount(at, minlength=len(pair)).astype(np.int64)
            out = groups.take(pa.array(pair // width))
            yield _counts(out, words.take(pa.array(pair % width)), n, seen)
            yield _counts(groups, pa.nulls(len(groups), pa.string()), np.zeros(len(groups), np.int64), np.zeros(len(groups), np.int64))

    rows = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"), F.col(text).alias("text"))
    parts = small_batches(rows).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _codes(lang: pa.Array, source: pa.Array) -> tuple[pa.StructArray, np.ndarray]:
    """The distinct (lang, source) pairs and each row's number among them."""
    a, b = lang.dictionary_encode(), source.dictionary_encode()
    both = a.indices.to_numpy().astype(np.int64) * max(len(b.dictionary), 1) + b.indices.to_numpy()
    seen, which = np.unique(both, return_inverse=True)
    width = max(len(b.dictionary), 1)
    pairs = [a.dictionary.take(pa.array(seen // width)), b.dictionary.take(pa.array(seen % width))]
    return pa.StructArray.from_arrays(pairs, ["lang", "source"]), which


def _counts(groups: pa.StructArray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    lang, source = groups.flatten()
    return pa.RecordBatch.from_arrays([lang, source, terms, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def share(count: np.ndarray | int, total: int, vocabulary: int) -> np.ndarray:
    """p of counts in a group of ``total`` occurrences; a long division by thousands, exact up to counts of 9e15."""
    over = np.int64(max(total + 2 * vocabulary, 1))
    rest, out = np.asarray(count, np.int64) + 2, np.int64(0)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // over
        rest = rest % over
    return 1 + out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Vector:
    """A group's counts in one slice: sorted ids of terms, p of each, and p of any other term."""

    def __init__(self, source: str, ids: bytes, counts: bytes, total: int, vocabulary: int):
        self.source = source
        self.ids = np.cumsum(np.frombuffer(zlib.decompress(ids), "<i4")) if ids else np.zeros(0, np.int64)
        self.p = share(np.frombuffer(zlib.decompress(counts), "<i8"), total, vocabulary) if counts else np.zeros(0, np.int64)
        self.rest = share(0, total, vocabulary)

    def against(self, other: Vector, terms: int) -> int:
        """The sum of ``distance`` over the ``terms`` terms of the slice."""
        base = int(distance(self.rest, other.rest))
        mine, theirs = distance(self.p, other.rest), distance(self.rest, other.p)
        out = terms * base + int(mine.sum()) - base * len(mine) + int(theirs.sum()) - base * len(theirs)
        # terms of both were taken against the other's rest, twice
        _, a, b = np.intersect1d(self.ids, other.ids, assume_unique=True, return_indices=True)
        return out + int((distance(self.p[a], other.p[b]) - mine[a] - theirs[b] + base).sum())


def _packed(lists: DataFrame) -> DataFrame:
    """Sorted lists of (id, n), as compressed columns ``ids`` (differences) and ``counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for pairs in batch.column("pairs"):
                if not pairs.is_valid:
                    ids.append(None)
                    counts.append(None)
                    continue
                id_, n = pairs.values.flatten()
                ids.append(zlib.compress(np.diff(id_.to_numpy().astype("<i4"), prepend=0).astype("<i4").tobytes(), 1))
                counts.append(zlib.compress(n.to_numpy().astype("<i8").tobytes(), 1))
            keep = [n for n in batch.schema.names if n != "pairs"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], [*keep, "ids", "counts"])

    schema = ", ".join(f"{n} {t}" for n, t in lists.dtypes if n != "pairs")
    return lists.mapInArrow(run, f"{schema}, ids binary, counts binary")


def rounds(blocks: int = BLOCKS) -> list[dict[int, int]]:
    """The tournament: for each round the seat that each travelling block goes to.  Every two blocks meet once."""
    ring = list(range(blocks))
    out = []
    for _ in range(blocks - 1):
        out.append({max(a, b): min(a, b) for a, b in zip(ring[: blocks // 2], reversed(ring[blocks // 2 :]), strict=True)})
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


_FOUND = "lang string, source string, item string, value long, part string"
_SEAT = ["lang", "slice", "block"]


def _vectors(table: pa.Table) -> tuple[list[Vector], int]:
    rows = table.sort_by("source").to_pylist()
    return [Vector(r["source"], r["ids"], r["counts"], r["total"], r["vocabulary"]) for r in rows], rows[0]["terms"] if rows else 0


def _result(lang: str, rows: list[tuple[str, str, int, str]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.table([pa.array([lang] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["lang", "source", "item", "value", "part"])


def _meet(key: tuple, resident: pa.Table, travelling: pa.Table) -> pa.Table:
    """Every group of a seat with every group of the block that has come, in both directions."""
    here, terms = _vectors(resident)
    come, _ = _vectors(travelling)
    out = []
    for a in here:
        for b in come:
            value = a.against(b, terms)
            out += [(a.source, b.source, value, "pair"), (b.source, a.source, value, "pair")]
    return _result(key[0].as_py(), out)


def _at_home(top: int):
    """The first round: the groups of a seat among each other, and each with the language's own vector."""

    def meet(key: tuple, resident: pa.Table, language: pa.Table) -> pa.Table:
        here, terms = _vectors(resident)
        out = []
        for k, a in enumerate(here):
            for b in here[:k]:
                value = a.against(b, terms)
                out += [(a.source, b.source, value, "pair"), (b.source, a.source, value, "pair")]
        for whole in language.to_pylist():
            own = Vector("", whole["ids"], whole["counts"], whole["total"], whole["vocabulary"])
            names = whole["names"]
            for a in here if top else []:
                # the language has every term that a group has
                at = np.searchsorted(own.ids, a.ids)
                more = np.nonzero(a.p > own.p[at])[0]
                value = distance(a.p[more], own.p[at[more]])
                best = heapq.nsmallest(top, ((-v, names[i].encode()) for v, i in zip(value.tolist(), a.ids[more].tolist(), strict=True)))
                out += [(a.source, name.decode(), -v, "term") for v, name in best]
        return _result(key[0].as_py(), out)

    return meet


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, blocks: int = BLOCKS, slice_counts: int = SLICE_COUNTS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair`` ranks each group's peers in the language by their distance, part
    ``term`` the ``top`` terms by which a group stands out from its language.
    """
    counted = materialize(term_counts(docs, lang, source, text), "term_counts")
    by_term = counted.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = by_term.filter(F.col("docs") >= least_docs).select("lang", "term", F.col("n").alias("whole"))
    known = materialize(counted.filter("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole"), "known")
    n_slices = max(1, -(-known.count() // slice_counts))
    # a term's id is its place in its slice of the vocabulary, which has about slice_counts rows at most
    at_slice = F.pmod(F.xxhash64("term"), F.lit(n_slices)).cast("int")
    vocabulary = materialize(
        known.groupBy("lang", "term").agg(F.first("whole").alias("whole")).withColumn("slice", at_slice).withColumn("id", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")) - 1),
        "vocabulary",
    )
    sizes = vocabulary.groupBy("lang", "slice").agg(F.count("*").alias("terms"), F.sum("whole").alias("n"))
    languages = sizes.groupBy("lang").agg(F.sum("terms").alias("vocabulary"), F.sum("n").alias("whole"))
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left").fillna(0, ["total", "vocabulary", "whole"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("block", (place % blocks).cast("int")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
    groups = groups.join(sizes.drop("n"), ["lang", "slice"], "left").fillna(0, ["terms"])

    pairs = F.sort_array(F.collect_list(F.struct("id", "n"))).alias("pairs")
    vectors = known.join(vocabulary.drop("whole"), ["lang", "term"]).groupBy("lang", "source", "slice").agg(pairs)
    seats = groups.join(vectors, ["lang", "source", "slice"], "left").select("lang", "source", "block", "slice", "total", "vocabulary", "terms", "pairs")
    seats = materialize(_packed(seats), "seats")
    whole = F.sort_array(F.collect_list(F.struct("id", F.col("whole").alias("n"), "term")))
    own = vocabulary.groupBy("lang", "slice").agg(whole.alias("w")).join(languages, "lang")
    own = own.select("lang", "slice", F.col("whole").alias("total"), "vocabulary", F.col("w.term").alias("names"), F.arrays_zip(F.col("w.id").alias("id"), F.col("w.n").alias("n")).alias("pairs"))
    own = materialize(_packed(own), "own")

    visits = own.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = [materialize(seats.groupBy(*_SEAT).cogroup(visits.groupBy(*_SEAT)).applyInArrow(_at_home(top), _FOUND), "met")]
    for pairing in rounds(blocks):
        goes = F.element_at(F.create_map(*(F.lit(x) for pair in pairing.items() for x in pair)), F.col("block"))
        travelling = seats.withColumn("block", goes).filter("block is not null")
        met.append(materialize(seats.groupBy(*_SEAT).cogroup(travelling.groupBy(*_SEAT)).applyInArrow(_meet, _FOUND), "met"))
    found = met[0]
    for m in met[1:]:
        found = found.unionByName(m)
    # a pair's value is the sum over slices, a term lies in one
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = materialize(summed.withColumn("rank", F.row_number().over(order)).filter(f"part = 'pair' or rank <= {top}").select("lang", "source", "part", "item", "value", "rank"), "audit")
    discard(counted, known, vocabulary, seats, own, *met)
    return ranked
