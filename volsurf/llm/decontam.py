"""Benchmark decontamination by latent semantic retrieval.

Benchmark items, cut into passages of WINDOW words at most, make a TF-IDF
matrix over the benchmark's own vocabulary; inverse document frequencies come
from the whole corpus.  Distributed randomised SVDs of that matrix, one for
each RANK passages and of full rank there, give the latent spaces.  Every document is cut into windows of WINDOW words that overlap
by half; windows are folded into the latent space, and those that hold SHARE or more of
a passage there are candidates.  A candidate is checked on the
words themselves: within SPAN times the item's length, the longest common
subsequence of the item and the words around the window must hold COPY of the
item's words, or PARAPHRASE of them while the item's answer (the last ANSWER
words) stands there word for word.  An item longer than a window is also found
by any one of its passages, which overlap by half: if PART of a passage's words
stand in order within SPAN times its length.  A document thus leaks such an
item as soon as it holds a run of WINDOW of its words, wherever that begins.
Items of fewer than LEAST words must stand
in the text word for word.

The space is that of the benchmark's passages, not the corpus's: a query has
no part outside of it, so no rank is lost to directions that no query uses.
What else a window holds doesn't count: words that no item has, whose weight
would grow with the corpus, leave a copy's share of its passage at 1.  Words in
more than half of all documents weigh nothing, unless an item has no others.
Half-windows are folded in once and added up.

Scale: items are a stated query set, handled in groups of up to ITEMS items and
SHARED blocks of RANK passages; a group's vocabulary, weights and latent
coordinates are bounded by it and go along with the tasks.  A space has as many
directions as its block has passages, so a copy keeps its whole share however
many items there are.  Per group there are two passes over the documents, both map-side:
one counts document frequencies (one small table per task, summed by term), one
searches.  Documents are never shuffled, and all candidates are checked.

Edge cases: null and empty texts are clean, and items without words are found
nowhere.  The similarity of an item that is found by a passage alone is the
passage's.  No items: nothing is found.  Null doc ids are searched
too; repeated rows give repeated results.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lcs
from .words import slices, split

WINDOW, RANK, OVERSAMPLE, SHARE = 64, 256, 16, 0.1
COPY, PARAPHRASE, PART, ANSWER, LEAST, SPAN, ITEMS = 0.8, 0.6, 0.75, 5, 5, 2, 5000
SHARED = 16
#: Partitions of a block of passages, whose products the SVD sums.
PARTS = 8
_TRIM = string.punctuation + "«»“”‘’„…–—¿¡"
_TERM_BLOCK = 64


def cores(words: pa.Array) -> pa.Array:
    """Lower-case words without the punctuation around them."""
    return pc.utf8_trim(pc.utf8_lower(words.cast(pa.string())), _TRIM)


def terms(text: str) -> list[str]:
    return [w for w in cores(pa.array(text.split(), pa.string())).to_pylist() if w]


class Benchmark(NamedTuple):
    """A group of items: their ids, term sequences, and the sorted vocabulary."""

    ids: list
    sequences: list[list[int]]
    vocabulary: list[str]


def block_of(rows: list[tuple]) -> Benchmark:
    split_up = [(i, terms(t or "")) for i, t in rows]
    split_up = [(i, w) for i, w in split_up if w]
    vocabulary = sorted({x for _, w in split_up for x in w})
    number = {w: k for k, w in enumerate(vocabulary)}
    return Benchmark([i for i, _ in split_up], [[number[x] for x in w] for _, w in split_up], vocabulary)


class Words:
    """Term numbers of the words of texts: -1 for words that the benchmark lacks."""

    def __init__(self, vocabulary: list[str]):
        self.vocabulary = pa.array(vocabulary, pa.string())

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, index, offsets = split(texts)
        core = cores(words)
        number = pc.fill_null(pc.index_in(core, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        number[pc.binary_length(core).to_numpy(zero_copy_only=False) == 0] = -2
        number = number[index]
        keep = number > -2
        return number[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str) -> tuple[int, np.ndarray]:
    """Number of documents, and how many have each term; over all whole texts."""
    n = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, rows = Words(vocabulary), np.zeros(n + 1, np.int64), 0
        for batch in slices(batches, text_col):
            rows += batch.num_rows
            number, offsets = words.read(batch.column(text_col))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            known = number >= 0
            both = np.zeros((batch.num_rows, n), bool) if batch.num_rows * n <= 1 << 27 else None
            if both is not None:
                both[doc[known], number[known]] = True
                seen[:n] += both.sum(axis=0)
            else:
                pairs = np.unique(doc[known].astype(np.int64) * n + number[known])
                seen[:n] += np.bincount(pairs % n, minlength=n)
        seen[n] = rows
        some = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some])], ["term", "n"])

    found = docs.select(text_col).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(n + 1, np.int64)
    out[found["term"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return int(out[n]), out[:n]


def passages(sequence: list[int]) -> list[list[int]]:
    """Runs of at most WINDOW words that overlap by half."""
    if len(sequence) <= WINDOW:
        return [sequence]
    return [sequence[at : at + WINDOW] for at in range(0, len(sequence) - WINDOW // 2, WINDOW // 2)]


class Block(NamedTuple):
    """Passages of a group: the item of each, the terms they use, and the passages as numbers of those."""

    items: np.ndarray
    terms: np.ndarray
    passages: list[list[int]]


def blocks_of(sequences: list[list[int]]) -> list[Block]:
    """All passages of all items, RANK to a block; a long item can fill several."""
    cut = [(k, p) for k, s in enumerate(sequences) for p in passages(s)]
    out = []
    for at in range(0, len(cut), RANK):
        items, part = zip(*cut[at : at + RANK], strict=True)
        own = np.unique(np.concatenate(part))
        out.append(Block(np.array(items, np.int64), own, [np.searchsorted(own, p).tolist() for p in part]))
    return out


def groups_of(rows: list[tuple]) -> Iterator[Benchmark]:
    """The items in groups of at most SHARED blocks of passages; a longer item comes alone."""
    part: list[tuple] = []
    size = 0
    for row in rows:
        n = len(passages(terms(row[1] or "")))
        if part and size + n > SHARED * RANK:
            yield block_of(part)
            part, size = [], 0
        part.append(row)
        size += n
    if part:
        yield block_of(part)


def _times(rows: DataFrame, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """AᵀA·right for the TF-IDF matrix A of passages (column ``terms``, one row each), summed over partitions by blocks of terms."""
    n, k = right.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((-(-n // _TERM_BLOCK) * _TERM_BLOCK, k))
        for batch in batches:
            for row in batch.column("terms").to_pylist():
                at, tf = np.unique(np.array(row, np.int64), return_counts=True)
                x = tf * idf[at]
                x /= np.linalg.norm(x) or 1
                total[at] += np.outer(x, x @ right[at])
        blocks = total.reshape(-1, _TERM_BLOCK, k)
        some = [b for b in range(len(blocks)) if blocks[b].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[b].tobytes() for b in some], pa.binary())], ["block", "part"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py(), float) for p in group.column("part"))
        return pa.table({"block": group.column("block").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((-(-n // _TERM_BLOCK), _TERM_BLOCK, k))
    for block, part in rows.mapInArrow(run, "block int, part binary").groupBy("block").applyInArrow(add, "block int, part binary").collect():
        out[block] = np.frombuffer(part, float).reshape(_TERM_BLOCK, k)
    return out.reshape(-1, k)[:n]


def latent_space(rows: DataFrame, n_rows: int, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passages' TF-IDF matrix by randomised subspace iteration."""
    k = min(rank + OVERSAMPLE, n_rows, len(idf))
    start = np.random.default_rng(7).standard_normal((len(idf), k))
    basis, _ = np.linalg.qr(_times(rows, idf, start))
    image = _times(rows, idf, basis)
    value, vector = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    order = np.argsort(-value)
    order = order[(value[order] > 1e-9)][: min(rank, k)]
    return basis @ vector[:, order]


def weights(n_docs: int, df: np.ndarray, sequences: list[list[int]]) -> np.ndarray:
    """Inverse document frequencies of the terms, then the weight of any word the benchmark lacks: none."""
    idf = np.maximum(0.0, np.log((n_docs - df + 0.5) / (df + 0.5)))
    for s in sequences:
        if not idf[s].any():
            idf[s] = 1e-3
    return np.append(idf, 0.0)


class Latent:
    """A block's passages in their latent space, and what the group's terms are there."""

    def __init__(self, block: Block, idf: np.ndarray, space: np.ndarray):
        own = idf[block.terms]
        self.item_of = block.items
        self.passages = [block.terms[p] for p in block.passages]
        self.number = np.full(len(idf), -1, np.int32)  # the last place is that of foreign words, -1
        self.number[block.terms] = np.arange(len(block.terms), dtype=np.int32)
        self.space = (space * own[:, None]).astype(np.float32)
        vectors = []
        for p in block.passages:
            at, tf = np.unique(p, return_counts=True)
            x = tf * own[at]
            vectors.append(x @ space[at])
        self.latent = np.array(vectors, np.float32).T
        self.length = np.maximum(np.linalg.norm(self.latent, axis=0), 1e-12)


class Finder:
    """Finds the items of a group in documents."""

    def __init__(self, block: Benchmark, idf: np.ndarray, latents: list[Latent]):
        self.block, self.words, self.idf, self.latents = block, Words(block.vocabulary), idf, latents
        self.mark = np.zeros(len(block.vocabulary) + 1, bool)  # the last place is that of foreign words, -1
        self.terms = [np.unique(s).astype(np.int32) for s in block.sequences]
        self.places = [self._places(s) for s in block.sequences]

    @staticmethod
    def _places(sequence: Sequence[int]) -> dict[int, int]:
        where: dict[int, int] = {}
        for j, t in enumerate(sequence):
            where[t] = where.get(t, 0) | 1 << j
        return where

    def _candidates(self, latent: Latent, number: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(row, start word, passage, cosine) of windows that hold SHARE of a passage of a block.

        The share is the window's part along the passage: no other word of the
        window bears on it.  The cosine is over the block's words, and counts
        each occurrence of a repeated word as a dimension of its own in the
        window's length, so it is never below the usual one.
        """
        half = WINDOW // 2
        n_blocks = -(-np.diff(offsets) // half)
        row = np.repeat(np.arange(len(n_blocks)), n_blocks)
        if not len(row):
            return
        start = offsets[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)) * half
        weight = self.idf[number]
        number = latent.number[number]
        inner = np.add.reduceat(np.where(number >= 0, weight**2, 0), start)
        heavy = np.nonzero((number >= 0) & (weight > 0))[0]
        block_at = np.searchsorted(start, heavy, side="right") - 1
        same, first = row[1:] == row[:-1], np.append(True, row[1:] != row[:-1])
        for lo in range(0, len(row), 4096):
            hi = min(lo + 4096, len(row))
            end = min(hi + 1, len(row))  # the next block completes the last window
            z = np.zeros((end - lo, latent.space.shape[1]), np.float32)
            a, b = np.searchsorted(block_at, [lo, end])
            if a < b:
                own = block_at[a:b]
                edge = np.nonzero(np.diff(own, prepend=-1))[0]
                z[own[edge] - lo] = np.add.reduceat(latent.space[number[heavy[a:b]]], edge, axis=0)
            joined = np.zeros(hi - lo, bool)
            joined[: end - lo - 1] = same[lo : end - 1]
            k = np.nonzero(joined)[0]
            w_in = inner[lo:hi].copy()
            w_in[k] += inner[lo:end][k + 1]
            # a document's last block is part of the window before it, unless it is the first too
            some = np.nonzero((w_in > 0) & (joined | first[lo:hi]))[0]
            window = z[some]
            more = joined[some]
            window[more] += z[some[more] + 1]
            along = (window @ latent.latent) / latent.length
            w, p = np.nonzero(along >= SHARE * latent.length)
            at = lo + some[w]
            cosine = along[w, p] / np.sqrt(w_in[some[w]])
            yield from zip(row[at].tolist(), start[at].tolist(), p.tolist(), cosine.tolist(), strict=True)

    def find(self, texts: pa.Array) -> list[tuple[int, int, float, float, bool]]:
        """(row, item, cosine, similarity, answer) of every item found in the texts."""
        number, offsets = self.words.read(texts)
        near: dict[tuple[int, int], list[tuple[int, float]]] = {}
        parts: dict[tuple[int, int], dict[tuple[int, int], list[int]]] = {}
        for which, latent in enumerate(self.latents):
            for row, start, p, cosine in self._candidates(latent, number, offsets):
                item = int(latent.item_of[p])
                near.setdefault((row, item), []).append((start, cosine))
                if len(self.block.sequences[item]) > WINDOW:
                    parts.setdefault((row, item), {}).setdefault((which, p), []).append(start)
        out = []
        for (row, item), spots in sorted(near.items()):
            begin, end = int(offsets[row]), int(offsets[row + 1])
            best = (0.0, False)
            for low, high in self._around([s for s, _ in spots], len(self.block.sequences[item]), begin, end):
                best = max(best, self._check(item, number[low:high]), key=self._rank)
            found = self._rank(best)[0]
            for (which, p), starts in parts.get((row, item), {}).items() if not found else ():
                passage = self.latents[which].passages[p]
                for low, high in self._around(starts, len(passage), begin, end):
                    share = max((x for x, _ in self._shares(passage, np.unique(passage), self._places(passage.tolist()), number[low:high], PART)), default=0.0)
                    if share >= PART:
                        found, best = True, max(best, (share, False))
            if found:
                out.append((row, item, max(c for _, c in spots), *best))
        return out

    @staticmethod
    def _around(starts: list[int], around: int, begin: int, end: int) -> list[list[int]]:
        """Stretches of a document around windows; those of neighbouring windows are one, so that their words are looked through once."""
        runs: list[list[int]] = []
        for start in sorted(starts):
            low, high = max(begin, start - around), min(end, start + WINDOW + around)
            if runs and low <= runs[-1][1]:
                runs[-1][1] = high
            else:
                runs.append([low, high])
        return runs

    @staticmethod
    def _rank(found: tuple[float, bool]) -> tuple[bool, float]:
        return found[0] >= COPY or found[0] >= PARAPHRASE and found[1], found[0]

    def _check(self, item: int, region: np.ndarray) -> tuple[float, bool]:
        """(similarity, answer) of the best stretch of SPAN times the item's length."""
        sequence, where = self.block.sequences[item], self.places[item]
        n, answer = len(sequence), sequence[-ANSWER:]
        holds = lambda text, run: any(text[k : k + len(run)] == run for k in range(len(text) - len(run) + 1))
        if n < LEAST:
            whole = holds(region.tolist(), sequence)
            return float(whole), whole
        best = (0.0, False)
        for share, text in self._shares(sequence, self.terms[item], where, region, PARAPHRASE):
            best = max(best, (share, holds(text.tolist(), answer)), key=self._rank)
        return best

    def _shares(self, sequence: Sequence[int], own: np.ndarray, where: dict[int, int], region: np.ndarray, least: float) -> Iterator[tuple[float, np.ndarray]]:
        """(share of the sequence in order, words) of each stretch of SPAN times its length that holds ``least`` of it or more."""
        n = len(sequence)
        self.mark[own] = True
        known = self.mark[region]
        self.mark[own] = False
        count = np.concatenate([[0], np.cumsum(known)])
        at = np.arange(0, max(1, len(region) - SPAN * n + (n + 1) // 2), (n + 1) // 2)
        for k in at[count[np.minimum(at + SPAN * n, len(region))] - count[at] >= least * n].tolist():
            text = region[k : k + SPAN * n]
            share = lcs.length(text[known[k : k + SPAN * n]].tolist(), where, n) / n
            if share >= least:
                yield share, text


def finders(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> Iterator[Finder]:
    """A finder for each group of items; reads the documents once per group for their frequencies."""
    spark = docs.sparkSession
    numbered = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().orderBy("item_id", "text")
    n = numbered.count()
    for at in range(0, n, ITEMS):
        for group in groups_of([tuple(r) for r in numbered.offset(at).limit(ITEMS).collect()]):
            if not group.ids:
                continue
            n_docs, df = document_frequencies(docs, group.vocabulary, text_col)
            idf = weights(n_docs, df, group.sequences)
            latents = []
            for block in blocks_of(group.sequences):
                rows = spark.createDataFrame(pa.table({"terms": pa.array(block.passages, pa.list_(pa.int32()))})).repartition(PARTS)
                latents.append(Latent(block, idf, latent_space(rows, len(block.passages), idf[block.terms])))
            yield Finder(group, idf, latents)


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, similarity, answer): one row per document and item found in it."""
    ddl = "doc_id long, item_id long, cosine double, similarity double, answer boolean"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for finder in finders(docs, benchmark, text_col):
        part = rows.mapInArrow(_search(finder), ddl)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], ddl)


def _search(finder: Finder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = finder.find(batch.column("text"))
            if found:
                row, item, cosine, similarity, answer = zip(*found, strict=True)
                columns = [batch.column("doc_id").take(pa.array(row)), pa.array([finder.block.ids[i] for i in item], pa.int64()), pa.array(cosine), pa.array(similarity), pa.array(answer)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "cosine", "similarity", "answer"])

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, filtered in place."""
    for finder in finders(docs, benchmark, text_col):

        def run(batches: Iterator[pa.RecordBatch], finder: Finder = finder) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col):
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, *_ in finder.find(batch.column(text_col))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
