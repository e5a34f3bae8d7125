"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

Words are compared by the characters they share in order, gaps allowed: the
kernel of two words sums over all subsequences of ORDER characters that span
ORDER + GAPS positions at most, each weighted DECAY for every skipped
position, word ends counting as characters.  It is cosine-normalized (each
occurrence of a subsequence counting for itself in the norm, values held to 1)
and squared.  ``i.d.i.o.t``, ``idiiot`` and ``i d i o t`` thus stay close to the
insult.  Landmarks are words of the labelled sample whose share of toxic
documents stands out; the Nyström map turns kernel values to landmarks into
features.  A sentence's feature is the sum over its words (a convolution
kernel), so its margin is a sum of one number per word, and a word is
evaluated once per task however often it occurs.

A linear SVM is trained on sentences: the worst of each toxic document is
positive, the 2 * HARD worst of each clean one are negative, and which are
worst is settled in turns, over all sentences of all sampled documents.  A
logistic function of a document's worst sentence, its worst word and how much
and how densely words exceed the margin of a typical insult gives the score.
Its weights are never negative, and it is fitted on features of documents that
the SVM behind them has not seen (two further fits, each on one half).

The classifier is fitted on a bounded sample of labelled rows that have a
document: at most SAMPLE_TOXIC toxic and SAMPLE_CLEAN clean ones, in the order
of a digest of the id; the lesser text of a repeated id.  Texts are read on the
executors, whole; per turn the driver gets kernel values to LANDMARKS landmarks
of at most SAMPLE_TOXIC + 2 * HARD * SAMPLE_CLEAN sentences a fit.  Scoring
reads every whole text, map-side only.

Edge cases: null and empty texts have the score of a text without any word.
Null ids are scored, and are never held out.  Labels that are null or lack a
document are ignored.  Without evidence every score is 0, so that nothing is
rejected: without labels of both kinds, or if no word of three letters or more
stands in two toxic documents and in a larger share of them than of clean ones.
Repeated rows stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .words import WordTable, slices, split

ORDER, GAPS, DECAY, LANDMARKS, RIDGE = 4, 2, 0.5, 128, 1e-3
SAMPLE_TOXIC, SAMPLE_CLEAN, TURNS = 1000, 2000, 3
WINDOW, HARD, THRESHOLD, FOLDS, HELD_FOLD = 32, 3, 0.3, 4, 2
_FILTER_BITS = 22
_LETTERS = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<!\S)(?:\w[^\w\s]*\s+){3,}\w(?!\w)")
_HAS_SPACED = r"(?:^|\s)(?:[\p{L}\p{N}][^\p{L}\p{N}\s]*\s+){3}[\p{L}\p{N}](?:[^\p{L}\p{N}]|\z)"


def _patterns() -> list[tuple[tuple[int, ...], float]]:
    """Places of a subsequence's characters from its first one, and its weight."""
    return [((0, *inner), DECAY ** (inner[-1] - ORDER + 1)) for inner in combinations(range(1, ORDER + GAPS), ORDER - 1)]


def normalize(word: str) -> str:
    """Lower-case letters alone, whatever stands between them."""
    return "".join(_LETTERS.findall(word.lower()))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of all subsequences of all words, and each word's norm."""
    texts = [f"\x02{w}\x03" for w in words]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at, codes, weights = [], [], []
    norm = np.full(len(words), 1e-9)
    for places, weight in _patterns():
        n = len(chars) - places[-1]
        if n <= 0:
            continue
        ok = np.nonzero(owner[:n] == owner[places[-1] :])[0]
        code = np.zeros(len(ok), np.uint64)
        for p in places:
            code = code * np.uint64(0x9E3779B97F4A7C15) + chars[ok + p] * np.uint64(0xC2B2AE3D27D4EB4F)
            code ^= code >> np.uint64(29)
        at.append(owner[ok])
        codes.append(code)
        weights.append(np.full(len(ok), weight))
        norm += np.maximum(sizes - places[-1], 0) * weight**2
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return cat(at, np.int64), cat(codes, np.uint64), cat(weights, float), np.sqrt(norm)


class Kernel:
    """Squared cosine kernel values between any words and fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        at, codes, weights, norm = _codes(landmarks)
        self.known, place = np.unique(codes, return_inverse=True)
        self.table = np.zeros((len(self.known), len(landmarks)), np.float32)
        np.add.at(self.table, (place, at), weights)
        self.table /= norm.astype(np.float32)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def __call__(self, words: list[str], step: int = 5_000) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        for lo in range(0, len(words), step):
            at, codes, weights, norm = _codes(words[lo : lo + step])
            hit = np.nonzero(self.maybe[(codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])[0]
            place = np.minimum(np.searchsorted(self.known, codes[hit]), max(len(self.known) - 1, 0))
            real = self.known[place] == codes[hit] if len(hit) else np.zeros(0, bool)
            hit, place = hit[real], place[real]
            order = np.argsort(at[hit], kind="stable")
            hit, place = hit[order], place[order]
            if len(hit):
                first = np.nonzero(np.diff(at[hit], prepend=-1))[0]
                sums = np.add.reduceat(self.table[place] * weights[hit, None].astype(np.float32), first, axis=0)
                rows = at[hit][first]
                out[lo + rows] = np.minimum(1, sums / norm[rows, None]) ** 2
        return out


class Model(NamedTuple):
    landmarks: list[str]
    weights: np.ndarray  # of kernel values, Nyström map and SVM in one
    bias: float
    knee: float  # half the margin of a typical insult
    link: np.ndarray  # logistic weights of document_features, then the intercept


class Scorer:
    """Scores texts with a model; keeps the margins of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        kernel = Kernel(model.landmarks)

        def rows(words: list[str]) -> np.ndarray:
            cores = [normalize(w) for w in words]
            distinct = list(dict.fromkeys(cores))
            value = dict(zip(distinct, (kernel(distinct) @ model.weights).tolist(), strict=True))
            return np.array([(value[c], w[-1] in ".!?") for c, w in zip(cores, words, strict=True)], np.float32).reshape(-1, 2)

        self.table = WordTable(rows)

    def features(self, texts: pa.Array) -> np.ndarray:
        """See document_features."""
        words, index, offsets = split(joined_spaced(texts))
        rows = self.table.lookup(words)[index]
        return document_features(rows[:, 0], rows[:, 1] > 0, offsets, self.model.bias, self.model.knee)

    def score(self, texts: pa.Array) -> np.ndarray:
        x = self.features(texts)
        return 1 / (1 + np.exp(-(x @ self.model.link[:-1] + self.model.link[-1])))


def joined_spaced(texts: pa.Array) -> pa.Array:
    """Texts with their runs of single characters appended as words."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    some = pc.match_substring_regex(texts, _HAS_SPACED).to_numpy(zero_copy_only=False)
    if not some.any():
        return texts
    out = texts.to_pylist()
    for k in np.nonzero(some)[0].tolist():
        runs = ["".join(m.group().split()) for m in _SPACED.finditer(out[k])]
        out[k] = " ".join([out[k], *runs])
    return pa.array(out, pa.string())


def sentence_starts(ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where sentences begin: at a text's start, after a word that ends one, and every WINDOW words of a text."""
    n = int(offsets[-1])
    begin = np.zeros(n + 1, bool)
    begin[offsets[:-1]] = True
    begin[1:][: len(ends)] |= ends
    sizes = np.diff(offsets)
    begin[:n] |= (np.arange(n) - np.repeat(offsets[:-1], sizes)) % WINDOW == 0
    return np.nonzero(begin[:n])[0]


def document_features(margins: np.ndarray, ends: np.ndarray, offsets: np.ndarray, bias: float, knee: float) -> np.ndarray:
    """Per text, in units of the knee: the worst sentence and word, the words over the knee, and these per 100 words."""
    sizes = np.diff(offsets)
    out = np.tile(np.array([bias / knee, 0.0, 0.0, 0.0]), (len(sizes), 1))
    full = sizes > 0
    if full.any():
        margins = margins.astype(float) / knee
        starts = sentence_starts(ends, offsets)
        sums = np.add.reduceat(margins, starts) + bias / knee
        docs = offsets[:-1][full]
        out[full, 0] = np.maximum.reduceat(sums, np.searchsorted(starts, docs))
        out[full, 1] = np.maximum.reduceat(margins, docs)
        over = np.add.reduceat(np.clip(margins, 0, 1) * (margins > 0.8), docs)
        out[full, 2] = np.log1p(over)
        out[full, 3] = np.log1p(100 * over / sizes[full])
    return np.clip(out, -20, 20)


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by accelerated gradient; the bias is not regularized."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w, v, reg = np.zeros(x1.shape[1]), np.zeros(x1.shape[1]), np.r_[np.full(x.shape[1], 1e-3), 0]
    rate = 1 / (2 * np.linalg.eigvalsh(x1.T @ (x1 * cost[:, None]))[-1] + 1e-3)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        new = v - rate * (reg * v - 2 * x1.T @ (cost * slack * y))
        v, w = new + k / (k + 3) * (new - w), new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Weighted ridge logistic regression with weights of 0 or more, by Newton steps; weights, then the intercept."""
    kept = np.arange(x.shape[1])
    while True:
        x1, w = np.hstack([x[:, kept], np.ones((len(x), 1))]), np.zeros(len(kept) + 1)
        penalty = np.r_[np.full(len(kept), ridge), 1e-6]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
            h = x1.T @ (x1 * (cost * p * (1 - p))[:, None]) + np.diag(penalty)
            w = w - np.linalg.solve(h, x1.T @ (cost * (p - y)) + penalty * w)
        if not len(kept) or w[:-1].min() >= 0:
            out = np.zeros(x.shape[1] + 1)
            out[kept], out[-1] = w[:-1], w[-1]
            return out
        kept = np.delete(kept, int(np.argmin(w[:-1])))


def fold(id_column):
    """The remainder that deals out training and held-out rows."""
    return F.crc32(id_column.cast("string").cast("binary")) % FOLDS


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int], dict[int, int]] | None:
    """The training rows (doc_id, half, toxic, text), their counts by label, and the counts of all labelled documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.filter(fold(F.col("doc_id")) != HELD_FOLD).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = materialize(known.join(texts.select("doc_id"), "doc_id", "left_semi"), "labelled")
    counts = dict(known.groupBy("toxic").count().collect())
    if not counts.get(0) or not counts.get(1):
        return None
    some = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers
    drawn = texts.join(F.broadcast(some[0].unionByName(some[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    half = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(2)).cast("int")
    rows = materialize(drawn.select("doc_id", half.alias("half"), "toxic", "text").repartition(12, "doc_id"), "training")
    return rows, {1: min(counts[1], SAMPLE_TOXIC), 0: min(counts[0], SAMPLE_CLEAN)}, counts


def landmarks(rows: DataFrame, n_bad: int, n_good: int, flush: int = 100_000) -> list[str]:
    """Words that stand out in toxic documents, then frequent words of clean ones, 3 to 1 at most; none if no word stands out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            bad, good = zip(*seen.values(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(bad, pa.int64()), pa.array(good, pa.int64())], ["word", "bad", "good"])

        for batch in slices(batches):
            words, index, offsets = split(joined_spaced(batch.column("text")))
            cores = [normalize(w) for w in words.to_pylist()]
            for k, toxic in enumerate(batch.column("toxic").to_pylist()):
                for core in {cores[i] for i in np.unique(index[offsets[k] : offsets[k + 1]]).tolist()}:
                    seen.setdefault(core, [0, 0])[not toxic] += 1
            if len(seen) > flush:
                yield out()
                seen.clear()
        if seen:
            yield out()

    found = rows.select("text", "toxic").mapInArrow(count, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = materialize(found.filter(F.length("word") > 2), "words")
    spread = F.sqrt((F.col("bad") + F.col("good") + 1) / (n_bad + n_good) * (1 / n_bad + 1 / n_good))
    ranked = found.withColumn("z", (F.col("bad") / n_bad - F.col("good") / n_good) / spread)
    worst = [r.word for r in ranked.filter("bad >= 2 and z > 0").orderBy(F.desc("z"), "word").limit(LANDMARKS * 3 // 4).collect()]
    if not worst:
        return []
    rest = [r.word for r in ranked.filter("good > 0").orderBy(F.desc("good"), "word").limit(LANDMARKS).collect()]
    return worst + [w for w in rest if w not in worst][: LANDMARKS // 4]


def _margins(kernel: Kernel, weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Margins (words x fits) of words as they stand in texts."""
    cores = [normalize(w) for w in words]
    number = {c: k for k, c in enumerate(dict.fromkeys(cores))}
    distinct = list(number)
    value = np.zeros((len(distinct), weights.shape[1]))
    for lo in range(0, len(distinct), 20_000):
        value[lo : lo + 20_000] = kernel(distinct[lo : lo + 20_000]) @ weights
    return value[[number[c] for c in cores]].reshape(len(words), -1)


def _worst_sentences(rows: DataFrame, kernel: Kernel, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fit, label, kernel sums) of the sentences that train each fit: all sentences of all rows compete.

    Fit 0 has all rows, fits 1 and 2 one half each.  Without weights a sentence
    is as bad as the first landmark in it.
    """
    names = kernel.landmarks
    guess = {w: float(len(names) - k) for k, w in enumerate(names[: LANDMARKS * 3 // 4])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, index, offsets = split(joined_spaced(batch.column("text")))
            listed = words.to_pylist()
            ends = np.array([w[-1] in ".!?" for w in listed], bool)[index]
            starts = sentence_starts(ends, offsets)
            if not len(starts):
                continue
            first = np.searchsorted(starts, offsets[:-1])
            stops = np.r_[starts[1:], offsets[-1]]
            last = np.r_[first[1:], len(starts)]
            if weights is None:
                value = np.array([[guess.get(normalize(w), 0.0)] for w in listed])
                margin = np.maximum.reduceat(value[index], starts)[:, [0, 0, 0]]
            else:
                margin = np.add.reduceat(_margins(kernel, weights, listed)[index], starts)
            picks = []
            for k, (doc, half, toxic) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "half", "toxic")), strict=True)):
                for fit in (0, 1 + half):
                    own = margin[first[k] : last[k], fit]
                    picks += [(doc, fit, toxic, int(first[k] + s)) for s in np.argsort(-own, kind="stable")[: 1 if toxic else 2 * HARD]]
            used = sorted({p[3] for p in picks})
            spots = [index[starts[s] : stops[s]] for s in used]
            some, flat = np.unique(np.concatenate(spots), return_inverse=True)
            near = kernel([normalize(listed[k]) for k in some.tolist()])
            edge = np.cumsum([0, *map(len, spots)])[:-1]
            sums = dict(zip(used, np.add.reduceat(near[flat], edge), strict=True))
            columns = [pa.array([p[c] for p in picks], t) for c, t in ((0, pa.int64()), (1, pa.int32()), (2, pa.int32()), (3, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([sums[p[3]].astype(np.float32).tobytes() for p in picks], pa.binary())], ["doc_id", "fit", "toxic", "at", "x"])

    found = rows.mapInArrow(run, "doc_id long, fit int, toxic int, at long, x binary").orderBy("fit", "doc_id", "at", "x").toArrow()
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, len(names)).astype(float)
    return found.column("fit").to_numpy(), found.column("toxic").to_numpy(), x


def _worst_words(rows: DataFrame, kernel: Kernel, weights: np.ndarray) -> np.ndarray:
    """Per toxic row: the margin of its worst word under each fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, index, offsets = split(joined_spaced(batch.column("text")))
            full = offsets[1:] > offsets[:-1]
            if full.any():
                top = np.maximum.reduceat(_margins(kernel, weights, words.to_pylist())[index], offsets[:-1][full])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in top.T], ["m0", "m1", "m2"])

    return rows.filter("toxic = 1").select("text").mapInArrow(run, "m0 double, m1 double, m2 double").toPandas().to_numpy().reshape(-1, 3)


def train(rows: DataFrame, sizes: dict[int, int], share_toxic: float) -> Model | None:
    """A model of the rows (doc_id, half, toxic, text), calibrated for documents of which ``share_toxic`` are toxic; None without evidence."""
    names = landmarks(rows, sizes[1], sizes[0])
    if not names:
        return None
    kernel = Kernel(names)
    gram = kernel(names).astype(float)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    nystrom = (vector / np.sqrt(np.maximum(value, 0) + RIDGE)) @ vector.T
    weights, bias = None, np.zeros(3)
    for _ in range(TURNS):
        fit, toxic, x = _worst_sentences(rows, kernel, weights)
        found = np.zeros((len(names), 3))
        for k in range(3):
            own = fit == k
            label = np.where(toxic[own] > 0, 1.0, -1.0)
            cost = np.where(label > 0, 0.5 / max(1, (label > 0).sum()), 0.5 / max(1, (label < 0).sum()))
            # a sentence without any known word is clean: as heavy as all other clean ones
            z = np.vstack([x[own] @ nystrom, np.zeros(len(names))])
            w, bias[k] = _svm(z, np.r_[label, -1.0], np.r_[cost, 0.5])
            found[:, k] = nystrom @ w
        weights = found
    # half the margin of the worst word of a typical toxic document
    knees = 0.5 * np.median(_worst_words(rows, kernel, weights), axis=0)
    knees = np.where(knees > 1e-6, knees, np.maximum(np.abs(bias), 1.0))
    models = [Model(names, weights[:, k].astype(np.float32), float(bias[k]), float(knees[k]), np.zeros(5)) for k in range(3)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row is seen through the fit that had the other half
        scorers = {0: Scorer(models[2]), 1: Scorer(models[1])}
        for batch in slices(batches):
            for half, scorer in scorers.items():
                own = batch.filter(pc.equal(batch.column("half"), half))
                if own.num_rows:
                    got = scorer.features(own.column("text"))
                    yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("toxic"), *(pa.array(c) for c in got.T)], ["doc_id", "toxic", "a", "b", "c", "d"])

    got = rows.mapInArrow(run, "doc_id long, toxic int, a double, b double, c double, d double").orderBy("doc_id").toPandas()
    y = got["toxic"].to_numpy(float)
    prior = np.where(y > 0, share_toxic / y.mean(), (1 - share_toxic) / (1 - y.mean()))
    return models[0]._replace(link=_logistic(got[["a", "b", "c", "d"]].to_numpy(), y, prior))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Trains on a bounded sample of the labelled documents outside the held-out fold."""
    drawn = sampled(docs, labels)
    if drawn is None:
        return None
    rows, sizes, counts = drawn
    return train(rows, sizes, counts[1] / (counts[0] + counts[1]))


def clean_documents(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below THRESHOLD, filtered in place; all columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(scorer.score(batch.column(text_col)) < THRESHOLD)) if scorer else batch

    return small_batches(docs).mapInArrow(run, docs.schema)


def scored(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the text doesn't come back from the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in slices(batches):
            got = scorer.score(batch.column("text")) if scorer else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got)], ["doc_id", "score"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    out = scored(docs, fit(docs, labels))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_FOLD, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
