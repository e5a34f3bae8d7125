"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per text:

* the text: a naive Bayes model over character trigrams of its words;
* the language that markup or metadata declares, weighed by how far
  declarations agree with texts over the whole corpus;
* the address suffix, as a prior over languages;
* the host, as a prior smoothed towards its suffix's, which is smoothed towards
  the corpus: ``(n_host + STRENGTH * p_suffix) / (N_host + STRENGTH)``.

Priors and agreement are grouped aggregations over all texts, counted by what
each text alone says.  Trigram likelihoods of neighbouring characters are far
from independent, so their sum is tempered: a long text counts as EVIDENCE
trigrams at most.

A background class stands for all other languages and for noise: FLOOR of the
way from a typical text's mean log-likelihood of a trigram to that of an unseen
one.  It takes part in the posterior of texts with ENOUGH trigrams or more; a
text that it wins is ``other`` and rejected.

The trigram model is fitted on a bounded sample: SAMPLE labelled texts per
language, in the order of a digest of the id.

Scale: scoring is map-side and works once per distinct word of a task.  Hosts
are counted with partial aggregation, so a host with a third of all texts is
one row per task.  Prior tables have a row per host and per declared language;
they are broadcast up to BROADCAST_ROWS rows and joined by key beyond.

Edge cases: null, empty and letterless texts have no text evidence: their
language is ``und`` and they are rejected.  Null hosts and suffixes are groups
of their own; a null declaration is no evidence.  Ties go to the first of
``languages``.  Repeated rows stay.  Very long texts are read whole, in one
array of their own: memory follows the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import html_text
from .common import extended, materialize, small_batches
from .url_filter import host_of
from .words import WordTable, slices, split

LANGUAGES = ("en", "de", "fr", "es")
SAMPLE, BUCKETS, SMOOTHING = 500, 1 << 17, 0.3
EVIDENCE, STRENGTH, ACCEPT, BROADCAST_ROWS = 120.0, 20.0, 0.5, 100_000
FLOOR, ENOUGH, BACKGROUND = 0.4, 20, 0.01
_LETTERS = re.compile(r"[^\W\d_]+")


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of all character trigrams of words between end marks; runs of letters only."""
    runs = [(k, f"\x02{r}\x03") for k, w in enumerate(words) for r in _LETTERS.findall(w.lower())]
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.fromiter((len(r) for _, r in runs), np.int64, len(runs))
    chars = np.frombuffer("".join(r for _, r in runs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(runs)), sizes)
    ok = np.nonzero(owner[:-2] == owner[2:])[0]
    code = (chars[ok] * np.uint64(0x9E3779B97F4A7C15) + chars[ok + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + chars[ok + 2] * np.uint64(0x165667B19E3779F9)) >> np.uint64(30)
    word = np.array([k for k, _ in runs], np.int64)
    return word[owner[ok]], (code % np.uint64(BUCKETS)).astype(np.int64)


class Model(NamedTuple):
    languages: tuple[str, ...]
    log_p: np.ndarray  # BUCKETS x languages
    floor: float  # the background's log-likelihood of a trigram


class Scorer:
    """Per text: the log-likelihood under each language, and the number of trigrams."""

    def __init__(self, model: Model):
        n = len(model.languages)

        def rows(words: list[str]) -> np.ndarray:
            out = np.zeros((len(words), n + 1), np.float32)
            word, bucket = _trigrams(words)
            if len(word):
                first = np.nonzero(np.diff(word, prepend=-1))[0]
                at = word[first]
                out[at, :n] = np.add.reduceat(model.log_p[bucket], first, axis=0)
                out[at, n] = np.diff(np.append(first, len(word)))
            return out

        self.table = WordTable(rows)

    def score(self, texts: pa.Array) -> np.ndarray:
        words, index, offsets = split(texts.cast(pa.string()))
        rows = self.table.lookup(words)
        out = np.zeros((len(texts), rows.shape[1]))
        full = np.diff(offsets) > 0
        if full.any():
            out[full] = np.add.reduceat(rows[index].astype(float), offsets[:-1][full], axis=0)
        return out


def model_of(counts: np.ndarray, languages: Sequence[str]) -> Model:
    """The model of trigram counts (BUCKETS x languages)."""
    smoothed = counts + SMOOTHING
    log_p = np.log(smoothed / smoothed.sum(axis=0))
    sizes = counts.sum(axis=0)
    # the mean over the training texts, weighted by length
    typical = (counts * log_p).sum(axis=0)[sizes > 0] / sizes[sizes > 0]
    unseen = float(np.log(SMOOTHING / smoothed.sum(axis=0)).mean())
    floor = (1 - FLOOR) * float(typical.mean()) + FLOOR * unseen if len(typical) else float("-inf")
    return Model(tuple(languages), log_p.astype(np.float32), floor)


def fit(docs: DataFrame, languages: Sequence[str] = LANGUAGES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """Trains on SAMPLE labelled texts of each language; their counts are made on the executors."""
    known = docs.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna().distinct()
    picks = [known.filter(F.col("label") == x).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for x in languages]
    ids = picks[0]
    for more in picks[1:]:
        ids = ids.unionByName(more)
    # at most SAMPLE ids per language; of a repeated id the lesser text
    ids = ids.groupBy("id").agg(F.min("label").alias("label"))
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    place = {x: k for k, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((BUCKETS, len(place)), np.int64)
        for batch in slices(batches):
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                seen[:, place[label]] += np.bincount(_trigrams((text.as_py() or "").split())[1], minlength=BUCKETS)
        bucket, k = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(k), pa.array(seen[bucket, k])], ["bucket", "k", "n"])

    # at most BUCKETS rows per language
    found = texts.select("text", "label").mapInArrow(count, "bucket long, k long, n long").groupBy("bucket", "k").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS, len(languages)))
    counts[found["bucket"].to_numpy(int), found["k"].to_numpy(int)] = found["n"]
    return model_of(counts, languages)


def scored(df: DataFrame, model: Model, text_col: str, keep: Sequence[str], prepare=None) -> DataFrame:
    """Columns ``keep`` with ``log_p`` (an array by language) and ``trigrams``; ``prepare`` turns raw values into text."""
    base = small_batches(df).select(*dict.fromkeys([*keep, text_col]))
    schema = extended(base.select(*keep).schema, "log_p array<double>, trigrams double")
    n = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches, text_col):
            texts = batch.column(text_col)
            got = scorer.score(prepare(texts) if prepare else texts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(got) + 1, n, dtype=np.int32)), pa.array(np.ascontiguousarray(got[:, :n]).ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists, pa.array(got[:, n])], [*keep, "log_p", "trigrams"])

    return base.mapInArrow(run, schema)


def _text_alone(languages: Sequence[str], floor: float):
    """The most likely language by the text; null without evidence, and where the background is likelier."""
    best = F.array_position(F.col("log_p"), F.array_max("log_p")).cast("int")
    known = (F.col("trigrams") < ENOUGH) | (F.array_max("log_p") >= F.col("trigrams") * floor)
    return F.when((F.col("trigrams") > 0) & known, F.element_at(F.array(*map(F.lit, languages)), best))


class Priors(NamedTuple):
    host: DataFrame  # host, suffix, prior array
    declared: DataFrame  # declared, agreement array
    unseen: list[float]


def priors(rows: DataFrame, languages: Sequence[str], floor: float = float("-inf")) -> Priors:
    """Smoothed priors and agreement; rows: host, suffix, declared, log_p, trigrams."""
    text = rows.select("host", "suffix", "declared", _text_alone(languages, floor).alias("language")).filter("language is not null")
    counts = materialize(text.groupBy("host", "suffix", "declared", "language").agg(F.count("*").alias("n")), "counts")
    per = [F.sum(F.when(F.col("language") == x, F.col("n")).otherwise(0)).cast("double").alias(f"n{k}") for k, x in enumerate(languages)]
    names = [f"n{k}" for k in range(len(languages))]
    total = counts.agg(*per).first()
    share = [(total[c] or 0) + 1 for c in names]
    share = [s / sum(share) for s in share]

    def smoothed(table: DataFrame, towards: list) -> list:
        size = sum((F.col(c) for c in names[1:]), F.col(names[0]))
        return [((F.col(c) + STRENGTH * p) / (size + STRENGTH)) for c, p in zip(names, towards, strict=True)]

    by_suffix = counts.groupBy("suffix").agg(*per)
    by_suffix = by_suffix.select(F.col("suffix").alias("_suffix"), F.array(*smoothed(by_suffix, [F.lit(s) for s in share])).alias("up"))
    by_host = counts.groupBy("host", "suffix").agg(*per).join(by_suffix, F.col("suffix").eqNullSafe(F.col("_suffix")))
    by_host = by_host.select(F.col("host").alias("_host"), F.col("suffix").alias("_suffix"), F.array(*smoothed(by_host, [F.col("up")[k] for k in range(len(names))])).alias("prior"))
    by_declared = counts.filter("declared is not null").groupBy("declared").agg(*per)
    agreement = [(F.col(c) + 1) / (float(total[c] or 0) + len(names)) for c in names]
    by_declared = by_declared.select(F.col("declared").alias("_declared"), F.array(*agreement).alias("agreement"))
    return Priors(materialize(by_host, "by_host"), materialize(by_declared, "by_declared"), share)


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fused(rows: DataFrame, known: Priors, languages: Sequence[str], floor: float = float("-inf")) -> DataFrame:
    """``rows`` without log_p, with text_language, language, posterior and accepted."""
    by = rows.join(_bounded(known.host), F.col("host").eqNullSafe(F.col("_host")) & F.col("suffix").eqNullSafe(F.col("_suffix")), "left")
    by = by.join(_bounded(known.declared), F.col("declared") == F.col("_declared"), "left")
    temper = F.lit(EVIDENCE) / F.greatest(F.lit(EVIDENCE), F.col("trigrams"))
    unseen = F.array(*map(F.lit, known.unseen))
    logs = []
    for k in range(len(languages)):
        prior = F.log(F.coalesce(F.col("prior"), unseen)[k])
        declared = F.coalesce(F.log(F.col("agreement")[k]), F.lit(0.0))
        logs.append(F.col("log_p")[k] * temper + prior + declared)
    # other languages have no prior of their own: a small share of every text
    other = F.when(F.col("trigrams") >= ENOUGH, F.col("trigrams") * floor * temper + float(np.log(BACKGROUND))).otherwise(float("-inf"))
    by = by.withColumn("_logs", F.array(*logs, other))
    top = F.array_max("_logs")
    posterior = 1 / F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    language = F.element_at(F.array(*map(F.lit, (*languages, "other"))), F.array_position("_logs", top).cast("int"))
    some = F.col("trigrams") > 0
    out = by.withColumns({"text_language": F.coalesce(_text_alone(languages, floor), F.when(some, "other").otherwise("und")), "language": F.when(some, language).otherwise("und"), "posterior": F.when(some, posterior).otherwise(F.lit(0.0))})
    out = out.withColumn("accepted", some & (F.col("language") != "other") & (F.col("posterior") >= ACCEPT))
    return out.drop("_host", "_suffix", "prior", "_declared", "agreement", "_logs", "log_p")


def suffix_of(host):
    """What follows the last dot of a host without its port; null without a dot."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    return F.when(F.instr(bare, ".") > 0, F.substring_index(bare, ".", -1))


def declared_in(html):
    """The main language that a page's html element declares, lower-case; null if none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.nullif(found, F.lit(""))


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, host, suffix, declared, text_language, language, posterior, accepted) of web pages."""
    def text(html: pa.Array) -> pa.Array:
        return pa.array([html_text.visible(h) for h in pc.fill_null(html, "").to_pylist()], pa.string())

    host = F.nullif(host_of(F.col("url")), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), suffix_of(host).alias("suffix"), declared_in(F.col("html")).alias("declared"), "html")
    rows = materialize(scored(rows, model, "html", ["page_id", "host", "suffix", "declared"], text), "page_scores")
    return fused(rows, priors(rows, model.languages, model.floor), model.languages, model.floor).drop("trigrams")


def accepted_documents(docs: DataFrame, model: Model, host_col: str = "source", declared_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is accepted; all columns stay as they are.

    Texts are scored twice, first for the priors, so that they are never
    written or shuffled on the way.
    """
    columns = docs.columns
    inner = [f"c{k}" for k in range(len(columns))]  # so that no column clashes with those added here
    of = dict(zip(columns, inner, strict=True))
    host = F.nullif(F.col(of[host_col]).cast("string"), F.lit(""))
    rows = docs.toDF(*inner).withColumns({"host": host, "suffix": suffix_of(host), "declared": F.lower(F.col(of[declared_col]).cast("string"))})
    text, keep = of[text_col], ["host", "suffix", "declared"]
    known = priors(scored(rows, model, text, keep), model.languages, model.floor)
    return fused(scored(rows, model, text, [*inner, *keep]), known, model.languages, model.floor).filter("accepted").select(*inner).toDF(*columns)
