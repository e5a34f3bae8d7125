"""Scan for secrets: three patterns, and strings that look drawn rather than written.

The patterns find assignments of secrets, access keys and long hexadecimal
runs; their matches always stay.  Beside them every run of key characters is
judged by two Markov models, in which a character depends on the two before it:
one of random strings, one of ordinary identifiers.  A run is a secret if the
log-likelihood ratio of the two is ``LEAST_RATIO`` or more, and ``LEAST_EACH`` or
more for each letter or digit; such a span is of kind ``markov``.

The models are trained from labelled samples: (sample, label, n) with label 1
for random strings.  ``labelled_samples`` labels the runs of a corpus by the
patterns: what a pattern holds is random, any other run of identifier
characters is ordinary.  Characters that no sample has follow each other evenly.
Random strings are drawn from alphabets, so that one is likely under the random
model if its characters are spread evenly over a kind of them: its counts are
pooled over the members of a kind (letters, digits), and mixed with an even
distribution, so that samples of one alphabet speak for others.

Scaling: both passes run where the texts lie.  Training yields counts of
triples of characters, summed in each task before they leave it: a table of a
fixed size, whatever the corpus.  A text goes to the regular expressions only
if an Arrow expression has found something like a match in it.

Edge cases: a null or empty text has no spans; spans count code points; patterns
read whole texts, of any length; a run that touches a match of a pattern isn't
judged again; without labelled samples of both labels, nothing is judged and the patterns stand alone;
repeated rows are scanned each; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .words import slices

#: Kinds in their order: (name, pattern, the group whose length counts, its least length).  Fixed values; a whole
#: match's least length stands in its pattern, which finds the same runs.
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]{14,}"), 0, 18),
    ("hex", re.compile("[0-9a-f]{16,}"), 0, 16),
)
KINDS = (*(p[0] for p in PATTERNS), "markov")

#: What the models know: letters, whatever their case, and digits.  Behind any other character, and at a capital
#: after a small letter, a word begins, and what stood before it counts for nothing.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789"
LEAST_RUN = 16
LEAST_RATIO, LEAST_EACH = 12.0, 0.75
#: Weight of the even distribution in each context, in characters.
PRIOR = 4.0
#: Share of the random model in which all characters are alike: samples of few alphabets don't forbid others.
EVEN = 0.5
#: Share of the ordinary model that samples decide; the rest is even, which bounds what one unusual character says.
KNOWN = 0.9

_RUN = re.compile(r"[A-Za-z0-9+/=_-]{16,}")
#: What matches have: cheap tests of whole texts, of an assignment and of any other span.
_HINTS = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", r"[A-Za-z0-9+/=_-]{16}"
#: Codes of characters; the last one stands for what is no symbol, and for the time before a word.
_N = len(SYMBOLS) + 1
_CODE = np.full(256, _N - 1, np.uint8)
_CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
_CODE[np.frombuffer(SYMBOLS[:26].upper().encode(), np.uint8)] = np.arange(26)
_UPPER = np.array([65 <= c <= 90 for c in range(256)])
_LOWER = np.array([97 <= c <= 122 for c in range(256)])
#: Members of a kind are alike to the random model.
_KIND = np.array([0] * 26 + [1] * 10)
_SIZE = np.bincount(_KIND)


def base_spans(text: str, kinds: tuple[int, ...] = (0, 1, 2)) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the patterns' matches, sorted."""
    out = []
    for kind in kinds:
        _, pattern, group, least = PATTERNS[kind]
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out)


def runs(text: str, taken: list[tuple[int, int, int]], least: int = LEAST_RUN) -> list[tuple[int, int]]:
    """(start, end) of the runs of key characters, letters among them, that share none with a taken span."""
    found = [m.span() for m in _RUN.finditer(text) if m.end() - m.start() >= least]
    held = bytearray(len(text)) if taken else b""
    for start, _, end in taken:
        held[start:end] = b"\1" * (end - start)
    return [(a, b) for a, b in found if not any(held[a:b]) and re.search("[A-Za-z]", text[a:b])]


def triples(data: bytes) -> np.ndarray:
    """A code for each symbol of a text with the two before it in its word."""
    text = np.frombuffer(data, np.uint8)
    at = _CODE[text].astype(np.int64)
    begins = np.zeros(len(text) + 1, bool)
    begins[1:-1] = _UPPER[text[1:]] & _LOWER[text[:-1]]
    padded = np.concatenate([[_N - 1, _N - 1], at])
    second = np.where(begins[:-1], _N - 1, padded[1:-1])
    first = np.where((second == _N - 1) | np.concatenate([[True], begins[:-2]])[: len(text)], _N - 1, padded[:-2])
    return ((first * _N + second) * _N + at)[at != _N - 1]


def _based(texts: pa.Array) -> Iterator[tuple[int, str, list[tuple[int, int, int]]]]:
    """(row, text, spans of the patterns) of the texts in which something may match."""
    texts = pc.fill_null(texts, "")
    assigns, long_runs = (pc.match_substring_regex(texts, hint).to_numpy(zero_copy_only=False) for hint in _HINTS)
    for i in np.nonzero(assigns | long_runs)[0].tolist():
        text = texts[i].as_py()
        yield i, text, base_spans(text, (*([0] if assigns[i] else []), *([1, 2] if long_runs[i] else [])))


def _found(texts: pa.Array, ratio: np.ndarray | None) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """(row, spans) of the texts that have any."""
    for i, text, spans in _based(texts):
        if ratio is not None:
            spans = sorted(spans + judged_runs(text, spans, ratio))
        if spans:
            yield i, spans


def _triples_of(strings: list[str]) -> np.ndarray:
    """Counts of the triples of some strings."""
    return np.bincount(triples("\n".join(strings).encode()), minlength=_N**3)


def _listed(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for label in (0, 1):
        code = np.nonzero(counts[label])[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), label, np.int32)), pa.array(code), pa.array(counts[label][code])], ["label", "code", "n"])


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, code, n): how often triples of characters stand in random (1) and ordinary (0) strings of a corpus.

    Labels are the patterns': the values that they match are random, the other
    runs of letters, digits and signs are ordinary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _N**3), np.int64)
        for batch in slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            values = []
            for _, text, spans in _based(texts):
                values += [PATTERNS[kind][1].match(text, start).group(PATTERNS[kind][2]) for start, kind, _ in spans]
            random = _triples_of(values)
            counts[0] += np.maximum(_triples_of(texts.to_pylist()) - random, 0)
            counts[1] += random
        yield from _listed(counts)

    parts = small_batches(docs.select(F.col(text_col).alias("text"))).mapInArrow(run, "label int, code long, n long")
    return parts.groupBy("label", "code").agg(F.sum("n").alias("n"))


def samples_of(strings: DataFrame, sample_col: str = "sample", label_col: str = "label") -> DataFrame:
    """(label, code, n) of labelled strings, for models from other samples than a corpus's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = lambda label: pc.fill_null(batch.filter(pc.equal(batch.column("label"), label)).column("sample"), "").to_pylist()  # noqa: B023, E731
            yield from _listed(np.stack([_triples_of(of(0)), _triples_of(of(1))]))

    rows = strings.select(F.col(sample_col).alias("sample"), F.col(label_col).cast("int").alias("label"))
    return rows.mapInArrow(run, "label int, code long, n long").groupBy("label", "code").agg(F.sum("n").alias("n"))


def fit(samples: DataFrame) -> np.ndarray | None:
    """The log-likelihood ratio of each triple, from counted samples (label, code, n); None without both labels.

    Of the samples only the counts of triples reach the driver: (symbols + 1) ** 3 at most for each label.
    """
    counts = np.zeros((2, _N**3))
    for label, code, n in samples.collect():
        counts[label, code] += n
    if not counts.sum(1).all():
        return None
    counts = counts.reshape(2, _N, _N, _N)[..., : _N - 1]
    # ordinary: contexts of two, smoothed by contexts of one, by single characters, by an even distribution
    single = counts[0].sum((0, 1)) + PRIOR
    single /= single.sum()
    one = counts[0].sum(0) + PRIOR * single
    one /= one.sum(-1, keepdims=True)
    two = counts[0] + PRIOR * one
    two /= two.sum(-1, keepdims=True)
    two = KNOWN * two + (1 - KNOWN) / len(SYMBOLS)
    # random: which kind follows two kinds, then any member alike
    kinds = np.append(_KIND, len(_SIZE))
    pooled = np.zeros((len(_SIZE) + 1, len(_SIZE) + 1, len(_SIZE)))
    first, second, third = np.meshgrid(kinds, kinds, _KIND, indexing="ij")
    np.add.at(pooled, (first, second, third), counts[1])
    pooled += PRIOR * _SIZE / _SIZE.sum()
    pooled /= pooled.sum(-1, keepdims=True)
    drawn = EVEN / len(SYMBOLS) + (1 - EVEN) * pooled[first, second, third] / _SIZE[third]
    out = np.zeros((_N, _N, _N))
    out[..., : _N - 1] = np.log(drawn) - np.log(two)
    return out.reshape(-1)


def judged_runs(text: str, taken: list[tuple[int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the runs that the models call random."""
    out: list[tuple[int, int, int]] = []
    for a, b in runs(text, taken):
        said = ratio[triples(text[a:b].encode())]
        total = float(said.sum())
        if total >= LEAST_RATIO and total >= LEAST_EACH * len(said):
            out.append((a, len(PATTERNS), b))
    return out


def scan(docs: DataFrame, ratio: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every document: arrays of (kind, start, end), by start and then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, spans in _found(batch.column("text"), ratio):
                found[i] = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind_of)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def secrets(docs: DataFrame, samples: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``scan`` with models from ``samples`` (label, code, n), by default from the documents themselves."""
    return scan(docs, fit(labelled_samples(docs, text_col) if samples is None else samples), id_col, text_col)


def masked(docs: DataFrame, ratio: np.ndarray | None, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """``docs`` with ``mark`` in the place of every span, or of spans that overlap; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            for i, spans in _found(batch.column(at), ratio):
                out, end = [], 0
                for a, _, b in spans:
                    if a >= end:
                        out += [texts[i][end:a], mark]
                    end = max(end, b)
                texts[i] = "".join([*out, texts[i][end:]])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return small_batches(docs).mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): counts, and spans as kind:start:end joined by commas."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = F.array_join(F.transform(base, line), ",")
    return found.select("doc_id", *map(of, KINDS[:-1]), F.sha2(joined.cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("spans", line), ",").alias("spans"))


