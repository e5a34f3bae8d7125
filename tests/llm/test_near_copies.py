"""The near-copies stage against brute-force Jaccard similarity."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_ops import prose, roots
from volsurf.llm import near_copies

ROW = "doc_id long, text string, lang string, source string, n_chars long"


def plain_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def expected(texts):
    """(id, text) of the row that stays of each group."""
    sets = sorted({plain_set(t) for _, t in texts}, key=sorted)
    link = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9
    to = roots(range(len(sets)), [(i, j) for i, j in combinations(range(len(sets)), 2) if link(sets[i], sets[j])])
    groups = {}
    for i, t in texts:
        groups.setdefault(to[sets.index(plain_set(t))], []).append((i is None, i, t or ""))
    return groups


def edited(text, share, seed):
    r, words = random.Random(seed), text.split()
    for k in r.sample(range(len(words)), int(len(words) * share)):
        words[k] = f"new{r.randint(0, 10**6)}"
    return " ".join(words)


def corpus():
    base = [prose(150, k) for k in range(60)]
    texts = list(enumerate(base))
    # edits of 1 to 6 % of the words: similarities on both sides of 0.8
    texts += [(1000 + 10 * k + j, edited(base[k], 0.01 * (j + 1), 100 * k + j)) for k in range(12) for j in range(6)]
    texts += [(2000 + k, edited(base[20], 0.015, k)) for k in range(70)]
    texts += [(3000 + k, base[21].upper()) for k in range(40)]
    words = base[22].split()
    texts += [(4000 + k, " ".join(words[: 150 - 6 * k])) for k in range(12)]
    texts += [(5000, ""), (5001, None), (5002, " \n\t "), (5003, "one two"), (5004, "ONE  two"), (5005, "a b c d e"), (5006, "a b c d e f"), (5007, "x" * 50_000)]
    return texts


@pytest.mark.parametrize("tile", [near_copies.TILE, 24])
def test_groups_are_those_of_brute_force(spark, tile):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], ROW).withColumn("node", F.lit("clash")).withColumn("_k1", F.lit(0)).repartition(5)
    kept = near_copies.representatives(df, tile=tile)
    assert kept.columns == df.columns
    want = {min(g)[1] for g in expected(texts).values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_a_dense_group_takes_rounds(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "CHUNK", 4)
    base = prose(120, 7)
    texts = [(k, edited(base, 0.02, k)) for k in range(90)]
    kept = near_copies.representatives(spark.createDataFrame(texts, "doc_id long, text string"), tile=16)
    assert {r.doc_id for r in kept.collect()} == {min(g)[1] for g in expected(texts).values()}


@pytest.mark.parametrize(("n", "tile"), [(500, 128), (2000, near_copies.TILE)])
def test_a_graded_group_needs_few_exact_checks(spark, n, tile):
    base = prose(300, 11)
    texts = [(k, edited(base, 0.08 * k / n, k)) for k in range(n)]
    kept = {r.doc_id for r in near_copies.representatives(spark.createDataFrame(texts, "doc_id long, text string"), tile=tile).collect()}
    sets = [near_copies.shingles(t) for _, t in texts]
    every = near_copies._Sets(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    # brute force: the exact similarity of all pairs, from a matrix of members
    names = {v: k for k, v in enumerate(np.unique(np.concatenate(sets)).tolist())}
    member = np.zeros((n, len(names)), np.float32)
    for k, s in enumerate(sets):
        member[k, [names[v] for v in s.tolist()]] = 1
    common = member @ member.T
    link = common >= 0.8 * (every.size[:, None] + every.size[None, :] - common) - 1e-9
    to = roots(range(n), zip(*(x.tolist() for x in np.nonzero(np.triu(link, 1))), strict=True))
    assert kept == set(to.values())
    # what the bitmaps leave to the exact test lies near the threshold; they lose no link
    i, j = np.triu_indices(n, 1)
    may = every.may_link(i, j)
    assert not (link[i, j] & ~may).any() and (may & ~link[i, j]).sum() < 0.2 * (~link[i, j]).sum()


def test_equal_ids_and_repeated_rows(spark):
    a, b = prose(60, 1), prose(60, 2)
    rows = [(3, b, "x"), (5, a, "x"), (5, b, "x"), (7, a, "x"), (9, a, "x"), (5, a, "y"), (5, a, "x"), (None, a, "x"), (None, prose(60, 3), "x"), (None, prose(60, 3), "x")]
    kept = near_copies.representatives(spark.createDataFrame(rows, "doc_id long, text string, note string")).collect()
    assert sorted((r.doc_id or -1, r.text, r.note) for r in kept) == sorted([(3, b, "x"), (5, a, "y"), (-1, prose(60, 3), "x")])


def test_empty_table(spark):
    assert near_copies.representatives(spark.createDataFrame([], ROW)).count() == 0
