"""The pipeline's stages on a small corpus whose outcome is known."""

import importlib.util
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices(("th", "ing", "er", "wh", "on", "es"), k=r.randint(1, 4))) for _ in range(n)) + "."


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = [(k, prose(120, k)) for k in range(200)]
    toxic = set(range(0, 200, 5))
    docs = [(k, f"{t} blockhead numbskull {prose(10, k + 500)}" if k in toxic else t) for k, t in docs]
    item = " ".join(f"zu{k}vo" for k in range(30))
    docs += [(300, prose(100, 1)), (301, prose(60, 700) + " " + item + " " + prose(60, 701)), (302, ""), (303, None), (304, "123 456")]
    docs[1] = (1, prose(100, 1))  # a copy of 300
    spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    rows = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = rows.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.columns == columns
        kept.append({r.doc_id for r in rows.select("doc_id").collect()})
    everyone = {i for i, _ in docs}
    assert kept[0] == everyone - toxic and kept[1] == kept[0] - {302, 303, 304} and kept[2] == kept[1] - {300} and kept[3] == kept[2] - {301}
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(got.doc_id) == kept[3] and got.groupby("sequence_id").length.sum().max() <= 1024 and np.all(got.piece == 0)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def write_tables(spark, path, docs, labels, items):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    write_tables(spark, tmp_path, spark.createDataFrame([], DOCUMENTS), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline_keeps_what_is_clean(spark, tmp_path):
    """Repeated and null ids, nulls in every column, columns with names of the stages' own, edited copies, labels of one kind."""
    import corpus_pipeline

    r = random.Random(2)
    docs = [(k, prose(120, k), "en", f"s{k % 3}") for k in range(60)]
    words = docs[7][1].split()
    for k in r.sample(range(120), 2):
        words[k] = f"zu{k}vo"
    docs += [(100, " ".join(words), "en", "s0"), (8, prose(90, 801), "en", None), (None, prose(90, 802), None, "s1"), (None, prose(90, 803), "en", "s1"), (9, docs[9][1], "en", "s2")]
    clash = spark.createDataFrame([(*d, 5, "x", 1.0, "y") for d in docs], f"{DOCUMENTS.rsplit(',', 1)[0]}, n_chars long, node string, score double, host string")
    write_tables(spark, tmp_path, clash, [(k, 1, 0) for k in range(60)], [(0, None), (1, "")])
    rows = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.columns == clash.columns
        seen.append(sorted((x.doc_id is None, x.doc_id or 0, x.text) for x in rows.collect()))
    everything = sorted((i is None, i or 0, t) for i, t, _, _ in docs)
    # labels of one kind reject nothing; the edited copy and the repeated row go, and nothing else
    assert seen[0] == seen[1] == everything
    gone = {100: 1, 9: 1}
    assert len(seen[2]) == len(everything) - 2 and {i: sum(x[1] == i for x in everything) - sum(x[1] == i for x in seen[2]) for i in gone} == gone
    assert seen[3] == seen[2]
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(packed) == len(seen[3]) and packed.doc_id.isna().sum() == 2
