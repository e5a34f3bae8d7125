"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and rereads it.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from volsurf.llm import decontam, langid, near_copies, packing, toxicity
from volsurf.llm.common import materialize, table
from volsurf.llm.queries import BYTE_TOKENIZER, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.clean_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the accepted languages; ``source`` is the host, ``lang`` the declaration."""
    return langid.accepted_documents(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return near_copies.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces in sequences of 1024."""
    return packing.packed_digests(docs, tokenizer_path(BYTE_TOKENIZER), end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A classifier, a language model, hashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
