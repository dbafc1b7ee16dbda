"""Corpus preparation: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Quality classifier, language ID, n-gram Jaccard join (five words, similarity 0.8; one document of
each group stays), benchmark decontamination and mixing to target weights. All but the last return
the columns of their input; the last adds ``loss_weight``. Iterative fits can't be written in SQL,
so ORACLE_SQL is None and the tests hold the stages against plain versions.
"""

from pyspark.sql import DataFrame, SparkSession

from headroom.llm import decontam, langid, mixing, quality, setjoin
from headroom.llm.text import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accept(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language, or between two, go."""
    return langid.accept(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id."""
    return setjoin.keep_one(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose weighted token shares meet flattened source, language and topic targets."""
    return mixing.sample(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
