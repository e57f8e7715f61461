"""The training-data pipeline over ``documents``: stages that are written and read in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm import decontaminate, language, mixing, near_docs, secret_scan, toxicity
from siltlake.llm.common import read, saved
from siltlake.llm.queries import TOXIC, WEIGHTS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity stays below the limit; learns outside the held-out fold.

    Null, empty and term-less texts score the prior and stay. Without labels nothing is dropped.
    """
    labels = read(spark, sf_dir, "labels").where(~language.fold(F.col("doc_id"), 3, 1))
    return toxicity.accepted(docs, toxicity.fit(docs, labels), TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each class of near duplicates; texts without words stay."""
    return near_docs.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    return decontaminate.clean_rows(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets in its text give way to a mark."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicates documents to the target weights and shuffles; adds ``copy`` and ``mix_order``."""
    return mixing.replicate(docs, WEIGHTS, seed=7)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: Nearest neighbours and components are beyond SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
