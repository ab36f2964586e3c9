"""A corpus pipeline: toxicity, near-duplicates, decontamination, secrets, source mixture.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept and returns a
frame; ``run`` writes it as Parquet below ``spark.checkpoint.dir`` and reads it back for the next.
All stages but the last return the columns of ``documents``; the last adds ``n_tokens`` and ``copies``.
Stages accept nulls in any column, empty and very long texts, repeated rows, empty tables and extra
columns, as the operators they call say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.llm import decontam, near_texts, secret_scan, toxicity
from etlkit.llm.common import materialize
from etlkit.llm.queries import TOXIC_CATEGORIES, mixture
from etlkit.llm.registry import table

def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier chain rejects."""
    chain = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), "toxic", TOXIC_CATEGORIES)
    return toxicity.scored(docs, chain).filter(~F.col("rejected")).select(*docs.columns)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by a Jaccard similarity of 0.8 or more on 5-word shingles."""
    return near_texts.distinct_texts(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    return secret_scan.redacted(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with how often each is repeated."""
    out = mixture(docs).filter("copies > 0")
    return out.drop("__domain", "__lang", "__source")


STAGES = [
    ("toxicity", toxic_out),
    ("near_dedup", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("secrets", secrets_out),
    ("mixing", mixed_sources),
]

# The classifier, the fingerprints and the forest have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
