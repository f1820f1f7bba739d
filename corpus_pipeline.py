"""A training-data pipeline over `documents`: five stages, each by one operator of `newsloom.llm`.

Toxic documents go, one document of each group of near duplicates stays (five-word shingles,
similarity 0.8), documents with benchmark items go, secrets are replaced by their kind, and what is
left is packed into sequences. Every stage works on all rows that its predecessor kept and, but for the
last, returns the columns it was given. NULL and empty texts are neither toxic nor copies nor leaks;
they pass and give a piece with the end id alone. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontamination, near_dedup, packing, secret_scan, toxicity
from newsloom.llm.common import bounded_batches, fresh, table, written
from newsloom.llm.workload import toxicity_network

SHINGLE_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score reaches the threshold of their language."""
    net = toxicity_network(spark, docs, sf_dir)
    score = fresh(docs.columns, "_score")
    scored = toxicity.score(docs, net, output=score)
    return scored.where(F.col(score) < toxicity.threshold_of(net, F.col("lang"))).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs, SHINGLE_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret gives way to its kind in angle brackets; `n_chars` follows the text."""
    bounded_batches(spark)
    clean = docs.withColumn("text", secret_scan.redacted(F.col("text")))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: The classifier and the tokenizer are not SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage kept is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
