"""From raw documents to token digests in five stages; each works on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.  Between stages the rows are written to the shared
folder and read again, so a lost executor costs its running tasks only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefunnel.llm import bpe, mixing, near_dedup, pii, rules
from tidefunnel.session import work_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go (NULL and empty texts too)."""
    return rules.passing(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return near_dedup.representatives(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, plain or disguised, becomes the name of its kind; ``n_chars`` follows."""
    clean = pii.without_pii(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay with the probabilities that the raked token weights give."""
    return mixing.sampled(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", deduplicate),
    ("pii", redact),
    ("mixing", mix),
    ("byte_bpe", tokenize),
]

# Tokenizers and the transducers of the third stage are beyond SQL; tests/llm checks by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        folder = work_folder(spark, f"stage-{name}")
        result.write.parquet(folder)
        docs = spark.read.schema(result.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
