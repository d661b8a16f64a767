"""The registered query of each operator, over its whole table, and SQL where it can be said."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidefunnel.llm import (
    bpe,
    collocations,
    fingerprints,
    gam,
    html_text,
    licenses,
    mixing,
    near_dedup,
    pii,
    range_join,
    resampling,
    rules,
    token_files,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op11_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    drawn = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select(*columns)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_pii, op2_html_extraction, op3_quality_classifier, op4_near_dedup, op5_token_files,
        op6_fingerprints, op7_byte_bpe, op8_license_scan, op9_quality_rules, op10_mixing, op11_range_join,
        op12_resampling, op13_collocations,
    )
}

ORACLES: dict[str, str] = {
    "op4_near_dedup": near_dedup.near_duplicate_sql(),
    "op8_license_scan": licenses.license_sql(),
    "op9_quality_rules": rules.rules_sql(),
    "op10_mixing": mixing.mixing_sql(),
    "op11_range_join": range_join.range_join_sql(),
    "op12_resampling": resampling.resampling_sql(),
    "op13_collocations": collocations.collocations_sql(),
}
