"""The stages one by one: what goes, what stays, and the same rows from run()."""

from __future__ import annotations

import hashlib

import public_tokenizers

import corpus_pipeline
from tidefunnel.llm import bpe, mixing, near_dedup, pii, rules

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id for r in rules.quality_rules(docs).where("kept").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    one = stages[names[0]](spark, docs, SMALL).cache()
    assert {r.doc_id for r in one.collect()} == kept and one.columns == columns
    two = stages[names[1]](spark, one, SMALL).cache()
    assert {r.doc_id for r in two.collect()} == {
        r.doc_id for r in near_dedup.near_duplicates(one).where("kept").collect()
    }
    three = stages[names[2]](spark, two, SMALL).cache()
    for r in three.collect():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
    four = stages[names[3]](spark, three, SMALL).cache()
    assert {r.doc_id for r in four.collect()} == {
        r.doc_id for r in mixing.mixed(three).where("kept").collect()
    }
    assert four.columns == columns
    encoding = bpe.load_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {
        (r.doc_id, len(encoding.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest())
        for r in four.collect()
    }
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in got} == want
