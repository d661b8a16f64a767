"""op5's encoder lives as long as its process, and its files are read by one process a task."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers

from tidefunnel.llm import token_files


def test_words_are_parted_before_marks():
    plain = rb"(?<=[a-z])(?=[!-&(-/:-@\[-`{-~])"
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = bytes(rng.choice(list(b"abz!'~`{/09 \n\xc3\xa9"), 60).astype(np.uint8))
        assert re.sub(token_files.EDGE, token_files.APART, text) == re.sub(plain, b" ", text)


def test_the_encoder_outlives_a_task():
    path = public_tokenizers.path("word_bpe_49k.json")
    one = token_files.process_encoder(path, 2)
    assert token_files.process_encoder(path, 2) is one
    assert one(["The dog's 3 cats, née!!"]) == token_files.group_encoder(path, 2)(["The dog's 3 cats, née!!"])


def test_checksums_are_read_by_one_python_step(spark, odd, tmp_path):
    folder = f"file://{tmp_path}/ids"
    manifest = token_files.write_ids(odd, folder, public_tokenizers.path("word_bpe_49k.json"))
    got = token_files.read_checksums(spark, folder, manifest)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapIn") == 1  # two before: ids, then their checksums
    ids = token_files.read_ids(spark, folder, manifest).collect()
    want = [(r.doc_id, r.start, len(r.ids) // 2, zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes())) for r in ids]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect()) and len(want) == odd.count()
