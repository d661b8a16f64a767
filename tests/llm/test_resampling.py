"""Resampling on odd rows against a plain computation."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tidefunnel.llm import resampling

TARGET = ["lazy dog and fox", None, "", "übergröße naïve café rain", "one two one two"]


def runs_of(text, longest):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, share, least, longest, buckets):
    bucket = lambda r: zlib.crc32(r.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs_of(text, longest)[1]))
    for text in target:
        t.update(map(bucket, runs_of(text, longest)[1]))
    many, aim = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (many + buckets) / ((s[b] + 1) * (aim + buckets))))
        for b in range(buckets)
    }
    out, able = [], []
    for i, (doc_id, text) in enumerate(rows):
        words, runs = runs_of(text, longest)
        weight = sum(gain[bucket(r)] for r in runs) // len(runs) if runs else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words) >= least:
                able.append((-score, doc_id, i))
        out.append([doc_id, len(runs), weight, score, None])
    for rank, (_, _, i) in enumerate(sorted(able)[: len(able) * share[0] // share[1]], 1):
        out[i][4] = rank
    return sorted(map(repr, out))


@pytest.mark.parametrize("longest,least,piece", [(1, 20, 1 << 12), (3, 1, 7), (2, 0, 1 << 12)])
def test_odd_rows(spark, odd, monkeypatch, longest, least, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    aim = spark.createDataFrame([(t,) for t in TARGET], "text string")
    docs = odd.selectExpr("*", "1 as rank", "2 as score", "3 as n_words", "4 as runs")
    got = resampling.resampled(docs, aim, (1, 2), least, longest, buckets=500).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, TARGET, (1, 2), least, longest, 500)
    assert sorted(repr([r.doc_id, r.n_features, r.weight, r.score, r["rank"]]) for r in got) == want


def test_nothing(spark, nothing, odd):
    aim = spark.createDataFrame([], "text string")
    assert resampling.resampled(nothing, aim).collect() == []
    assert len(resampling.resampled(odd, aim).collect()) == odd.count()


def test_pieces_keep_words_whole():
    text = "ab cd,é" + "x" * 50 + " yz 12" * 9
    for size in (1, 2, 5, 100):
        parts = resampling.pieces(text, size)
        assert "".join(parts) == text
        assert [w for p in parts for w in runs_of(p, 1)[0]] == runs_of(text, 1)[0]
