"""Collocations against counting everything."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tidefunnel.llm import collocations as c


def brute(rows, least, longest, first):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        held = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], a)
        mine = []
        for p, a in cand.items():
            if 100 * held[p] >= 100 * a:
                continue
            score, _, l, r = min(
                (1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                for k in range(1, len(p))
            )
            mine.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(mine)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def compare(spark, rows, least, longest=5, first=2000, **more):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, n int, phrase string, edge int")
    got = c.collocations(df.repartition(3), least, longest, first, **more).collect()
    want = brute(rows, least, longest, first)
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == want
    return want


@pytest.mark.parametrize("least,longest,first,more", [
    (3, 5, 2000, {}), (2, 5, 7, {"size": 40}), (4, 3, 2000, {"size": 1}), (2, 5, 2000, {"marks": 1 << 15}),
])
def test_random_texts(spark, least, longest, first, more):
    r = random.Random(least)
    words = ["a", "b", "the", "Über", "x-y", "\x00", "a'b", "NEW", "york", "times"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ! ", "\x0b", "\r\n"]
    rows = [
        ("".join(r.choice(words) + r.choice(gaps) for _ in range(r.randrange(60))), r.choice(["en", "de", None, ""]))
        for _ in range(60)
    ]
    rows += [("new york times square here", "en")] * 9 + [(None, "en"), ("", None), (" .\t", "fr"), ("a " * 300, "en")]
    assert compare(spark, rows, least, longest, first, **more)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert compare(spark, rows, 2)
    assert c.collocations(nothing).collect() == []


def test_large_products_are_exact(spark):
    value = spark.sql(
        "select cast(cast(900000000000001 as decimal(18,0)) * cast(800000000000007 as decimal(18,0)) * cast(1000 as decimal(4,0))"
        " div (cast(900000000000001 as decimal(18,0)) * cast(3 as decimal(18,0))) as long) as v"
    ).first().v
    assert value == 900000000000001 * 800000000000007 * 1000 // (900000000000001 * 3)
