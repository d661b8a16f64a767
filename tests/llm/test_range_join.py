"""The range join on odd rows and against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidefunnel.llm import range_join
from tidefunnel.llm.range_join import cells_of, near_vectors


def brute(rows, least):
    """(id, links, component) of each row, by all pairs; equal ids of copies are one node."""
    good = [
        i for i, (v, label, e) in enumerate(rows)
        if v is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    ]
    links = {i: 0 for i in range(len(rows))}
    root = {i: i for i in good}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    low = {}
    for i in good:
        key = (rows[i][1], tuple(rows[i][2]))
        low[key] = min(low.get(key, rows[i][0]), rows[i][0])
    for n, i in enumerate(good):
        for j in good[n + 1 :]:
            (_, a, x), (_, b, y) = rows[i], rows[j]
            same = low[a, tuple(x)] == low[b, tuple(y)]
            close = a == b and len(x) == len(y) and np.dot(x, y) / math.sqrt(np.dot(x, x) * np.dot(y, y)) >= least
            if close:
                links[i] += 1
                links[j] += 1
            if close or same:
                root[find(i)] = find(j)
    part = {}
    for i in good:
        part[find(i)] = min(part.get(find(i), rows[i][0]), rows[i][0])
    return sorted(
        (repr(rows[i][0]), links[i], repr(part[find(i)] if i in root else rows[i][0])) for i in range(len(rows))
    )


def check(spark, rows, least=0.93):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    df = df.selectExpr("*", "1 as key", "2 as component", "3 as n", "'x' as links").repartition(3)
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    got = near_vectors(df, least).collect()
    assert sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in got) == brute(rows, least)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


ODD = [
    (1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 0, [2.0, 0.0]), (3, 0, [2.0, 0.0]), (4, 0, [0.95, 0.2]),
    (5, 1, [1.0, 0.0]), (6, None, [1.0, 0.0]), (7, 0, None), (8, 0, []), (9, 0, [0.0, 0.0]), (10, 0, [-0.0, 1.0]),
    (11, 0, [0.0, 1.0]), (12, 0, [float("nan"), 1.0]), (13, 0, [float("inf"), 1.0]), (14, 0, [None, 1.0]),
    (None, 0, [1.0, 0.0]), (15, 0, [1.0, 0.0, 0.0]), (16, 0, [3e38, 3e38]), (17, 0, [1e-40, 1e-40]),
    (2, 1, [0.0, 1.0]), (20, 1, [0.0, 1.0]),
]


def test_odd_rows(spark):
    check(spark, ODD)


@pytest.mark.parametrize("tile", [8192, 16, 3])
def test_groups_and_noise(spark, monkeypatch, tile):
    monkeypatch.setattr(range_join, "TILE", tile)
    monkeypatch.setattr(range_join, "PER_PIVOT", 20)
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        for _ in range(4):
            centre = rng.normal(size=8)
            rows += [(label, centre + rng.normal(size=8) * s) for s in rng.choice([0.02, 0.3, 0.45], 18)]
        rows += [(label, v) for v in rng.normal(size=(30, 8))]
        rows += [(label, rows[-1][1])] * 5
    order = rng.permutation(len(rows))
    check(spark, [(int(i), label, [float(x) for x in v]) for i, (label, v) in zip(order, rows, strict=True)])


def test_every_pair_in_range_meets_once():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    reach = math.sqrt(0.14)
    row, cell, home = cells_of(x, x[:7], reach)
    lives = dict(zip(row[home], cell[home], strict=True))
    there = set(zip(row.tolist(), cell.tolist(), strict=True))
    for i in range(300):
        for j in range(i):
            if np.linalg.norm(x[i] - x[j]) <= reach:
                places = ((i, lives[j]) in there) + ((j, lives[i]) in there)
                assert places == (2 if lives[i] == lives[j] else 1)
    assert len(there) < 300 * 4  # boundaries are copied, not everything


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert near_vectors(df).collect() == []
