from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefunnel.operators import vectors
from tidefunnel.operators.cells import VectorIndex
from tidefunnel.operators.vectors import nearest, nearest_tiled
from tidefunnel.session import work_folder


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(3)
    points = r.normal(size=(400, 8)) + 3 * r.integers(0, 4, size=(400, 1))
    points = points.astype(np.float32)
    points[7] = points[3]  # a tie, settled by the id
    corpus = spark.createDataFrame(
        [(i, [float(x) for x in p]) for i, p in enumerate(points)], "email_id long, embedding array<float>"
    ).repartition(5)
    questions = spark.createDataFrame(
        [(f"q{i}", [float(x) for x in points[i]]) for i in (3, 50, 399)],
        "question_id string, embedding array<float>",
    )
    return points.astype(np.float64), corpus, questions


def brute(points, i, k):
    l2 = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
    order = sorted(range(len(points)), key=lambda j: (l2[j], j))[:k]
    cos = points @ points[i] / (np.linalg.norm(points, axis=1) * np.linalg.norm(points[i]))
    return [(j, pytest.approx(cos[j])) for j in order]


def answers(df):
    out: dict = {}
    for r in df.orderBy("question_id", "rank").collect():
        out.setdefault(r.question_id, []).append((r.email_id, r.similarity))
    return out


def test_nearest_equals_brute_force(data):
    points, corpus, questions = data
    got = answers(nearest(corpus, questions, 6))
    assert got == {f"q{i}": brute(points, i, 6) for i in (3, 50, 399)}
    assert [j for j, _ in got["q3"][:2]] == [3, 7]


@pytest.mark.parametrize("tile_bytes,stripe", [(32 << 20, 1 << 21), (1000, 64), (32, 1)])
def test_tiles_equal_brute_force(data, monkeypatch, tile_bytes, stripe):
    points, corpus, questions = data
    monkeypatch.setattr(vectors, "TILE_BYTES", tile_bytes)
    monkeypatch.setattr(vectors, "STRIPE", stripe)
    want = {f"q{i}": brute(points, i, 4) for i in (3, 50, 399)}
    assert answers(nearest_tiled(corpus, questions, 4)) == want
    monkeypatch.setattr(vectors, "BLOCK", 2)
    assert answers(nearest(corpus, questions, 4)) == want


def test_tiles_keep_all_vectors_from_the_driver(data, monkeypatch):
    points, corpus, questions = data

    def refuse(*_):
        raise AssertionError("vectors reach the driver")

    for name in ("collect", "toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(corpus), name, refuse)
    plan = nearest_tiled(corpus, questions, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_k_beyond_the_corpus_and_no_questions(data):
    _, corpus, questions = data
    assert nearest(corpus.where("email_id < 3"), questions, 9).count() == 9
    assert nearest(corpus, questions.where("false"), 5).count() == 0


def test_only_k_rows_per_partition_are_shuffled(data):
    _, corpus, questions = data
    plan = nearest(corpus, questions, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def files(index):
    return {r.f: r.n for r in index.table().groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()}


def test_index_is_built_once_and_reused(spark, data, monkeypatch):
    points, corpus, questions = data
    root = work_folder(spark, "index")
    VectorIndex.create(corpus, root, 6).add(corpus)
    index = VectorIndex.open(spark, root)
    assert index.table().count() == 400
    exact = answers(nearest(corpus, questions, 5))
    assert answers(index.search(questions, 5, probes=6)) == exact
    few = index.search(questions, 5, probes=1)
    found = answers(few)
    for q, hits in found.items():  # what is found has its true cosine and comes in order
        assert dict(hits).items() <= dict(answers(nearest(corpus, questions, 400))[q]).items()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    monkeypatch.setattr(vectors, "BLOCK", 1)  # many questions give the same answers
    assert answers(index.search(questions, 5, probes=1)) == found
    assert answers(index.search(questions, 5, probes=6)) == exact


def test_index_takes_new_and_changed_vectors(spark, data):
    points, corpus, _ = data
    root = work_folder(spark, "index")
    index = VectorIndex.create(corpus, root, 5)
    assert index.add(corpus.where("email_id < 300")) == []
    before = files(index)
    assert index.add(corpus.where("email_id >= 200")) == []  # some are stored already
    after = files(index)
    assert index.table().count() == 400 and before.items() <= after.items()  # only appended
    assert index.add(corpus) == [] and files(index) == after  # nothing new, nothing written
    moved = spark.createDataFrame([(7, [float(-x) for x in points[7]]), (500, [1.0] * 8), (None, [1.0] * 8), (501, [1.0])], "email_id long, embedding array<float>")
    cells = index.add(moved)
    old = {r.email_id: r.cell for r in index.placed(corpus.where("email_id = 7")).collect()}[7]
    now = {r.email_id: r.cell for r in index.table().where("email_id in (7, 500)").collect()}
    assert set(cells) == {old, now[7]} and len(now) == 2 and index.table().count() == 401
    same = {f: n for f, n in after.items() if int(f.split("cell=")[1].split("/")[0]) not in cells}
    assert same.items() <= files(index).items()
    placed = {r.email_id: r.cell for r in index.table().collect()}
    assert placed == {r.email_id: r.cell for r in index.placed(index.table().select("email_id", "embedding")).collect()}


def test_vectors_that_are_no_vectors(spark):
    """NULL, NaN and short vectors are left out and push nothing else out."""
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [nan, nan]), (4, [nan, 1.0]), (5, None), (6, [1.0]), (7, [nan, 0.0])]
    corpus = spark.createDataFrame(rows, "email_id long, embedding array<float>").coalesce(1)
    questions = spark.createDataFrame([(9, [1.0, 0.0])], "question_id long, embedding array<float>")
    got = nearest(corpus, questions, 3).orderBy("rank").collect()
    assert [r.email_id for r in got] == [1, 2]
