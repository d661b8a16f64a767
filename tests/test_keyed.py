from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from tidefunnel.operators import keyed
from tidefunnel.operators.keyed import KeyedTable
from tidefunnel.operators.merge import keyed_merge
from tidefunnel.session import work_folder

TABLE = "k string, x int, s string, at int"
BATCH = "k string, x long, s string, seq int"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def files(root):
    return {f for f in glob.glob(f"{root}/data/*/bucket=*/*.parquet")}


@pytest.fixture
def table(spark):
    content = spark.createDataFrame([(f"k{i}", i, "old", 0) for i in range(200)] + [(None, -1, "old", 0)], TABLE)
    root = work_folder(spark, "keyed")
    KeyedTable.create(content, root, ["k"], 16)
    return KeyedTable.open(spark, root), content


def test_merge_equals_a_full_merge_and_leaves_other_buckets(spark, table):
    stored, content = table
    before = files(stored.root)
    batch = spark.createDataFrame(
        [("k3", 9, "a", 2), ("k3", 8, "b", 1), ("new", 7, "c", 1), ("new", 6, "d", 2), (None, 5, "e", 1)], BATCH
    )
    touched = stored.merge(batch, ["s"], ["seq"], ("at", F.lit(7)))
    want = keyed_merge(content, batch.withColumn("x", F.col("x").cast("int")), ["k"], ["s"], ["seq"], ("at", F.lit(7)))
    assert rows(KeyedTable.open(spark, stored.root).read()) == rows(want)
    assert 0 < len(touched) <= 3
    live = stored.versions()
    assert {b for b, v in live.items() if v == 1} == set(touched)
    assert before <= files(stored.root)  # nothing is written over
    old = {f for f in stored.read([b for b in live if b not in touched]).inputFiles()}
    assert old and all("version=0" in f for f in old)
    stored.vacuum()
    assert all(f"bucket={b}/" not in f for f in files(stored.root) - (files(stored.root) - before) for b in touched)
    assert rows(stored.read()) == rows(want)


def test_merge_reads_touched_buckets_only(spark, table, monkeypatch):
    stored, _ = table
    seen = []
    plain = keyed.keyed_merge
    monkeypatch.setattr(keyed, "keyed_merge", lambda target, *a: seen.extend(target.inputFiles()) or plain(target, *a))
    touched = stored.merge(spark.createDataFrame([("k5", 1, "z", 1)], BATCH), ["s"], ["seq"])
    assert len(touched) == 1 and seen and all(f"bucket={touched[0]}/" in f for f in seen)
    found = stored.lookup(spark.createDataFrame([("k5",), ("nobody",)], "k string"))
    assert rows(found, "k", "s") == [("k5", "z")]
    assert stored.merge(spark.createDataFrame([], BATCH), ["s"], ["seq"]) == []


def test_changes(spark, table):
    stored, _ = table
    stored.merge(spark.createDataFrame([("k1", 1, "a", 1), ("n", 2, "b", 1)], BATCH), ["s"], ["seq"])
    stored.merge(spark.createDataFrame([("n", 3, "c", 1), ("k1", 3, "d", 1)], BATCH), ["s"], ["seq"])
    got = rows(stored.changes(0), "version", "change", "k", "x", "s")
    assert got == [(1, "insert", "n", 2, "b"), (1, "update", "k1", 1, "a"), (2, "update", "k1", 1, "d"), (2, "update", "n", 2, "c")]
    assert rows(stored.changes(1), "k") == [("k1",), ("n",)] and stored.changes(2).count() == 0


def test_a_lost_run_changes_nothing(spark, table, monkeypatch):
    """A run that ends between data and commit leaves the table as it was; the next one goes on."""
    stored, content = table
    batch = spark.createDataFrame([("k1", 1, "a", 1), ("n", 2, "b", 1)], BATCH)
    plain = keyed.folder_exists

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(keyed, "folder_exists", lost)
    with pytest.raises(RuntimeError):
        stored.merge(batch, ["s"], ["seq"])
    monkeypatch.setattr(keyed, "folder_exists", plain)
    assert rows(stored.read()) == rows(content) and stored.changes(0).count() == 0
    stored.merge(batch, ["s"], ["seq"])
    assert stored.read().count() == 202 and stored.last_version() == 1


def test_many_batches_equal_full_merges(spark):
    r = random.Random(3)
    content = spark.createDataFrame([(f"k{i}", i, "old", 0) for i in range(30)], TABLE)
    stored = KeyedTable.create(content, work_folder(spark, "keyed"), ["k"], 4)
    whole = content
    for turn in range(3):
        batch = spark.createDataFrame(
            [(f"k{r.randrange(50)}", r.randrange(9), r.choice("abc"), i) for i in range(20)], "k string, x int, s string, seq int"
        )
        stored.merge(batch, ["s"], ["seq"], ("at", F.lit(turn)))
        whole = spark.createDataFrame(keyed_merge(whole, batch, ["k"], ["s"], ["seq"], ("at", F.lit(turn))).collect(), TABLE)
    assert rows(stored.read()) == rows(whole)
