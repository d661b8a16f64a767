"""Raking by windows and by joins, and the size of its plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidefunnel.llm import mixing


def some_cells(spark):
    rows = [(f"s{i % 7}", f"l{i % 3}", f"t{i % 2}", 10 + i * 13 % 97) for i in range(42)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    return cells.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("n_tokens"))


def by_cell(raked):
    return {(r.source, r.lang, r.topic): r.weight for r in raked.collect()}


def test_windows_and_joins_agree(spark, monkeypatch):
    cells = some_cells(spark)
    # a value without a target weighs nothing, in every round
    targets = {"lang": spark.createDataFrame([("l0", 0.5), ("l1", 0.5)], "lang string, share double")}
    few = by_cell(mixing.rake(cells, targets, rounds=3))
    monkeypatch.setattr(mixing, "CELLS", 0)
    many = by_cell(mixing.rake(cells, targets, rounds=3))
    assert few.keys() == many.keys() and len(few) == 42
    assert all(few[k] == pytest.approx(many[k]) for k in few)
    assert all((w == 0) == (k[1] == "l2") for k, w in few.items())


def test_a_round_is_a_small_plan(spark, monkeypatch):
    plans = []

    def seen(df, purpose):
        if purpose == "raked":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(df, purpose)

    staged = mixing.staged
    monkeypatch.setattr(mixing, "staged", seen)
    for cells in (1_000_000, 0):
        monkeypatch.setattr(mixing, "CELLS", cells)
        mixing.rake(some_cells(spark), rounds=2)
    # it was read eight times before
    assert len(plans) == 2 + 6 and max(p.count("Relation") for p in plans) <= 2
