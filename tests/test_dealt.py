"""Product sales of a table that is larger than the session's partitions can hold."""

from __future__ import annotations

import pytest

from tidefunnel.operators import combine
from tidefunnel.plans.commerce import product_performance_daily, product_performance_summary
from tidefunnel.sources.warehouse import Warehouse


@pytest.mark.parametrize("plan", [product_performance_daily, product_performance_summary])
def test_tasks_follow_the_rows(spark, monkeypatch, plan):
    wh = Warehouse.from_fixture(spark, "/root/testdata/sf0.001")
    usual = sorted(map(repr, plan(wh).collect()))
    rows = wh.table("shopify_order_line_items").count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) + 9
    monkeypatch.setattr(combine, "ROWS", -(-rows // parts))
    more = plan(wh)
    text = more._jdf.queryExecution().optimizedPlan().toString()
    found = -(-rows // combine.ROWS)
    for by in ("order_id", "slice"):  # no such step before: tasks were as many as the session's partitions
        assert any(f", {found}" in line and by in line for line in text.splitlines() if "RepartitionByExpression" in line)
    assert sorted(map(repr, more.collect())) == usual and usual
