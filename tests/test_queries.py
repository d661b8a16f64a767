"""The driver contract, on the smallest given tables."""

from __future__ import annotations

import glob
import os
import re

import duckdb
import pytest
from compare import assert_same

import __spark_entry__ as entry_module
from test_edges import RAW
from tidefunnel.registry import load_all

SMALL = "/root/testdata/sf0.001"
# written tables and streams are prepared by running jobs; they have no single plan
EAGER = {
    "replace_day", "replace_all_cohorts", "backfill_last_7_days", "stream_ingest_messages",
    "stream_daily_event_counts", "similarity_search_ann", "backfill_range", "backfill_acquisition",
    "backfill_traffic", "backfill_retention", "backfill_advocacy", "backfill_sessions",
    "backfill_last_7_days_ads",
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def test_every_check_has_a_query():
    queries, checks = entry_module.queries(), entry_module.oracle_sql()
    assert set(checks) <= set(queries)
    assert set(load_all()) - set(checks) == {"similarity_search_ann"}


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize(
    "key", sorted(RAW | {"cac_by_platform", "acquisition_metrics_daily", "cohort_retention_matrix"})
)
def test_fixture_query_matches_sql(spark, con, key):
    assert_same(entry_module.queries()[key](spark, SMALL), con, entry_module.oracle_sql()[key])


def test_approximate_search_runs(spark):
    rows = entry_module.queries()["similarity_search_ann"](spark, SMALL).collect()
    # every stored question finds itself first
    assert all(r.question_id == r.email_id for r in rows if r["rank"] == 1)


def test_no_plan_multiplies_tables(spark):
    queries = entry_module.queries()
    for key in sorted(set(load_all()) - EAGER):
        plan = queries[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan), key


def test_scans_are_pruned_and_filtered(spark):
    plan = entry_module.queries()["cac"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    columns = {c.split(":")[0] for c in schema.split(",")}
    assert columns <= {"event_id", "ts", "user_id", "event_type", "value"}
    orders = entry_module.queries()["revenue_last_30_days"](spark, SMALL)
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "o_orderstatus" in plan
