"""Every metric on hand-made tables against its literal SQL."""

from __future__ import annotations

import importlib
import os

import pytest
from compare import assert_same
from handmade import build, make_rows

from tidefunnel.oracles import AREAS
from tidefunnel.oracles.sqltext import AS_OF
from tidefunnel.registry import load_all

# These read the raw documents or count the columns of the fixture mapping.
# The identity batch of the registered query presumes a profile per customer.
RAW = {
    "merge_customer_identity",
    "select_unread_batch", "normalize_messages", "reply_address", "compose_reply",
    "stream_ingest_messages", "stream_daily_event_counts", "load_sources", "table_column_counts",
}
BODIES = {
    key: body
    for area in AREAS
    for key, body in importlib.import_module(f"tidefunnel.oracles.{area}").SQL.items()
    if key not in RAW
}


SEEDS = [int(s) for s in os.environ.get("EDGE_SEEDS", "11").split(",")]


@pytest.fixture(scope="module", params=SEEDS)
def tables(request, spark):
    return build(spark, make_rows(request.param))


@pytest.mark.parametrize("key", sorted(BODIES))
def test_matches_literal_sql(tables, key):
    warehouse, con = tables
    assert_same(load_all()[key](warehouse), con, BODIES[key].replace(":as_of", AS_OF))
