"""Stored days and checkpoints against the full rebuild."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from compare import spark_rows
from handmade import build, make_rows
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import day
from tidefunnel.operators.calendar import days_between
from tidefunnel.plans.advocacy import (
    advocacy_from_ledger,
    advocacy_metrics_daily,
    day_changes,
    ledger,
    refresh_advocacy,
)
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse

DATED = {
    "ugc_submissions": "created_at", "reviews": "created_at", "referrals": "created_at",
    "nps_surveys": "survey_date", "shopify_orders": "order_date", "klaviyo_events": "occurred_at",
}


@pytest.fixture(scope="module")
def shop(spark):
    return build(spark, make_rows(5))[0]


def full(wh, start, end):
    return spark_rows(advocacy_metrics_daily(wh, days_between(wh.spark, start, end)))


def without(wh, keep):
    """The same shop without the dated rows for which ``keep(day)`` is false."""
    frames = {name: wh.table(name) for name in wh.names}
    for name, when in DATED.items():
        frames[name] = frames[name].where(keep(day(when)))
    return Warehouse.from_frames(wh.spark, frames, wh.as_of)


def test_days_extend_the_checkpoint(shop, spark):
    first = shop.as_of - dt.timedelta(days=6)
    days = ledger(shop, work_folder(spark, "ledger"))
    days.begin(*day_changes(shop, None, first), first)
    for ago in range(5, -1, -1):
        d = shop.as_of - dt.timedelta(days=ago)
        rows = refresh_advocacy(shop, days, d, d, every=3)
        assert spark_rows(rows) == full(shop, d, d)
    assert days.checkpoints() == [first, first + dt.timedelta(days=3)]
    d = shop.as_of
    assert spark_rows(refresh_advocacy(shop, days, d, d)) == full(shop, d, d)  # a second run changes nothing
    plan = advocacy_from_ledger(shop, days, d, d)._jdf.queryExecution().analyzed().toString()
    assert not any(c in plan for c in ("financial_status", "occurred_at", "nps_score", "referral_status"))
    with pytest.raises(ValueError):
        refresh_advocacy(shop, days, first, first)


def test_late_rows_move_the_days_behind_them(shop, spark):
    first, late = shop.as_of - dt.timedelta(days=14), shop.as_of - dt.timedelta(days=12)
    early = without(shop, lambda d: d != F.lit(late))
    days = ledger(early, work_folder(spark, "ledger"))
    days.begin(*day_changes(early, None, first), first)
    after = first + dt.timedelta(days=1)
    rows = refresh_advocacy(early, days, after, shop.as_of)
    assert spark_rows(rows) == full(early, after, shop.as_of)
    days.checkpoint(shop.as_of - dt.timedelta(days=1))
    rows = refresh_advocacy(shop, days, late, late)
    assert spark_rows(rows) == full(shop, late, shop.as_of) != full(early, late, shop.as_of)
    assert days.checkpoints() == [first]


def test_only_named_days_are_opened(shop, spark):
    first = shop.as_of - dt.timedelta(days=4)
    days = ledger(shop, work_folder(spark, "ledger"))
    days.begin(*day_changes(shop, None, first), first)
    start = first + dt.timedelta(days=1)
    days.record(*day_changes(shop, start, shop.as_of), start, shop.as_of)
    days.checkpoint(first + dt.timedelta(days=2))
    facts, people = days.changes(shop.as_of, shop.as_of)
    opened = {os.path.basename(os.path.dirname(f)) for f in facts.inputFiles() + people.inputFiles()}
    allowed = {f"upto={first + dt.timedelta(days=2)}", *[f"date={first + dt.timedelta(days=i)}" for i in (3, 4)]}
    assert opened and opened <= allowed


def test_empty_shop(shop, spark):
    bare = without(shop, lambda d: F.lit(False))
    first, d = shop.as_of - dt.timedelta(days=1), shop.as_of
    days = ledger(bare, work_folder(spark, "ledger"))
    days.begin(*day_changes(bare, None, first), first)
    assert spark_rows(refresh_advocacy(bare, days, d, d)) == full(bare, d, d)
