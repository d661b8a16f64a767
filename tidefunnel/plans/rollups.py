"""Written rollup tables: refresh of single days, full rebuilds and backfills.

A refresh is always one job for all its days.  Facts are read once; the days
are partitions of the written table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from tidefunnel.functions.exprs import in_dates
from tidefunnel.operators.calendar import days_between, session_days, source_range
from tidefunnel.operators.tables import read_table, replace_all, replace_days, staged
from tidefunnel.plans.acquisition import acquisition_metrics_daily, traffic_source_metrics_daily
from tidefunnel.plans.advocacy import (
    advocacy_metrics_daily,
    day_changes,
    ledger,
    refresh_advocacy,
    standing,
)
from tidefunnel.plans.commerce import (
    campaign_performance_daily,
    customer_metrics_daily,
    product_performance_daily,
)
from tidefunnel.plans.consideration import consideration_metrics_daily, session_engagement_daily
from tidefunnel.plans.retention import (
    customer_retention_cohorts,
    default_calendar,
    retention_metrics_daily,
)
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse


def _on_calendar(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def build(wh: Warehouse, start: dt.date, end: dt.date) -> DataFrame:
        return fn(wh, calendar=days_between(wh.spark, start, end))

    return build


def _days_of(fn: Callable[[Warehouse], DataFrame]) -> Callable[..., DataFrame]:
    """Tables that are one projection: their rows of the days."""

    def build(wh: Warehouse, start: dt.date, end: dt.date) -> DataFrame:
        return fn(wh).where(in_dates("date", start, end))

    return build


def _consideration(wh: Warehouse, start: dt.date, end: dt.date) -> DataFrame:
    return consideration_metrics_daily(wh, start, end, days_between(wh.spark, start, end))


DAILY: dict[str, Callable[[Warehouse, dt.date, dt.date], DataFrame]] = {
    "acquisition_metrics_daily": lambda wh, s, e: acquisition_metrics_daily(wh, s, e),
    "traffic_source_metrics_daily": lambda wh, s, e: traffic_source_metrics_daily(wh, s, e),
    "consideration_metrics_daily": _consideration,
    "session_engagement_daily": lambda wh, s, e: session_engagement_daily(wh, s, e),
    "retention_metrics_daily": _on_calendar(retention_metrics_daily),
    "advocacy_metrics_daily": _on_calendar(advocacy_metrics_daily),
    "customer_metrics_daily": lambda wh, s, e: customer_metrics_daily(wh, s, e),
    "campaign_performance_daily": _days_of(campaign_performance_daily),
    "product_performance_daily": lambda wh, s, e: product_performance_daily(wh, s, e),
}

# One row per day of a calendar, which may have gaps.
ON_CALENDAR: dict[str, Callable[..., DataFrame]] = {
    "consideration_metrics_daily": consideration_metrics_daily,
    "retention_metrics_daily": retention_metrics_daily,
    "advocacy_metrics_daily": advocacy_metrics_daily,
}


def refresh_days(wh: Warehouse, table: str, root: str, start: dt.date, end: dt.date) -> DataFrame:
    """Recompute the days in [start, end] of a daily table; returns the whole table."""
    rows = DAILY[table](wh, start, end)
    path = f"{root}/{table}"
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    replace_days(rows, path, days)
    return read_table(wh.spark, path, rows)


def refresh_day(wh: Warehouse, table: str, root: str, day: dt.date | None = None) -> DataFrame:
    day = day or wh.as_of
    return refresh_days(wh, table, root, day, day)


def refresh_calendar(wh: Warehouse, table: str, root: str, calendar: DataFrame) -> DataFrame:
    """Recompute the days of ``calendar`` (date) in one job; returns the whole table.

    The driver lists the days, at most one per day of history.
    """
    days = sorted(r["date"] for r in calendar.distinct().collect())
    if table in ON_CALENDAR:
        rows = ON_CALENDAR[table](wh, calendar=calendar)
    else:
        first, last = (days[0], days[-1]) if days else (wh.as_of, wh.as_of)
        whole = DAILY[table](wh, first, last)
        rows = whole.join(calendar, "date", "left_semi").select(*whole.columns)
    path = f"{root}/{table}"
    replace_days(rows, path, days)
    return read_table(wh.spark, path, rows)


def rebuild_cohorts(wh: Warehouse, root: str) -> DataFrame:
    rows = customer_retention_cohorts(wh)
    path = f"{root}/customer_retention_cohorts"
    replace_all(rows, path)
    return read_table(wh.spark, path, rows)


# --- registered queries --------------------------------------------------------------


def replace_day(wh: Warehouse) -> DataFrame:
    """Write the daily acquisition table, refresh its last day again, read it back."""
    root = work_folder(wh.spark, "replace-day")
    rows = acquisition_metrics_daily(wh)
    replace_days(rows, f"{root}/acquisition_metrics_daily")
    return refresh_day(wh, "acquisition_metrics_daily", root)


def refresh_advocacy_days(wh: Warehouse) -> DataFrame:
    """Store history up to three days ago, then extend the advocacy rollup day by day."""
    root = work_folder(wh.spark, "advocacy-days")
    days, path = ledger(wh, f"{root}/ledger"), f"{root}/advocacy_metrics_daily"
    now = staged(standing(wh), "customers-now")
    past = wh.as_of - dt.timedelta(days=3)
    days.begin(*day_changes(wh, None, past), past)
    for ago in (2, 1, 0):
        day = wh.as_of - dt.timedelta(days=ago)
        rows = refresh_advocacy(wh, days, day, day, every=1, now=now)
        replace_days(rows, path, [day])
    return read_table(wh.spark, path, rows)


def replace_all_cohorts(wh: Warehouse) -> DataFrame:
    root = work_folder(wh.spark, "cohorts")
    rebuild_cohorts(wh, root)
    return rebuild_cohorts(wh, root)


def _backfill(table: str, calendar: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """A job that writes ``table`` on the days of a calendar and reads it back."""

    def run(wh: Warehouse) -> DataFrame:
        return refresh_calendar(wh, table, work_folder(wh.spark, "backfill"), calendar(wh))

    return run


def _ad_days(wh: Warehouse) -> DataFrame:
    return source_range(wh.table("ad_events"), "date")


def _event_days(wh: Warehouse) -> DataFrame:
    return source_range(wh.table("shopify_events"), "occurred_at")


def _last_7_days(table: str) -> Callable[[Warehouse], DataFrame]:
    """The usual repair: the seven days before ``as_of``."""

    def run(wh: Warehouse) -> DataFrame:
        first, last = wh.as_of - dt.timedelta(days=7), wh.as_of - dt.timedelta(days=1)
        return refresh_days(wh, table, work_folder(wh.spark, "backfill"), first, last)

    return run


def backfill_sampled_dates(wh: Warehouse) -> DataFrame:
    return default_calendar(wh)


def backfill_session_dates(wh: Warehouse) -> DataFrame:
    return session_days(wh.table("shopify_events"), wh.as_of)


for _key, _fn in {
    "replace_day": replace_day,
    "refresh_advocacy_days": refresh_advocacy_days,
    "replace_all_cohorts": replace_all_cohorts,
    "backfill_range": _backfill("consideration_metrics_daily", _event_days),
    "backfill_acquisition": _backfill("acquisition_metrics_daily", _ad_days),
    "backfill_traffic": _backfill("traffic_source_metrics_daily", _ad_days),
    "backfill_retention": _backfill("retention_metrics_daily", backfill_sampled_dates),
    "backfill_advocacy": _backfill("advocacy_metrics_daily", backfill_sampled_dates),
    "backfill_sessions": _backfill("session_engagement_daily", backfill_session_dates),
    "backfill_last_7_days": _last_7_days("traffic_source_metrics_daily"),
    "backfill_last_7_days_ads": _last_7_days("acquisition_metrics_daily"),
    "backfill_sampled_dates": backfill_sampled_dates,
    "backfill_session_dates": backfill_session_dates,
}.items():
    register(_key, _fn)
