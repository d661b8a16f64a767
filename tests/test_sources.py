"""The declared schemas: string ids and time-zone timestamps give the same metrics."""

from __future__ import annotations

import pytest
from compare import spark_rows
from handmade import SCHEMAS, build, make_rows

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidefunnel.registry import load_all
from tidefunnel.session import work_folder
from tidefunnel.sources.schemas import ENTITY_SCHEMAS
from tidefunnel.sources.warehouse import FIXTURE_AS_OF, Warehouse

# one or more of each family: fan-out weights, sessions, ranges, calendars, windows, rankings
KEYS = [
    "cac", "cost_per_signup", "acquisition_metrics_daily", "traffic_source_metrics_daily",
    "consideration_metrics_daily", "repeat_visit_rate_7d", "retention_metrics_daily",
    "customer_retention_cohorts_summary", "advocacy_metrics_daily", "post_purchase_email_ctr",
    "multi_touch_position", "multi_touch_time_decay", "channel_revenue_attribution",
    "customer_metric_card", "customer_journey", "abandoned_cart_recovery_rate", "dq_foreign_keys",
    "dq_event_timestamps", "funnel_stage_counts", "reply_usage_stats",
]


@pytest.fixture(scope="module")
def both(spark):
    fixture, _ = build(spark, make_rows(21))
    root = work_folder(spark, "entities")
    for name, ddl in ENTITY_SCHEMAS.items():
        declared = StructType.fromDDL(ddl)
        have = fixture.table(name).columns if name in SCHEMAS else []
        rows = fixture.table(name) if have else spark.range(0)
        rows.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in declared
            ]
        ).write.parquet(f"{root}/{name}")
    return fixture, Warehouse.from_tables(spark, root, FIXTURE_AS_OF)


def test_declared_types(both):
    _, typed = both
    for name, ddl in ENTITY_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in typed.table(name).schema] == [
            (f.name, f.dataType) for f in StructType.fromDDL(ddl)
        ]


@pytest.mark.parametrize("key", KEYS)
def test_same_metrics_from_declared_tables(both, key):
    fixture, typed = both
    plan = load_all()[key]

    def text(df):
        # ids differ in type only
        return spark_rows(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))

    assert text(plan(typed)) == text(plan(fixture))


def test_views(spark, both):
    both[1].register_views("shop_")
    assert spark.sql("select count(*) as n from shop_ad_events").first().n == 150
