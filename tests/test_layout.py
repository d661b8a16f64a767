"""Tables laid out by date and customer: same rows, fewer folders, no shuffle of joins."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from handmade import build, make_rows
from pyspark.sql import functions as F

from tidefunnel.plans import acquisition, commerce, consideration
from tidefunnel.session import work_folder
from tidefunnel.sources import layout
from tidefunnel.sources.layout import lay_out, open_layout
from tidefunnel.sources.warehouse import Warehouse

D = dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def plain(spark):
    """200 customers of some orders each, 20 days of events, rows without customer or date."""
    people = spark.range(200).select(
        "id", F.lit("e").alias("email"), F.lit(2).alias("total_orders"), F.lit(1).cast("decimal(12,2)").alias("total_revenue"),
        F.lit(1).cast("decimal(12,2)").alias("average_order_value"), F.lit(D(2024, 1, 1)).alias("last_order_date"),
        F.lit(D(2023, 1, 1)).alias("first_order_date"),
    )
    n = F.col("id")
    orders = spark.range(1500).select(
        "id", (n % 211).alias("customer_id"), F.expr("timestamp_ntz'2023-11-03 00:00:00' + make_dt_interval(int(id % 90))").alias("order_date"),
        F.when(n % 3 == 0, "refunded").otherwise("paid").alias("financial_status"), (n % 7).cast("decimal(12,2)").alias("total_price"),
    )
    events = spark.range(3000).select(
        "id", F.when(n % 50 != 0, n % 211).alias("customer_id"), F.concat(F.lit("s"), n % 400).alias("session_id"),
        F.when(n % 2 == 0, "product_viewed").when(n % 5 == 0, "add_to_cart").otherwise("page_viewed").alias("event_type"),
        F.when(n % 40 != 0, F.expr("timestamp_ntz'2024-01-05 23:59:59.999999' + make_dt_interval(int(id % 20), int(id % 3))")).alias("occurred_at"),
    )
    ads = spark.range(500).select(
        "id", (n % 211).alias("customer_id"), F.lit("p").alias("platform"), F.expr("date_add(date'2024-01-01', int(id % 25))").alias("date"),
    )
    frames = {"customers": people, "shopify_orders": orders, "shopify_events": events, "klaviyo_events": events.limit(0), "ad_events": ads}
    return Warehouse.from_frames(spark, frames, D(2024, 1, 30))


@pytest.fixture(scope="module")
def laid(spark, plain):
    root = work_folder(spark, "layout-test")
    lay_out(plain, root, 4)
    return root, open_layout(plain, root)


def test_tables_keep_rows_and_columns(plain, laid):
    for name in plain.names:
        assert laid[1].table(name).columns == plain.table(name).columns
        assert rows(laid[1].table(name)) == rows(plain.table(name)), name


@pytest.mark.parametrize("start,end", [(D(2024, 1, 10), D(2024, 1, 12)), (None, D(2024, 1, 6)), (D(2024, 1, 24), None), (None, None), (D(2025, 1, 1), None)])
def test_ranges_equal_the_plain_tables(plain, laid, start, end):
    for name, moment in [("shopify_events", "occurred_at"), ("ad_events", "date"), ("shopify_orders", "order_date")]:
        assert rows(laid[1].between(name, moment, start, end)) == rows(plain.between(name, moment, start, end))
    assert rows(consideration.add_to_cart_rate(laid[1], start, end)) == rows(consideration.add_to_cart_rate(plain, start, end))


def test_a_range_opens_its_folders_only(laid):
    few = laid[1].between("shopify_events", "occurred_at", D(2024, 1, 10), D(2024, 1, 11))
    assert {re.search(r"_part=([\d-]+)", f).group(1) for f in few.inputFiles()} == {"2024-01-10", "2024-01-11"}
    # the middle of a month opens that month
    month = laid[1].between("shopify_orders", "order_date", D(2023, 12, 15), D(2023, 12, 20))
    assert {re.search(r"_part=([\d-]+)", f).group(1) for f in month.inputFiles()} == {"2023-12-01"}
    rate = plan_of(consideration.add_to_cart_rate(laid[1], D(2024, 1, 10), D(2024, 1, 11)))
    assert re.search(r"PartitionFilters: \[[^\]]*_part", rate)
    assert re.search(r"PartitionFilters: \[[^\]]*_part", plan_of(acquisition.ads(laid[1], None, D(2024, 1, 10), None)))


def test_customer_joins_move_nothing(spark, plain, laid):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = commerce.customer_lifetime_metrics(laid[1])
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert "Exchange" in plan_of(commerce.customer_lifetime_metrics(plain))
        assert "Exchange" not in plan_of(commerce.aov(laid[1]))
        assert rows(joined) == rows(commerce.customer_lifetime_metrics(plain))
        assert rows(commerce.aov(laid[1])) == rows(commerce.aov(plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_another_session_reads_the_layout(spark, plain, laid):
    root, first = laid
    want = {name: rows(first.table(name)) for name in ("shopify_events", "customers")}
    for name in layout.LAYOUTS:
        spark.sql(f"DROP TABLE {layout._catalog_name(root, name)}")  # files of a table with a path stay
    again = open_layout(plain, root)
    assert {name: rows(again.table(name)) for name in want} == want
    few = again.between("shopify_events", "occurred_at", D(2024, 1, 10), D(2024, 1, 11))
    assert {re.search(r"_part=([\d-]+)", f).group(1) for f in few.inputFiles()} == {"2024-01-10", "2024-01-11"}


def test_a_hot_customer_is_not_cut_into_buckets(spark, plain):
    hot = plain.table("shopify_orders").withColumn("customer_id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    frames = {name: plain.table(name) for name in plain.names} | {"shopify_orders": hot}
    wh = Warehouse.from_frames(spark, frames, plain.as_of)
    root = work_folder(spark, "layout-hot")
    lay_out(wh, root, 16)
    listed = {r["name"]: r.buckets for r in spark.read.parquet(f"{root}/layout").collect()}
    assert listed["shopify_orders"] == 0 and listed["customers"] == 16
    assert rows(open_layout(wh, root).table("shopify_orders")) == rows(hot)


def test_hand_made_tables(spark):
    wh, _ = build(spark, make_rows(11))
    root = work_folder(spark, "layout-edges")
    lay_out(wh, root, 4)
    laid = open_layout(wh, root)
    for metric in (commerce.customer_lifetime_metrics, commerce.aov, consideration.cart_abandonment_rate, acquisition.ctr):
        assert rows(metric(laid)) == rows(metric(wh)), metric.__name__


def test_an_unfinished_layout_is_refused(spark, plain):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        open_layout(plain, work_folder(spark, "layout-none"))
