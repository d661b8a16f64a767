"""Data-quality checks and the verification samples."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import midnight, money, rounded
from tidefunnel.plans.commerce import (
    campaign_performance_summary,
    customer_lifetime_metrics,
    product_performance_summary,
)
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

# The order states that the data model knows.
ORDER_STATES = ("paid", "pending", "refunded", "voided", "partially_paid", "partially_refunded")

# Fixed values: (table, column, referenced table) of the data model.
FOREIGN_KEYS = (
    ("shopify_orders", "customer_id", "customers"),
    ("shopify_product_variants", "product_id", "shopify_products"),
    ("shopify_order_line_items", "order_id", "shopify_orders"),
    ("shopify_order_line_items", "product_id", "shopify_products"),
    ("shopify_order_line_items", "variant_id", "shopify_product_variants"),
    ("klaviyo_profiles", "customer_id", "customers"),
    ("klaviyo_flow_steps", "flow_id", "klaviyo_flows"),
    ("klaviyo_predictive_metrics", "profile_id", "klaviyo_profiles"),
    ("shopify_events", "customer_id", "customers"),
    ("shopify_events", "product_id", "shopify_products"),
    ("klaviyo_events", "profile_id", "klaviyo_profiles"),
    ("klaviyo_events", "customer_id", "customers"),
    ("klaviyo_events", "campaign_id", "klaviyo_campaigns"),
    ("ad_events", "customer_id", "customers"),
    ("referrals", "referrer_customer_id", "customers"),
    ("referrals", "referred_customer_id", "customers"),
    ("reviews", "customer_id", "customers"),
    ("reviews", "order_id", "shopify_orders"),
    ("ugc_submissions", "customer_id", "customers"),
    ("loyalty_enrollments", "customer_id", "customers"),
    ("nps_surveys", "customer_id", "customers"),
    ("email_embeddings", "email_id", "emails"),
    ("email_replies", "email_id", "emails"),
)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _profile(wh: Warehouse, name: str, with_cells: bool) -> DataFrame:
    df = wh.table(name)
    aggs = [F.count("*").alias("row_count")]
    if with_cells:
        cells = sum((F.count(c) for c in df.columns[1:]), F.count(df.columns[0]))
        aggs.append(cells.alias("filled_cells"))
    return df.agg(*aggs).select(
        F.lit(name).alias("table_name"), "*", F.lit(len(df.columns)).alias("column_count")
    )


def load_sources(wh: Warehouse) -> DataFrame:
    """Every typed source with its rows, columns and filled cells."""
    return _all([_profile(wh, name, True) for name in wh.names])


def table_row_counts(wh: Warehouse) -> DataFrame:
    return _all([_profile(wh, name, False).drop("column_count") for name in wh.names])


def empty_tables(wh: Warehouse) -> DataFrame:
    """Names of tables without a row; each table is read up to its first one."""
    parts = [
        wh.table(name).select(F.lit(1).alias("x")).limit(1).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), "n"
        )
        for name in wh.names
    ]
    return _all(parts).where("n = 0").select("table_name")


def table_column_counts(wh: Warehouse) -> DataFrame:
    return _all([_profile(wh, name, False).drop("row_count") for name in wh.names])


def dq_unique_email(wh: Warehouse) -> DataFrame:
    return (
        wh.table("customers").groupBy("email").agg(F.count("*").alias("copies")).where("copies > 1")
    )


def dq_order_status_enum(wh: Warehouse) -> DataFrame:
    return (
        wh.table("shopify_orders")
        .where(~F.col("financial_status").isin(*ORDER_STATES))
        .groupBy("financial_status")
        .agg(F.count("*").alias("orders"))
    )


def dq_revenue_consistency(wh: Warehouse) -> DataFrame:
    """Orders whose total differs from the sum of their lines."""
    lines = (
        wh.table("shopify_order_line_items")
        .groupBy(F.col("order_id").alias("id"))
        .agg(F.sum("line_total").alias("lines_total"))
    )
    return (
        wh.table("shopify_orders")
        .join(lines, "id", "left")
        .where(F.col("total_price") != F.coalesce("lines_total", F.lit(0)))
        .select(
            F.col("id").alias("order_id"),
            money("total_price").alias("total_price"),
            money("lines_total").alias("lines_total"),
        )
    )


def dq_event_timestamps(wh: Warehouse) -> DataFrame:
    """Events dated after they were stored, per table.

    Tables without a created_at column count as stored at the end of as_of.
    """
    stored = midnight(wh.as_of + dt.timedelta(days=1))

    def check(name: str) -> DataFrame:
        df = wh.table(name)
        limit = F.coalesce(F.col("created_at"), stored) if "created_at" in df.columns else stored
        return df.agg(
            F.count("*").alias("events"), F.count_if(F.col("occurred_at") > limit).alias("too_late")
        ).select(F.lit(name).alias("table_name"), "*")

    return _all([check("shopify_events"), check("klaviyo_events")])


def dq_value_ranges(wh: Warehouse) -> DataFrame:
    def check(name: str, column: str, lo: int, hi: int) -> DataFrame:
        return (
            wh.table(name)
            .agg(
                F.count(column).alias("checked"),
                F.count_if(~F.col(column).between(lo, hi)).alias("out_of_range"),
            )
            .select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "*")
        )

    return _all([check("reviews", "rating", 1, 5), check("nps_surveys", "nps_score", 0, 10)])


def dq_foreign_keys(wh: Warehouse) -> DataFrame:
    """Rows whose reference has no target, per relation.

    References are counted per value first, so a hot value is one row in the
    anti join.
    """

    def check(child: str, column: str, parent: str) -> DataFrame:
        refs = wh.table(child).where(F.col(column).isNotNull()).groupBy(
            F.col(column).alias("id")
        ).agg(F.count("*").alias("n"))
        lost = refs.join(wh.table(parent).select("id"), "id", "left_anti")
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
            F.lit(child).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent).alias("parent"),
            "orphans",
        )

    return _all([check(*fk) for fk in FOREIGN_KEYS])


def top_customers_sample(wh: Warehouse) -> DataFrame:
    return customer_lifetime_metrics(wh).orderBy(F.desc("total_revenue"), "customer_id").limit(5)


def campaign_sample(wh: Warehouse) -> DataFrame:
    return (
        campaign_performance_summary(wh)
        .orderBy("campaign_id")
        .limit(5)
        .select(
            "name",
            "type",
            "recipients_count",
            rounded(F.col("open_rate") * 100, 2).alias("open_rate_pct"),
            rounded(F.col("click_rate") * 100, 2).alias("click_rate_pct"),
            "revenue",
        )
    )


def top_products_sample(wh: Warehouse) -> DataFrame:
    return (
        product_performance_summary(wh)
        .orderBy(F.desc_nulls_first("total_revenue"), "product_id")
        .limit(5)
        .select(
            "title",
            "total_units_sold",
            "total_revenue",
            rounded(F.col("conversion_rate") * 100, 2).alias("conversion_rate_pct"),
        )
    )


for _fn in (
    load_sources, table_row_counts, empty_tables, table_column_counts, dq_unique_email,
    dq_order_status_enum, dq_revenue_consistency, dq_event_timestamps, dq_value_ranges,
    dq_foreign_keys, top_customers_sample, campaign_sample, top_products_sample,
):
    register(_fn.__name__, _fn)
