"""Metrics read from tables that are laid out by date and customer."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.plans.commerce import customer_lifetime_metrics
from tidefunnel.plans.consideration import add_to_cart_rate, cart_abandonment_rate
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.layout import LAYOUTS, lay_out, open_layout
from tidefunnel.sources.warehouse import Warehouse

BUCKETS = 8


def _laid_out(wh: Warehouse, *names: str) -> Warehouse:
    root = work_folder(wh.spark, "layout")
    lay_out(wh, root, BUCKETS, {name: LAYOUTS[name] for name in names})
    return open_layout(wh, root)


def laid_out_tables(wh: Warehouse) -> DataFrame:
    """Rows, days and customers of each laid-out table, read back."""
    laid = _laid_out(wh, *LAYOUTS)
    parts = []
    for name, how in LAYOUTS.items():
        days = F.count_distinct(F.to_date(how.moment)) if how.moment else F.lit(0).cast("long")
        parts.append(
            laid.table(name)
            .agg(F.count("*").alias("row_count"), days.alias("days"), F.count_distinct(how.key).alias("keys"))
            .select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def customer_lifetime_laid_out(wh: Warehouse) -> DataFrame:
    return customer_lifetime_metrics(_laid_out(wh, "customers", "shopify_orders"))


def cart_rates_laid_out(wh: Warehouse) -> DataFrame:
    """Cart and abandonment rates of the last 7 and 30 days."""
    laid = _laid_out(wh, "shopify_events")

    def rates(days: int) -> DataFrame:
        start = wh.as_of - dt.timedelta(days=days - 1)
        return reduce(
            DataFrame.unionByName,
            [
                metric(laid, start, wh.as_of).toDF("rate").select(F.lit(days).alias("days"), F.lit(name).alias("metric"), "rate")
                for name, metric in (("add_to_cart", add_to_cart_rate), ("cart_abandonment", cart_abandonment_rate))
            ],
        )

    return rates(7).unionByName(rates(30))


for _key, _fn in {
    "laid_out_tables": laid_out_tables,
    "customer_lifetime_laid_out": customer_lifetime_laid_out,
    "cart_rates_laid_out": cart_rates_laid_out,
}.items():
    register(_key, _fn)
