"""Base commerce metrics, summary views and the customer/product daily tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    CLICKED,
    OPENED,
    day,
    in_days,
    mean,
    money,
    ratio0,
    rounded,
)
from tidefunnel.operators.combine import dealt
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

Date = dt.date | None
SLICES = 16


def paid_orders(wh: Warehouse) -> DataFrame:
    return wh.table("shopify_orders").where("financial_status = 'paid'")


def buyers(wh: Warehouse) -> DataFrame:
    return wh.table("customers").where("total_orders > 0")


def aov(wh: Warehouse) -> DataFrame:
    """Average paid order value per customer, 0 for customers without one."""
    spent = (
        paid_orders(wh)
        .where("customer_id is not null")
        .groupBy("customer_id")
        .agg(mean("total_price").alias("aov"))
    )
    people = wh.table("customers").select(F.col("id").alias("customer_id"))
    return people.join(spent, "customer_id", "left").select(
        "customer_id", F.coalesce(rounded("aov", 2), F.lit(0.0)).alias("aov")
    )


def campaign_open_rate(wh: Warehouse) -> DataFrame:
    return wh.table("klaviyo_campaigns").select(
        F.col("id").alias("campaign_id"),
        ratio0("unique_opens_count", "delivered_count", 4).alias("open_rate"),
    )


def campaign_click_rate(wh: Warehouse) -> DataFrame:
    return wh.table("klaviyo_campaigns").select(
        F.col("id").alias("campaign_id"),
        ratio0("unique_clicks_count", "delivered_count", 4).alias("click_rate"),
    )


def roas_per_event(wh: Warehouse) -> DataFrame:
    """Revenue per spend of every ad event; 0 when nothing was spent."""
    roas = F.when(F.col("spend") > 0, ratio0("revenue", "spend", 2)).otherwise(0.0)
    return wh.table("ad_events").select(F.col("id").alias("ad_event_id"), roas.alias("roas"))


def customer_lifetime_metrics(wh: Warehouse) -> DataFrame:
    refunds = (
        wh.table("shopify_orders")
        .where("financial_status = 'refunded' and customer_id is not null")
        .groupBy(F.col("customer_id").alias("id"))
        .agg(F.count("*").alias("n"), F.sum("total_price").alias("amount"))
    )
    return (
        wh.table("customers")
        .join(refunds, "id", "left")
        .select(
            F.col("id").alias("customer_id"),
            "email",
            F.col("total_orders").cast("long").alias("total_orders"),
            money("total_revenue").alias("total_revenue"),
            money("average_order_value").alias("average_order_value"),
            "first_order_date",
            "last_order_date",
            F.datediff(F.lit(wh.as_of), "last_order_date").cast("long").alias("days_since_last_order"),
            F.coalesce(F.col("total_orders") > 1, F.lit(False)).alias("is_repeat_customer"),
            F.coalesce("n", F.lit(0)).alias("refunded_orders_count"),
            money("amount").alias("total_refunded"),
        )
    )


def campaign_performance_summary(wh: Warehouse) -> DataFrame:
    return wh.table("klaviyo_campaigns").select(
        F.col("id").alias("campaign_id"),
        "name",
        "type",
        "send_date",
        "recipients_count",
        "delivered_count",
        "unique_opens_count",
        "unique_clicks_count",
        "unsubscribes_count",
        money("revenue").alias("revenue"),
        ratio0("unique_opens_count", "delivered_count", 4).alias("open_rate"),
        ratio0("unique_clicks_count", "delivered_count", 4).alias("click_rate"),
        ratio0("unsubscribes_count", "delivered_count", 6).alias("unsubscribe_rate"),
        ratio0("revenue", "delivered_count", 6).alias("revenue_per_delivered"),
    )


def product_sales(wh: Warehouse, keys: list[str], start: Date = None, end: Date = None) -> DataFrame:
    """Units (all orders), distinct orders and paid revenue of the order lines.

    A range of days leaves out the lines of other days and of unknown orders.
    """
    orders = wh.between("shopify_orders", "order_date", start, end).select(
        F.col("id").alias("order_id"),
        day("order_date").alias("date"),
        (F.col("financial_status") == "paid").alias("is_paid"),
    )
    lines = wh.table("shopify_order_line_items")
    rows = lines.count()  # from the file footers
    how = "left" if start is None and end is None else "inner"
    # one row for each order and key, where the join has dealt the orders already
    per_order = (
        dealt(lines.where("product_id is not null"), rows, "order_id")
        .join(dealt(orders, rows, "order_id"), "order_id", how)
        .groupBy("order_id", *keys)
        .agg(
            F.sum("quantity").alias("units"),
            F.sum(F.when(F.col("is_paid"), F.col("line_total"))).alias("paid_revenue"),
        )
    )
    sums = [F.sum(c).alias(c) for c in ("units", "paid_revenue")]
    # a frequent product is summed in slices first
    slices = per_order.withColumn("slice", F.pmod(F.xxhash64("order_id"), F.lit(SLICES)))
    by_slice = (
        dealt(slices, rows, *keys, "slice")
        .groupBy(*keys, "slice")
        .agg(*sums, F.count("order_id").alias("orders"))
    )
    return dealt(by_slice, rows, *keys).groupBy(*keys).agg(*sums, F.sum("orders").alias("orders"))


def product_interest(
    wh: Warehouse, keys: list[str], start: Date = None, end: Date = None
) -> DataFrame:
    """Product views and cart adds of the web events."""
    return (
        wh.table("shopify_events")
        .where("event_type in ('product_viewed', 'cart_added') and product_id is not null")
        .where(in_days("occurred_at", start, end))
        .withColumn("date", day("occurred_at"))
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("event_type") == "product_viewed").alias("views"),
            F.count_if(F.col("event_type") == "cart_added").alias("carts"),
        )
    )


def product_performance_summary(wh: Warehouse) -> DataFrame:
    return (
        wh.table("shopify_products")
        .withColumnRenamed("id", "product_id")
        .join(product_sales(wh, ["product_id"]), "product_id", "left")
        .join(product_interest(wh, ["product_id"]), "product_id", "left")
        .select(
            "product_id",
            "title",
            "handle",
            "status",
            F.col("units").alias("total_units_sold"),
            money("paid_revenue").alias("total_revenue"),
            F.coalesce("orders", F.lit(0)).alias("orders_count"),
            F.coalesce("views", F.lit(0)).alias("total_views"),
            F.coalesce("carts", F.lit(0)).alias("total_cart_adds"),
            ratio0("orders", "views", 6).alias("conversion_rate"),
        )
    )


def customer_metrics_daily(
    wh: Warehouse, start: Date = None, end: Date = None, fan_out: bool = True
) -> DataFrame:
    """One row per customer and day with an order or a web event.

    Each fact is read for the days in [start, end] only, but for the two counts
    of all events that are the weights below.

    The established figures join orders, web events and mail events on the
    customer alone, so each day's revenue is multiplied by the customer's
    total number of web and of mail events.  ``fan_out=True`` reproduces that
    by weights taken from per-customer counts; False gives the plain revenue.
    """
    orders = (
        wh.table("shopify_orders")
        .where("customer_id is not null")
        .where(in_days("order_date", start, end))
        .groupBy("customer_id", day("order_date").alias("date"))
        .agg(
            F.count("*").alias("orders_count"),
            F.sum(F.when(F.col("financial_status") == "paid", F.col("total_price"))).alias("paid"),
        )
    )
    all_web = wh.table("shopify_events").where("customer_id is not null")
    web = (
        all_web.where(in_days("occurred_at", start, end))
        .groupBy("customer_id", day("occurred_at").alias("date"))
        .agg(
            F.count_if(F.col("event_type") == "product_viewed").alias("products_viewed_count"),
            F.count_if(F.col("event_type") == "cart_added").alias("cart_adds_count"),
            F.count_if(F.col("event_type") == "checkout_started").alias("checkouts_started_count"),
        )
    )
    all_mails = wh.table("klaviyo_events").where("customer_id is not null")
    mails = (
        all_mails.where(in_days("occurred_at", start, end))
        .groupBy("customer_id", day("occurred_at").alias("date"))
        .agg(
            F.count_if(F.col("event_type") == OPENED).alias("emails_opened_count"),
            F.count_if(F.col("event_type") == CLICKED).alias("emails_clicked_count"),
        )
    )
    people = wh.table("customers").select(F.col("id").alias("customer_id"))
    rows = (
        orders.join(web, ["customer_id", "date"], "full_outer")
        .join(mails, ["customer_id", "date"], "left")
        .join(people, "customer_id", "left_semi")
    )
    revenue = F.coalesce(F.col("paid"), F.lit(0))
    if fan_out:
        web_total = all_web.groupBy("customer_id").agg(F.count("*").alias("web_total"))
        mail_total = all_mails.groupBy("customer_id").agg(F.count("*").alias("mail_total"))
        rows = rows.join(web_total, "customer_id", "left").join(mail_total, "customer_id", "left")
        revenue = (
            revenue.cast("decimal(20,2)")
            * F.coalesce("web_total", F.lit(1)).cast("decimal(18,0)")
            * F.coalesce("mail_total", F.lit(1)).cast("decimal(18,0)")
        )
    counts = [
        "orders_count",
        "products_viewed_count",
        "cart_adds_count",
        "checkouts_started_count",
        "emails_opened_count",
        "emails_clicked_count",
    ]
    return rows.select(
        "customer_id",
        "date",
        money(revenue).alias("revenue"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )


def campaign_performance_daily(wh: Warehouse) -> DataFrame:
    """Campaign counters as a snapshot on the send date."""
    return (
        wh.table("klaviyo_campaigns")
        .where("send_date is not null")
        .select(
            F.col("id").alias("campaign_id"),
            day("send_date").alias("date"),
            F.col("recipients_count").alias("sent_count"),
            "delivered_count",
            F.col("unique_opens_count").alias("opens_count"),
            F.col("unique_clicks_count").alias("clicks_count"),
            "unsubscribes_count",
            money("revenue").alias("revenue"),
        )
    )


def product_performance_daily(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Views, cart adds, orders, units and paid revenue per product and day."""
    keys = ["product_id", "date"]
    return (
        product_interest(wh, keys, start, end)
        .join(product_sales(wh, keys, start, end), keys, "full_outer")
        .select(
            *keys,
            F.coalesce("views", F.lit(0)).alias("views_count"),
            F.coalesce("carts", F.lit(0)).alias("cart_adds_count"),
            F.coalesce("orders", F.lit(0)).alias("orders_count"),
            F.coalesce("units", F.lit(0)).alias("units_sold"),
            F.coalesce(money("paid_revenue"), F.lit(0.0)).alias("revenue"),
        )
    )


for _plan in (
    aov,
    campaign_open_rate,
    campaign_click_rate,
    roas_per_event,
    customer_lifetime_metrics,
    campaign_performance_summary,
    product_performance_summary,
    customer_metrics_daily,
    campaign_performance_daily,
    product_performance_daily,
):
    register(_plan.__name__, _plan)
