"""Warehouse metrics of the metric catalogue: orders, products, flows, funnels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    SUBSCRIBED,
    day,
    in_days,
    json_text,
    mean,
    money,
    ratio,
    ratio0,
    rounded,
)
from tidefunnel.operators.combine import left_join_spread
from tidefunnel.operators.gaps import order_days
from tidefunnel.operators.ordered import descending_rank
from tidefunnel.operators.tables import staged
from tidefunnel.plans.commerce import (
    buyers,
    campaign_performance_daily,
    campaign_performance_summary,
    paid_orders,
)
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

Date = dt.date | None


# --- customers and orders -----------------------------------------------------------


def repeat_customer_rate_pct(wh: Warehouse) -> DataFrame:
    return buyers(wh).agg(
        ratio(F.count_if(F.col("total_orders") > 1), F.count("*"), 6, 100).alias("repeat_rate")
    )


def customer_order_rollup(wh: Warehouse) -> DataFrame:
    """Order totals and first-time flag of each customer, from paid orders."""
    return (
        paid_orders(wh)
        .where("customer_id is not null")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_orders"),
            money(F.sum("total_price")).alias("total_revenue"),
            rounded(mean("total_price"), 2).alias("average_order_value"),
            F.min(day("order_date")).alias("first_order_date"),
            F.max(day("order_date")).alias("last_order_date"),
            (F.count("*") == 1).alias("is_first_time_customer"),
        )
    )


def revenue_by_source(wh: Warehouse) -> DataFrame:
    return (
        paid_orders(wh)
        .groupBy("source")
        .agg(
            F.count("*").alias("order_count"),
            money(F.sum("total_price")).alias("revenue"),
            rounded(mean("total_price"), 2).alias("aov_by_source"),
        )
    )


def _share_of_orders(wh: Warehouse, column: str, name: str, by_source: bool) -> DataFrame:
    share = ratio(F.count(column), F.count("*"), 6, 100).alias(name)
    orders = wh.table("shopify_orders")
    return orders.groupBy("source").agg(share) if by_source else orders.agg(share)


def refund_rate(wh: Warehouse, by_source: bool = False) -> DataFrame:
    return _share_of_orders(wh, "refund_status", "refund_rate", by_source)


def cancellation_rate(wh: Warehouse, by_source: bool = False) -> DataFrame:
    return _share_of_orders(wh, "cancelled_at", "cancellation_rate", by_source)


def revenue_last_30_days(wh: Warehouse) -> DataFrame:
    recent = in_days("order_date", wh.as_of - dt.timedelta(days=30), None)
    return paid_orders(wh).where(recent).agg(money(F.sum("total_price")).alias("revenue"))


def ltv_distribution(wh: Warehouse) -> DataFrame:
    revenue = F.col("total_revenue")
    bucket = (
        F.when(revenue < 50, "$0-50")
        .when(revenue < 100, "$50-100")
        .when(revenue < 200, "$100-200")
        .otherwise("$200+")
    )
    return (
        buyers(wh)
        .groupBy(bucket.alias("ltv_bucket"))
        .agg(F.count("*").alias("customer_count"), F.min("total_revenue").alias("least"))
        .orderBy("least")
        .drop("least")
    )


# --- products -------------------------------------------------------------------------


def lines(wh: Warehouse) -> DataFrame:
    return wh.table("shopify_order_line_items")


def product_units_revenue_paid(wh: Warehouse) -> DataFrame:
    paid = paid_orders(wh).select(F.col("id").alias("order_id"))
    return (
        lines(wh)
        .join(paid, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), money(F.sum("line_total")).alias("revenue"))
    )


def product_event_conversion(wh: Warehouse) -> DataFrame:
    """Orders with the product per product view, in percent; NULL without views."""
    views = (
        wh.table("shopify_events")
        .where("event_type = 'product_viewed'")
        .groupBy("product_id")
        .agg(F.count("*").alias("views"))
    )
    orders = lines(wh).groupBy("product_id").agg(F.countDistinct("order_id").alias("orders"))
    return (
        wh.table("shopify_products")
        .select(F.col("id").alias("product_id"))
        .join(views, "product_id", "left")
        .join(orders, "product_id", "left")
        .select(
            "product_id",
            ratio(F.coalesce("orders", F.lit(0)), "views", 6, 100).alias("conversion_rate"),
        )
    )


def _variant_sales(wh: Warehouse) -> DataFrame:
    sold = (
        lines(wh)
        .where("variant_id is not null")
        .groupBy(F.col("variant_id").alias("id"))
        .agg(F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue"))
    )
    return wh.table("shopify_product_variants").join(sold, "id", "left")


def gross_margin(wh: Warehouse) -> DataFrame:
    """(revenue - cost of the units sold) / revenue in percent, per variant."""
    margin = num_minus("revenue", F.col("cost").cast("double") * F.col("units"))
    return _variant_sales(wh).select(
        F.col("id").alias("variant_id"),
        "sku",
        money("revenue").alias("revenue"),
        ratio(margin, "revenue", 6, 100).alias("gross_margin"),
    )


def num_minus(a: str, b: Column) -> Column:
    return F.col(a).cast("double") - b


def inventory_turnover(wh: Warehouse) -> DataFrame:
    """Units sold per unit in stock; the one stored stock level is the average."""
    return _variant_sales(wh).select(
        F.col("id").alias("variant_id"),
        "sku",
        ratio(F.coalesce("units", F.lit(0)), "inventory_quantity", 6).alias("inventory_turnover"),
    )


def bestseller_rank(wh: Warehouse) -> DataFrame:
    """Products ranked by units sold and by revenue of paid orders."""
    sold = (
        wh.table("shopify_products")
        .select(F.col("id").alias("product_id"), "title")
        .join(product_units_revenue_paid(wh), "product_id", "left")
        .fillna({"units_sold": 0, "revenue": 0.0})
    )
    # ranking passes over the products several times; neither rank rebuilds the other
    sold = staged(sold, "products-sold")
    units = descending_rank(sold.select("product_id", "units_sold"), "units_sold", "units_rank")
    by_revenue = descending_rank(sold, "revenue", "revenue_rank")
    return by_revenue.join(units.select("product_id", "units_rank"), "product_id").select(
        *sold.columns, "units_rank", "revenue_rank"
    )


def _funnel(wh: Warehouse, since: Date) -> DataFrame:
    events = (
        wh.table("shopify_events")
        .where(F.col("event_type").isin("product_viewed", "cart_added") & in_days("occurred_at", since, None))
        .groupBy("product_id")
        .agg(
            F.count_if(F.col("event_type") == "product_viewed").alias("views"),
            F.count_if(F.col("event_type") == "cart_added").alias("cart_adds"),
        )
    )
    bought = lines(wh)
    if since is not None:
        recent = wh.table("shopify_orders").where(in_days("order_date", since, None))
        bought = bought.join(recent.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    orders = bought.groupBy("product_id").agg(F.countDistinct("order_id").alias("purchases"))
    counts = ["views", "cart_adds", "purchases"]
    return (
        wh.table("shopify_products")
        .select(F.col("id").alias("product_id"), "title")
        .join(events, "product_id", "left")
        .join(orders, "product_id", "left")
        .select("product_id", "title", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    )


def product_funnel(wh: Warehouse) -> DataFrame:
    return _funnel(wh, None)


def product_funnel_7d(wh: Warehouse) -> DataFrame:
    return (
        _funnel(wh, wh.as_of - dt.timedelta(days=7))
        .where("views > 0")
        .withColumn("conversion_rate_pct", ratio("purchases", "views", 2, 100))
        .orderBy(F.desc("conversion_rate_pct"), "product_id")
    )


# --- campaigns, flows, lists --------------------------------------------------------


def unsubscribe_rate(wh: Warehouse) -> DataFrame:
    return wh.table("klaviyo_campaigns").select(
        F.col("id").alias("campaign_id"),
        ratio("unsubscribes_count", "delivered_count", 6, 100).alias("unsubscribe_rate"),
    )


def revenue_per_recipient(wh: Warehouse) -> DataFrame:
    return wh.table("klaviyo_campaigns").select(
        F.col("id").alias("campaign_id"),
        ratio("revenue", "recipients_count", 6).alias("revenue_per_recipient"),
    )


def flow_conversion_rate(wh: Warehouse) -> DataFrame:
    return wh.table("klaviyo_flows").select(
        F.col("id").alias("flow_id"),
        "name",
        ratio("conversion_count", "recipients_entered_count", 6, 100).alias("conversion_rate"),
    )


def flow_step_dropoff(wh: Warehouse) -> DataFrame:
    """Recipients lost since the previous step of the flow, in percent."""
    before = F.lag("recipients_count").over(Window.partitionBy("flow_id").orderBy("step_order"))
    steps = wh.table("klaviyo_flow_steps").select(
        "flow_id", "step_order", "recipients_count", before.alias("before")
    )
    lost = F.col("before") - F.col("recipients_count")
    rate = F.when(F.col("before") > 0, ratio(lost, "before", 6, 100)).otherwise(0.0)
    return steps.select("flow_id", "step_order", rate.alias("drop_off_rate"))


def top_campaigns_90d(wh: Warehouse, limit: int = 10) -> DataFrame:
    recent = in_days("send_date", wh.as_of - dt.timedelta(days=90), None)
    return (
        wh.table("klaviyo_campaigns")
        .where(recent & (F.col("status") == "sent"))
        .orderBy(F.desc("revenue"), "id")
        .limit(limit)
        .select(
            "name",
            "type",
            "recipients_count",
            rounded(ratio0("unique_opens_count", "delivered_count", 4) * 100, 2).alias("open_rate_pct"),
            rounded(ratio0("unique_clicks_count", "delivered_count", 4) * 100, 2).alias("click_rate_pct"),
            money("revenue").alias("revenue"),
            ratio("revenue", "delivered_count", 6).alias("revenue_per_delivered"),
        )
    )


def campaign_by_day_of_week(wh: Warehouse) -> DataFrame:
    """Mean rates and revenue by weekday of the send date (0 = Sunday)."""
    rates = campaign_performance_summary(wh).select("campaign_id", "open_rate", "click_rate")
    return (
        campaign_performance_daily(wh)
        .join(rates, "campaign_id")
        .groupBy((F.dayofweek("date") - 1).alias("day_of_week"))
        .agg(
            rounded(F.avg("open_rate"), 6).alias("avg_open_rate"),
            rounded(F.avg("click_rate"), 6).alias("avg_click_rate"),
            rounded(F.sum("revenue"), 2).alias("total_revenue"),
        )
        .orderBy("day_of_week")
    )


def list_changes(wh: Warehouse) -> DataFrame:
    """Subscribers gained and lost per list and moment.

    Mail events name the signup source in their properties; it serves as the
    list.  With memberships at hand, pass (list, date, gained, lost) rows to
    :func:`email_list_growth_rate` instead.
    """
    gained = (F.col("event_type") == SUBSCRIBED).cast("int")
    lost = (F.col("event_type") == "Unsubscribed").cast("int")
    return (
        wh.table("klaviyo_events")
        .where(F.col("event_type").isin(SUBSCRIBED, "Unsubscribed"))
        .select(
            json_text("event_properties", "source").alias("list"),
            day("occurred_at").alias("date"),
            gained.alias("gained"),
            lost.alias("lost"),
        )
    )


def email_list_growth_rate(
    wh: Warehouse, changes: DataFrame | None = None, period: str = "week"
) -> DataFrame:
    """(new - unsubscribed) / size before the period, in percent, per list."""
    changes = list_changes(wh) if changes is None else changes
    periods = changes.groupBy("list", F.trunc("date", period).alias("period")).agg(
        F.sum("gained").alias("new_subscribers"), F.sum("lost").alias("unsubscribes")
    )
    net = F.col("new_subscribers") - F.col("unsubscribes")
    before = (
        Window.partitionBy("list").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    )
    return periods.select(
        "*", F.coalesce(F.sum(net).over(before), F.lit(0)).alias("previous_size")
    ).withColumn("growth_rate", ratio(net, "previous_size", 6, 100))


def abandoned_cart_recovery_rate(wh: Warehouse) -> DataFrame:
    """Checkouts left open that a paid order follows within seven days.

    A session is abandoned when it starts a checkout and completes none; it is
    recovered when its customer has a paid order after the last checkout start
    and at most seven days later.
    """
    abandoned = (
        wh.table("shopify_events")
        .where(
            F.col("event_type").isin("checkout_started", "checkout_completed")
            & F.col("session_id").isNotNull()
        )
        .groupBy("session_id")
        .agg(
            F.max("customer_id").alias("customer_id"),
            F.max(F.when(F.col("event_type") == "checkout_started", F.col("occurred_at"))).alias("t"),
            F.max(F.col("event_type") == "checkout_completed").alias("completed"),
        )
        .where("t is not null and not completed")
        .withColumn("date", day("t"))
    )
    # one row per customer and day: the paid orders on it and the week after
    ahead = (
        order_days(paid_orders(wh))
        .select(
            "customer_id",
            "first_at",
            "last_at",
            F.posexplode(F.expr("sequence(date, date_sub(date, 7), interval -1 day)")).alias(
                "later", "date"
            ),
        )
        .groupBy("customer_id", "date")
        .agg(
            F.max(F.col("later").between(1, 6)).alias("between"),
            F.max(F.when(F.col("later") == 0, F.col("last_at"))).alias("same_day_last"),
            F.max(F.when(F.col("later") == 7, F.col("first_at"))).alias("week_on_first"),
        )
    )
    t = F.col("t")
    recovered = (
        F.coalesce("between", F.lit(False))
        | F.coalesce(F.col("same_day_last") > t, F.lit(False))
        | F.coalesce(F.col("week_on_first") <= t + F.expr("interval 7 days"), F.lit(False))
    )
    rows = left_join_spread(
        abandoned, ahead, ["customer_id", "date"], nullable="customer_id", spread_by="session_id"
    )
    return rows.agg(
        F.count("*").alias("abandoned_carts"),
        F.count_if(recovered).alias("recovered_carts"),
        ratio(F.count_if(recovered), F.count("*"), 6, 100).alias("recovery_rate"),
    )


# --- cohorts ------------------------------------------------------------------------


def active_customer_days(wh: Warehouse) -> DataFrame:
    """Days on which a customer ordered or visited (the daily customer table's keys)."""
    ordered = wh.table("shopify_orders").select("customer_id", day("order_date").alias("date"))
    visited = wh.table("shopify_events").select("customer_id", day("occurred_at").alias("date"))
    return ordered.union(visited).where("customer_id is not null").distinct()


def whole_months(start: Column, end: Column) -> Column:
    """Completed calendar months between two dates; negative when end < start."""
    lo, hi = F.least(start, end), F.greatest(start, end)
    months = (F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo)
    complete = months - (F.dayofmonth(hi) < F.dayofmonth(lo)).cast("int")
    return complete * F.when(end < start, -1).otherwise(1)


def cohort_retention_matrix(
    wh: Warehouse, first_month: dt.date = dt.date(2024, 1, 1)
) -> DataFrame:
    """Active customers by cohort month and month part of the customer's age.

    Only the month part of the age counts: 14 months appear as 2.
    """
    people = (
        wh.table("customers")
        .where(F.col("first_order_date") >= F.lit(first_month))
        .select(F.col("id").alias("customer_id"), "first_order_date")
    )
    age = whole_months(F.col("first_order_date"), F.col("date"))
    return (
        active_customer_days(wh)
        .join(people, "customer_id")
        .groupBy(
            F.trunc("first_order_date", "month").alias("cohort_month"),
            (age % 12).alias("months_since_first"),
        )
        .agg(F.countDistinct("customer_id").alias("customers"))
        .orderBy("cohort_month", "months_since_first")
    )


for _fn in (
    repeat_customer_rate_pct, customer_order_rollup, revenue_by_source, refund_rate,
    cancellation_rate, product_units_revenue_paid, product_event_conversion, gross_margin,
    inventory_turnover, unsubscribe_rate, revenue_per_recipient, flow_conversion_rate,
    flow_step_dropoff, abandoned_cart_recovery_rate, email_list_growth_rate, bestseller_rank,
    cohort_retention_matrix, campaign_by_day_of_week, product_funnel, product_funnel_7d,
    revenue_last_30_days, ltv_distribution, top_campaigns_90d,
):
    register(_fn.__name__, _fn)
register("refund_rate_by_source", lambda wh: refund_rate(wh, by_source=True))
register("cancellation_rate_by_source", lambda wh: cancellation_rate(wh, by_source=True))
