"""Customer-level analyses across acquisition, web, orders and advocacy.

Every fact is reduced to one row per customer; the partial rows are stacked
and summed once, so each analysis joins customers with a single table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    ACQUIRING,
    MAIL_TOUCHES,
    day,
    json_text,
    money,
    ratio,
    ratio0,
    rounded,
    span_seconds,
)
from tidefunnel.operators.calendar import running_totals
from tidefunnel.operators.combine import stack_sum
from tidefunnel.plans.advocacy import nps, per_customer
from tidefunnel.plans.acquisition import revenue_over_ad_rows
from tidefunnel.plans.commerce import buyers, paid_orders
from tidefunnel.plans.consideration import CART, is_event, site_rates_daily
from tidefunnel.plans.retention import EVER, customer_predictions, repeat_purchase_rate
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse


def _stack(parts: list[DataFrame]) -> DataFrame:
    measures = [c for part in parts for c in part.columns if c != "id"]
    return stack_sum(["id"], parts, measures)


def _zero(*names: str) -> list[Column]:
    return [F.coalesce(n, F.lit(0)).alias(n) for n in names]


def _reviews(wh: Warehouse) -> DataFrame:
    return per_customer(wh.table("reviews"), "customer_id", reviews=F.count("*"))


def _posts(wh: Warehouse) -> DataFrame:
    return per_customer(wh.table("ugc_submissions"), "customer_id", ugc_count=F.count("*"))


def _referrals(wh: Warehouse) -> DataFrame:
    return per_customer(wh.table("referrals"), "referrer_customer_id", referrals=F.count("*"))


def _tiers(wh: Warehouse) -> DataFrame:
    return wh.table("loyalty_enrollments").select(F.col("customer_id").alias("id"), "loyalty_tier")


def _average(part_sum: str, part_n: str, scale: int = 6) -> Column:
    return ratio(part_sum, part_n, scale)


def _daily_rate_per_customer(wh: Warehouse, column: str, name: str) -> DataFrame:
    """A daily site figure averaged over the customer's event rows."""
    daily = site_rates_daily(wh).select("date", F.col(column).alias("v"))
    visits = (
        wh.table("shopify_events")
        .where("customer_id is not null")
        .groupBy(F.col("customer_id").alias("id"), day("occurred_at").alias("date"))
        .agg(F.count("*").alias("n"))
    )
    return (
        visits.join(daily.where("v is not null"), "date")
        .groupBy("id")
        .agg(F.sum(F.col("v") * F.col("n")).alias(f"{name}_sum"), F.sum("n").alias(f"{name}_n"))
    )


def customer_journey(wh: Warehouse) -> DataFrame:
    """Each buyer from first ad to loyalty: cost, carts, dwell time, churn, advocacy."""
    in_session = F.col("session_id").isNotNull()
    visits = (
        wh.table("shopify_events")
        .where("customer_id is not null")
        .groupBy(F.col("customer_id").alias("id"), "session_id")
        .agg(
            span_seconds(F.min("occurred_at"), F.max("occurred_at")).alias("s"),
            F.count_if(is_event(CART)).alias("carts"),
        )
        .groupBy("id")
        .agg(
            F.sum(F.when(in_session, F.col("s"))).alias("span_sum"),
            F.count_if(in_session).alias("span_n"),
            F.sum("carts").alias("cart_adds"),
        )
    )
    facts = _stack(
        [
            per_customer(
                wh.table("ad_events"),
                "customer_id",
                cost=F.sum("spend"),
                ad_conversions=F.count_if(F.col("event_type") == "conversion"),
            ),
            visits,
            per_customer(
                customer_predictions(wh),
                "customer_id",
                churn_sum=F.sum("predicted_churn_probability"),
                churn_n=F.count("predicted_churn_probability"),
            ),
            _reviews(wh),
            _referrals(wh),
        ]
    )
    return (
        buyers(wh)
        .join(facts, "id", "left")
        .join(_tiers(wh), "id", "left")
        .select(
            "email",
            F.col("total_orders").cast("long").alias("total_orders"),
            money("total_revenue").alias("ltv"),
            money("cost").alias("acquisition_cost"),
            *_zero("ad_conversions", "cart_adds"),
            _average("span_sum", "span_n").alias("avg_session_duration"),
            (F.col("total_orders") > 1).alias("is_repeat_customer"),
            _average("churn_sum", "churn_n").alias("churn_probability"),
            F.coalesce("reviews", F.lit(0)).alias("reviews_count"),
            F.coalesce("referrals", F.lit(0)).alias("referrals_made"),
            "loyalty_tier",
        )
        .orderBy(F.desc("ltv"), "email")
    )


def _acquired(wh: Warehouse) -> DataFrame:
    """Acquiring ad events of known customers, per platform and customer."""
    people = wh.table("customers").select(F.col("id").alias("customer_id"))
    return (
        wh.table("ad_events")
        .where(F.col("event_type").isin(*ACQUIRING) & F.col("customer_id").isNotNull())
        .groupBy("platform", "customer_id")
        .agg(F.sum("spend").alias("spend"), F.count("*").alias("rows"))
        .join(people, "customer_id", "left_semi")
    )


def _acquiring_rows(wh: Warehouse) -> DataFrame:
    return wh.table("ad_events").where(F.col("event_type").isin(*ACQUIRING))


def channel_ltv_cac(wh: Warehouse) -> DataFrame:
    """Cost, value, engagement and reviews of the customers each platform acquired.

    Cost and value run over ad rows; engagement (dwell time of the days the
    customer visited) and reviews are means over distinct acquired customers.
    """
    acquired = _acquired(wh)
    facts = _stack(
        [_daily_rate_per_customer(wh, "avg_session_duration_seconds", "dwell"), _reviews(wh)]
    ).withColumn("dwell", F.col("dwell_sum") / F.col("dwell_n"))
    people = (
        acquired.withColumnRenamed("customer_id", "id")
        .join(facts.select("id", "dwell", "reviews"), "id", "left")
        .groupBy("platform")
        .agg(
            F.count("*").alias("customers"),
            F.sum("spend").alias("spend"),
            rounded(F.avg("dwell"), 4).alias("avg_engagement"),
            ratio(F.coalesce(F.sum("reviews"), F.lit(0)), F.count("*"), 4).alias(
                "avg_reviews_per_customer"
            ),
        )
    )
    value = revenue_over_ad_rows(wh, _acquiring_rows(wh), ["platform"])
    cac = F.col("spend").cast("double") / F.col("customers")
    ltv = F.col("ltv_sum").cast("double") / F.col("ltv_rows")
    return (
        people.join(value, "platform")
        .select(
            "platform",
            F.col("customers").alias("customers_acquired"),
            money("spend").alias("total_spend"),
            rounded(cac, 6).alias("cac"),
            rounded(ltv, 6).alias("avg_ltv"),
            ratio(ltv, cac, 6).alias("ltv_cac_ratio"),
            "avg_engagement",
            "avg_reviews_per_customer",
        )
        .orderBy(F.desc("ltv_cac_ratio"), "platform")
    )


def customer_engagement_score(wh: Warehouse) -> DataFrame:
    """Weighted engagement over web events, dwell time, mail and advocacy."""
    facts = _stack(
        [
            per_customer(
                wh.table("shopify_events").where(is_event("product_viewed", CART)),
                "customer_id",
                engagement_events=F.count("*"),
            ),
            _daily_rate_per_customer(wh, "avg_session_duration_seconds", "dwell"),
            per_customer(
                customer_predictions(wh),
                "customer_id",
                engage_sum=F.sum("email_engagement_probability"),
                engage_n=F.count("email_engagement_probability"),
            ),
            _reviews(wh),
            _posts(wh),
            _referrals(wh),
        ]
    )
    rows = (
        buyers(wh)
        .join(facts, "id", "left")
        .select(
            "id",
            "email",
            F.col("total_orders").cast("long").alias("total_orders"),
            money("total_revenue").alias("total_revenue"),
            *_zero("engagement_events"),
            _average("dwell_sum", "dwell_n", 4).alias("avg_session_duration"),
            _average("engage_sum", "engage_n", 6).alias("email_engagement_prob"),
            *_zero("reviews", "ugc_count", "referrals"),
        )
    )
    advocacy = F.col("reviews") + F.col("ugc_count") + F.col("referrals")
    score = (
        F.col("engagement_events") * 0.3
        + F.coalesce("avg_session_duration", F.lit(0.0)) * 0.2
        + F.coalesce("email_engagement_prob", F.lit(0.0)) * 20.0
        + advocacy * 0.1
    )
    return rows.withColumn("total_engagement_score", rounded(score, 4)).orderBy(
        F.desc("total_engagement_score"), "id"
    )


def customer_health_score(wh: Warehouse) -> DataFrame:
    """Where each buyer stands: channel, retention and advocacy, and a 10-100 score."""
    facts = _stack(
        [
            per_customer(wh.table("ad_events"), "customer_id", ad_rows=F.count("*")),
            _daily_rate_per_customer(wh, "add_to_cart_rate", "atc"),
            _reviews(wh),
            _referrals(wh),
        ]
    )

    def has(name: str) -> Column:
        return F.coalesce(F.col(name) > 0, F.lit(False))

    def active(days: int) -> Column:
        cutoff = F.lit(wh.as_of - dt.timedelta(days=days))
        return F.coalesce(F.col("last_order_date") >= cutoff, F.lit(False))

    vip = F.coalesce(F.col("loyalty_tier") == "vip", F.lit(False)) | F.coalesce(
        F.array_contains("tags", "VIP"), F.lit(False)
    )
    repeat = F.col("total_orders") > 1
    return (
        buyers(wh)
        .join(facts, "id", "left")
        .join(_tiers(wh), "id", "left")
        .select(
            "email",
            F.col("total_orders").cast("long").alias("total_orders"),
            money("total_revenue").alias("total_revenue"),
            F.when(has("ad_rows"), "Acquired via Ads").otherwise("Organic").alias("acquisition_source"),
            _average("atc_sum", "atc_n").alias("avg_add_to_cart_rate"),
            F.when(repeat, "Repeat Customer")
            .when(active(30), "Active")
            .when(active(90), "At Risk")
            .otherwise("Churned")
            .alias("retention_status"),
            F.when(vip, "VIP Advocate")
            .when(has("reviews") | has("referrals"), "Advocate")
            .otherwise("Regular Customer")
            .alias("advocacy_status"),
            (
                F.when(repeat, 30).otherwise(10)
                + F.when(active(30), 30).otherwise(0)
                + F.when(has("reviews"), 20).otherwise(0)
                + F.when(has("referrals"), 20).otherwise(0)
            ).alias("health_score"),
        )
        .orderBy(F.desc("health_score"), F.desc("total_revenue"), "email")
    )


def channel_revenue_attribution(wh: Warehouse) -> DataFrame:
    """Cost, ad sessions, customer value and referral revenue per platform.

    Value runs over ad rows; sessions and referral revenue over the distinct
    customers a platform acquired.
    """
    acquired = _acquired(wh)
    visits = (
        wh.table("shopify_events")
        .where("customer_id is not null and session_id is not null")
        .select("customer_id", "session_id", json_text("event_properties", "referrer").alias("referrer"))
        .where("referrer is not null")
        .distinct()
    )
    sessions = (
        acquired.select("platform", "customer_id")
        .join(visits, "customer_id")
        .where(F.contains("referrer", "platform"))
        .groupBy("platform")
        .agg(F.countDistinct("session_id").alias("sessions_from_ads"))
    )
    bought = (
        paid_orders(wh)
        .groupBy(F.col("customer_id").alias("referred_customer_id"))
        .agg(F.sum("total_price").alias("referral_revenue"))
    )
    brought = (
        wh.table("referrals")
        .select(F.col("referrer_customer_id").alias("customer_id"), "referred_customer_id")
        .distinct()
        .join(bought, "referred_customer_id")
        .groupBy("customer_id")
        .agg(F.sum("referral_revenue").alias("referral_revenue"))
    )
    people = (
        acquired.join(brought, "customer_id", "left")
        .groupBy("platform")
        .agg(
            F.sum("spend").alias("spend"),
            F.count("*").alias("customers_acquired"),
            F.sum("referral_revenue").alias("referral_revenue"),
        )
    )
    value = revenue_over_ad_rows(wh, _acquiring_rows(wh), ["platform"])
    parts = stack_sum(
        ["platform"],
        [people, sessions, value],
        ["spend", "customers_acquired", "referral_revenue", "sessions_from_ads", "ltv_sum", "ltv_rows"],
    )
    return (
        parts.where("customers_acquired > 0")
        .select(
            F.col("platform").alias("acquisition_channel"),
            money("spend").alias("acquisition_cost"),
            "customers_acquired",
            *_zero("sessions_from_ads"),
            money("ltv_sum").alias("total_ltv_from_channel"),
            ratio("ltv_sum", "ltv_rows", 6).alias("avg_ltv_per_customer"),
            money("referral_revenue").alias("referral_revenue"),
            ratio("ltv_sum", "spend", 6).alias("channel_roi"),
        )
        .orderBy(F.desc("channel_roi"), "acquisition_channel")
    )


def customer_metric_card(wh: Warehouse, platform: str = "meta") -> DataFrame:
    """Per buyer: platform CAC and add-to-cart rate since the first order, and more.

    "Since day s" counts become totals minus what lies before s: a customer or
    session still counts while its last event is on or after s.  The per-day
    table has one row per first order date.
    """
    until = F.lit(wh.as_of)
    shown = wh.table("ad_events").where(
        (F.col("platform") == platform) & F.col("event_type").isin(*ACQUIRING) & (F.col("date") <= until)
    )
    spend = shown.groupBy("date").agg(F.sum("spend").alias("spend"))
    reached = (
        shown.where("customer_id is not null")
        .groupBy("customer_id")
        .agg(F.max("date").alias("date"))
        .groupBy("date")
        .agg(F.count("*").alias("reached"))
    )
    events = wh.table("shopify_events").where(
        F.col("session_id").isNotNull() & (day("occurred_at") <= until)
    )

    def last_days(event_type: str, name: str) -> DataFrame:
        return (
            events.where(is_event(event_type))
            .groupBy("session_id")
            .agg(F.max(day("occurred_at")).alias("date"))
            .groupBy("date")
            .agg(F.count("*").alias(name))
        )

    names = ["spend", "reached", "carts", "views"]
    per_day = stack_sum(
        ["date"],
        [spend, reached, last_days(CART, "carts"), last_days("product_viewed", "views")],
        names,
    )
    before = per_day.select(F.date_add("date", 1).alias("date"), *names)
    overall = per_day.groupBy(F.lit(EVER).alias("date")).agg(
        *[F.sum(n).alias(f"all_{n}") for n in names]
    )
    starts = buyers(wh).where("first_order_date is not null").select(
        F.col("first_order_date").alias("date")
    ).distinct()
    totals = running_totals(
        starts,
        before.unionByName(overall, allowMissingColumns=True),
        [*names, *[f"all_{n}" for n in names]],
    )
    since = {n: F.col(f"all_{n}") - F.col(n) for n in names}
    rates = totals.select(
        F.col("date").alias("first_order_date"),
        ratio0(since["spend"], since["reached"], 2).alias("cac"),
        ratio0(since["carts"], since["views"], 4).alias("atc_rate"),
    )
    return (
        buyers(wh)
        .join(rates, "first_order_date", "left")
        .join(_reviews(wh), "id", "left")
        .select(
            "email",
            F.coalesce("cac", F.lit(0.0)).alias("cac"),
            F.coalesce("atc_rate", F.lit(0.0)).alias("atc_rate"),
            money("total_revenue").alias("ltv"),
            repeat_purchase_rate(wh).scalar().alias("repeat_rate"),
            nps(wh).scalar().alias("nps"),
            *_zero("reviews"),
        )
    )


def funnel_stage_counts(wh: Warehouse) -> DataFrame:
    """Distinct customers at each stage from first view to fulfilled order."""
    stages = {
        "product_viewed": "1 product views",
        "cart_added": "2 cart adds",
        CART: "2 cart adds",
        "checkout_started": "3 checkout started",
    }
    web = wh.table("shopify_events").where(is_event(*stages))
    label = F.coalesce(*[F.when(is_event(e), s) for e, s in stages.items()])
    mails = wh.table("klaviyo_events").where(is_event(*MAIL_TOUCHES))
    orders = wh.table("shopify_orders")
    seen = [
        wh.table("customers").select(F.col("id").alias("customer_id"), F.lit("0 created").alias("stage")),
        web.select("customer_id", label.alias("stage")),
        mails.select("customer_id", F.lit("4 email opened or clicked").alias("stage")),
        orders.select("customer_id", F.lit("5 order placed").alias("stage")),
        orders.where("fulfillment_status = 'fulfilled'").select(
            "customer_id", F.lit("6 order fulfilled").alias("stage")
        ),
    ]
    rows = seen[0]
    for part in seen[1:]:
        rows = rows.union(part)
    return (
        rows.where("customer_id is not null")
        .distinct()
        .groupBy("stage")
        .agg(F.count("*").alias("customers"))
        .orderBy("stage")
    )


for _fn in (
    customer_journey, channel_ltv_cac, customer_engagement_score, customer_health_score,
    channel_revenue_attribution, customer_metric_card, funnel_stage_counts,
):
    register(_fn.__name__, _fn)
