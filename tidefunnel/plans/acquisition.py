"""Acquisition metrics: ad cost, conversion, traffic sources and their rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    ACQUIRING,
    SUBSCRIBED,
    VIEWED_PAGE,
    day,
    grouped,
    in_days,
    json_text,
    money,
    ratio,
    ratio0,
    rounded,
    span_seconds,
)
from tidefunnel.operators.combine import left_join_spread, stack_sum
from tidefunnel.operators.tables import staged
from tidefunnel.plans.commerce import paid_orders
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

Date = dt.date | None


def ads(wh: Warehouse, platform: str | None = None, start: Date = None, end: Date = None) -> DataFrame:
    df = wh.between("ad_events", "date", start, end)
    return df.where(F.col("platform") == platform) if platform else df


def _keys(platform: str | None) -> list[str]:
    return [] if platform else ["platform"]


def mails_per_customer(wh: Warehouse) -> DataFrame:
    """Mail events and list signups of each customer."""
    return (
        wh.table("klaviyo_events")
        .where("customer_id is not null")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("n_mail"),
            F.count_if(F.col("event_type") == SUBSCRIBED).alias("n_sub"),
        )
    )


def first_timers(wh: Warehouse) -> DataFrame:
    return (
        wh.table("customers")
        .where("is_first_time_customer")
        .select(F.col("id").alias("customer_id"), F.lit(1).alias("first_timer"))
    )


def times_matched(n: str) -> Column:
    """How often a left join against ``n`` partners repeats a row (at least once)."""
    return F.greatest(F.coalesce(F.col(n), F.lit(1)), F.lit(1)).cast("decimal(18,0)")


# --- single metrics ---------------------------------------------------------


def cac(wh: Warehouse, platform: str | None = None, start: Date = None, end: Date = None) -> DataFrame:
    """Spend per distinct customer over conversion and purchase events."""
    df = ads(wh, platform, start, end).where(F.col("event_type").isin(*ACQUIRING))
    return grouped(
        df,
        _keys(platform),
        ratio0(F.sum("spend"), F.countDistinct("customer_id"), 2).alias("cac"),
    )


def ctr(
    wh: Warehouse,
    platform: str | None = None,
    campaign_id: str | None = None,
    start: Date = None,
    end: Date = None,
) -> DataFrame:
    df = ads(wh, platform, start, end).where("impressions > 0")
    if campaign_id is not None:
        df = df.where(F.col("campaign_id") == campaign_id)
    return grouped(
        df, _keys(platform), ratio0(F.sum("clicks"), F.sum("impressions"), 4).alias("ctr")
    )


def cvr(wh: Warehouse, platform: str | None = None, start: Date = None, end: Date = None) -> DataFrame:
    """Distinct first-time customers per click over the 'click' events."""
    keys = _keys(platform)
    clicks = (
        ads(wh, platform, start, end)
        .where("event_type = 'click'")
        .groupBy(*keys, "customer_id")
        .agg(F.sum("clicks").alias("clicks"))
    )
    rows = clicks.join(first_timers(wh), "customer_id", "left")
    return grouped(rows, keys, ratio0(F.count("first_timer"), F.sum("clicks"), 4).alias("cvr"))


def signups_within_week(wh: Warehouse, shown: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct list signups on the seven days from any ad day of the customer.

    ``shown`` has ``keys``, customer_id and date.  Each distinct ad day covers
    its own seven days, so a signup meets the ads by equality on (customer, day)
    and is counted once per group however many ads cover its day.
    """
    covered = (
        shown.where("customer_id is not null")
        .select(*keys, "customer_id", "date")
        .distinct()
        .select(*keys, "customer_id", F.explode(F.expr("sequence(date, date_add(date, 6))")).alias("d"))
        .distinct()
    )
    signups = (
        wh.table("klaviyo_events")
        .where((F.col("event_type") == SUBSCRIBED) & F.col("customer_id").isNotNull())
        .groupBy("customer_id", day("occurred_at").alias("d"))
        .agg(F.count("*").alias("signups"))
    )
    return grouped(
        covered.join(signups, ["customer_id", "d"]), keys, F.sum("signups").alias("signups")
    )


def _spend_and_signups(wh: Warehouse, spent: DataFrame, keys: list[str], fan_out: bool) -> DataFrame:
    """Spend (repeated once per mail event of the customer) and distinct signups."""
    cost = spent.groupBy(*keys, "customer_id").agg(F.sum("spend").alias("spend"))
    if fan_out:
        cost = cost.join(mails_per_customer(wh), "customer_id", "left").withColumn(
            "spend", F.col("spend") * times_matched("n_mail")
        )
    return stack_sum(
        keys,
        [cost.select(*keys, "spend"), signups_within_week(wh, spent, keys)],
        ["spend", "signups"],
    )


def cost_per_signup(
    wh: Warehouse,
    platform: str | None = None,
    start: Date = None,
    end: Date = None,
    fan_out: bool = True,
) -> DataFrame:
    """Spend per list signup in the seven days from an ad.

    The established figure repeats the spend for every mail event of the
    customer; ``fan_out=False`` gives the plain spend.
    """
    keys = _keys(platform)
    spent = ads(wh, platform, start, end).where("spend > 0")
    both = _spend_and_signups(wh, spent, keys, fan_out)
    return both.select(*keys, ratio0("spend", "signups", 2).alias("cost_per_signup"))


def cost_per_signup_by_campaign(wh: Warehouse, fan_out: bool = True) -> DataFrame:
    keys = ["platform", "campaign_id"]
    both = _spend_and_signups(wh, ads(wh).where("spend > 0"), keys, fan_out)
    return both.select(*keys, ratio("spend", "signups", 6).alias("cost_per_signup"))


def _sessions_and_signups(wh: Warehouse, views: DataFrame) -> DataFrame:
    """One row: distinct sessions, and distinct signups (ever) of their customers."""
    people = wh.table("customers").select(F.col("id").alias("customer_id"))
    viewers = (
        views.where("customer_id is not null")
        .select("customer_id")
        .distinct()
        .join(people, "customer_id", "left_semi")
        .join(mails_per_customer(wh), "customer_id")
        .agg(F.sum("n_sub").alias("signups"))
    )
    sessions = views.agg(F.countDistinct("session_id").alias("sessions"))
    return stack_sum([], [sessions, viewers], ["sessions", "signups"]).select(
        "sessions", F.coalesce("signups", F.lit(0)).alias("signups")
    )


def session_to_signup_ratio(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Distinct signups (without a date filter) per distinct page-view session."""
    views = wh.table("shopify_events").where(
        (F.col("event_type") == "page_viewed") & in_days("occurred_at", start, end)
    )
    return _sessions_and_signups(wh, views).select(
        ratio0("signups", "sessions", 4).alias("session_to_signup_ratio")
    )


def viewed_sessions(wh: Warehouse, event_type: str, start: Date = None, end: Date = None) -> DataFrame:
    """Per session: number of events of one type and the seconds they span."""
    return (
        wh.table("shopify_events")
        .where(
            (F.col("event_type") == event_type)
            & F.col("session_id").isNotNull()
            & in_days("occurred_at", start, end)
        )
        .groupBy("session_id")
        .agg(
            F.count("*").alias("views"),
            span_seconds(F.min("occurred_at"), F.max("occurred_at")).alias("seconds"),
        )
    )


BOUNCED = "views = 1 or seconds < 30"


def bounce_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Share of page-view sessions with one view or less than 30 seconds."""
    return viewed_sessions(wh, "page_viewed", start, end).agg(
        ratio0(F.count_if(F.expr(BOUNCED)), F.count("*"), 4).alias("bounce_rate")
    )


def bounce_breakdown(wh: Warehouse) -> DataFrame:
    bounced = F.count_if(F.expr(BOUNCED))
    return viewed_sessions(wh, "page_viewed").agg(
        bounced.alias("bounced_sessions"),
        F.count("*").alias("total_sessions"),
        ratio(bounced, F.count("*"), 6, 100).alias("bounce_rate_percentage"),
    )


def revenue_over_ad_rows(wh: Warehouse, shown: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of customer revenue over ad-event rows, and the number of those rows."""
    touched = (
        shown.where("customer_id is not null")
        .groupBy(*keys, F.col("customer_id").alias("id"))
        .agg(F.count("*").alias("rows"))
    )
    people = wh.table("customers").select("id", "total_revenue")
    return grouped(
        touched.join(people, "id"),
        keys,
        F.sum(F.col("total_revenue") * F.col("rows").cast("decimal(12,0)")).alias("ltv_sum"),
        # AVG skips customers without a revenue figure
        F.sum(F.when(F.col("total_revenue").isNotNull(), F.col("rows"))).alias("ltv_rows"),
    )


def _channel_costs_and_value(
    wh: Warehouse, platform: str | None, cost_rows: DataFrame, value_rows: DataFrame
) -> DataFrame:
    keys = _keys(platform)
    cost = grouped(
        cost_rows,
        keys,
        F.sum("spend").alias("spend"),
        F.countDistinct("customer_id").alias("customers"),
    )
    return stack_sum(
        keys,
        [cost, revenue_over_ad_rows(wh, value_rows, keys)],
        ["spend", "customers", "ltv_sum", "ltv_rows"],
    ).select(
        *keys,
        "customers",
        "spend",
        F.try_divide(F.col("spend").cast("double"), F.col("customers").cast("double")).alias("cac"),
        F.try_divide(F.col("ltv_sum").cast("double"), F.col("ltv_rows").cast("double")).alias("ltv"),
    )


def ltv_cac_ratio(wh: Warehouse, platform: str | None = None) -> DataFrame:
    """Mean customer revenue over all ad rows, per acquisition cost; all time."""
    rows = ads(wh, platform)
    both = _channel_costs_and_value(
        wh, platform, rows.where(F.col("event_type").isin(*ACQUIRING)), rows
    )
    return both.select(*_keys(platform), ratio0("ltv", "cac", 2).alias("ltv_cac_ratio"))


def source_roi_summary(wh: Warehouse) -> DataFrame:
    """CAC, mean LTV and their ratio over acquiring events of known customers."""
    rows = ads(wh).where(F.col("event_type").isin(*ACQUIRING) & F.col("customer_id").isNotNull())
    return (
        _channel_costs_and_value(wh, None, rows, rows)
        .where("ltv is not null")
        .select(
            "platform",
            F.col("customers").alias("customers_acquired"),
            rounded("cac", 6).alias("cac"),
            rounded("ltv", 6).alias("avg_ltv"),
            F.when(F.col("cac") > 0, ratio0("ltv", "cac", 6)).otherwise(0.0).alias("ltv_cac_ratio"),
        )
    )


def source_roi_ranked(wh: Warehouse) -> DataFrame:
    rows = ads(wh)
    acquiring = rows.where(F.col("event_type").isin(*ACQUIRING))
    return (
        _channel_costs_and_value(wh, None, acquiring, rows)
        .where("ltv is not null and spend is not null")
        .select(
            "platform",
            rounded("cac", 2).alias("cac"),
            rounded("ltv", 2).alias("avg_ltv"),
            ratio("ltv", "cac", 2).alias("ltv_cac_ratio"),
        )
        .orderBy(F.desc("ltv_cac_ratio"), "platform")
    )


# --- simple groupings of the ad events --------------------------------------


def cac_by_platform(wh: Warehouse) -> DataFrame:
    return (
        ads(wh)
        .where(F.col("event_type").isin(*ACQUIRING))
        .groupBy("platform")
        .agg(ratio(F.sum("spend"), F.countDistinct("customer_id"), 6).alias("cac"))
    )


def _ad_ratio(
    wh: Warehouse, keys: list[str], where: str, a: str, b: str, scale: int, times: float, name: str
) -> DataFrame:
    return ads(wh).where(where).groupBy(*keys).agg(ratio(F.sum(a), F.sum(b), scale, times).alias(name))


def ctr_by_platform(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, ["platform"], "impressions > 0", "clicks", "impressions", 2, 100, "ctr_percentage")


def cpc_by_platform(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, ["platform"], "clicks > 0", "spend", "clicks", 2, 1, "cpc")


def cpm_by_platform(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, ["platform"], "impressions > 0", "spend", "impressions", 2, 1000, "cpm")


def roas_by_platform(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, ["platform"], "spend > 0", "revenue", "spend", 2, 1, "roas")


CAMPAIGN = ["platform", "campaign_id"]


def ctr_by_campaign(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, CAMPAIGN, "impressions > 0", "clicks", "impressions", 6, 100, "ctr_percentage")


def cpc_by_campaign(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, CAMPAIGN, "clicks > 0", "spend", "clicks", 6, 1, "cpc")


def cpm_by_campaign(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, CAMPAIGN, "impressions > 0", "spend", "impressions", 6, 1000, "cpm")


def roas_by_campaign(wh: Warehouse) -> DataFrame:
    return _ad_ratio(wh, CAMPAIGN, "spend > 0", "revenue", "spend", 6, 1, "roas")


def cpc_per_event(wh: Warehouse) -> DataFrame:
    return (
        ads(wh)
        .where("clicks > 0")
        .select("id", "platform", "campaign_id", ratio("spend", "clicks", 6).alias("cpc"))
    )


def cac_conversion_only(wh: Warehouse) -> DataFrame:
    """All conversion spend (also without a customer) per distinct customer."""
    return (
        ads(wh)
        .where("event_type = 'conversion'")
        .agg(ratio(F.sum("spend"), F.countDistinct("customer_id"), 6).alias("cac"))
    )


def ad_daily_by_platform(wh: Warehouse) -> DataFrame:
    return (
        ads(wh)
        .groupBy("date", "platform")
        .agg(
            money(F.sum("spend")).alias("total_spend"),
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
            money(F.sum("revenue")).alias("total_revenue"),
            ratio(F.sum("spend"), F.sum("clicks"), 6).alias("cpc"),
            ratio(F.sum("clicks"), F.sum("impressions"), 6, 100).alias("ctr"),
            ratio(F.sum("revenue"), F.sum("spend"), 6).alias("roas"),
        )
    )


def _spend_revenue_roas(df: DataFrame) -> DataFrame:
    return df.groupBy("platform").agg(
        money(F.sum("spend")).alias("total_spend"),
        money(F.sum("revenue")).alias("total_revenue"),
        ratio0(F.sum("revenue"), F.sum("spend"), 6).alias("roas"),
    )


def roas_last_30_days(wh: Warehouse) -> DataFrame:
    recent = ads(wh, start=wh.as_of - dt.timedelta(days=30))
    return _spend_revenue_roas(recent).orderBy(F.desc("roas"), "platform")


def ad_platform_performance(wh: Warehouse) -> DataFrame:
    return _spend_revenue_roas(ads(wh))


def cvr_ad_to_customer(wh: Warehouse) -> DataFrame:
    """Distinct clicking customers whose source is 'ad', per click, in percent."""
    clicks = (
        ads(wh)
        .where("event_type = 'click'")
        .groupBy("platform", F.col("customer_id").alias("id"))
        .agg(F.sum("clicks").alias("clicks"))
    )
    from_ads = wh.table("customers").where("source = 'ad'").select("id", F.lit(1).alias("from_ad"))
    return (
        clicks.join(from_ads, "id", "left")
        .groupBy("platform")
        .agg(ratio(F.count("from_ad"), F.sum("clicks"), 6, 100).alias("cvr_percentage"))
    )


def cvr_ad_to_signup(wh: Warehouse, fan_out: bool = True) -> DataFrame:
    """Distinct signups of clicking customers per click, in percent.

    Clicks are repeated once per mail event of the customer unless
    ``fan_out=False``.
    """
    clicks = (
        ads(wh)
        .where("event_type = 'click'")
        .groupBy("platform", "customer_id")
        .agg(F.sum("clicks").alias("clicks"))
        .join(mails_per_customer(wh), "customer_id", "left")
    )
    weight = times_matched("n_mail") if fan_out else F.lit(1)
    return clicks.groupBy("platform").agg(
        ratio(
            F.coalesce(F.sum("n_sub"), F.lit(0)), F.sum(F.col("clicks") * weight), 6, 100
        ).alias("signup_cvr_percentage")
    )


def cost_per_lead(wh: Warehouse) -> DataFrame:
    """Spend per distinct first-time customer over acquiring events."""
    spent = (
        ads(wh)
        .where(F.col("event_type").isin(*ACQUIRING))
        .groupBy("platform", "customer_id")
        .agg(F.sum("spend").alias("spend"))
    )
    return (
        spent.join(first_timers(wh), "customer_id", "left")
        .groupBy("platform")
        .agg(ratio(F.sum("spend"), F.count("first_timer"), 6).alias("cost_per_lead"))
    )


# --- traffic, signups, new customers ----------------------------------------


def orders_by_source(wh: Warehouse) -> DataFrame:
    return (
        paid_orders(wh)
        .groupBy("source")
        .agg(F.count("*").alias("order_count"), money(F.sum("total_price")).alias("revenue"))
    )


def new_vs_returning(wh: Warehouse) -> DataFrame:
    first = F.col("is_first_time_customer")
    return wh.table("customers").agg(
        F.count_if(first).alias("new_customers"),
        F.count_if(~first).alias("returning_customers"),
        F.count("*").alias("total_customers"),
    )


def traffic_by_referrer(wh: Warehouse) -> DataFrame:
    tags = ["referrer", "utm_source", "utm_medium"]
    return (
        wh.table("shopify_events")
        .where("event_type in ('page_viewed', 'product_viewed')")
        .select(F.json_tuple("event_properties", *tags).alias("source", *tags[1:]))
        .groupBy("source", *tags[1:])
        .agg(F.count("*").alias("traffic_count"))
    )


def new_customers_by_date(wh: Warehouse) -> DataFrame:
    return (
        wh.table("customers")
        .groupBy(day("created_at").alias("signup_date"))
        .agg(F.count_if("is_first_time_customer").alias("new_customers"))
        .orderBy(F.desc("signup_date"))
    )


def email_signup_rate(wh: Warehouse, days: int = 30) -> DataFrame:
    signups = F.count_if(F.col("event_type") == SUBSCRIBED)
    views = F.count_if(F.col("event_type") == VIEWED_PAGE)
    return (
        wh.table("klaviyo_events")
        .where(in_days("occurred_at", wh.as_of - dt.timedelta(days=days), None))
        .agg(
            signups.alias("signups"),
            views.alias("page_views"),
            ratio(signups, views, 6, 100).alias("signup_rate"),
        )
    )


def signups_by_source(wh: Warehouse) -> DataFrame:
    return (
        wh.table("klaviyo_events")
        .where(F.col("event_type") == SUBSCRIBED)
        .groupBy(json_text("event_properties", "source").alias("signup_source"))
        .agg(F.count("*").alias("signups"))
    )


def session_signup_30d(wh: Warehouse) -> DataFrame:
    views = wh.table("shopify_events").where(
        (F.col("event_type") == "page_viewed")
        & in_days("occurred_at", wh.as_of - dt.timedelta(days=30), None)
    )
    return _sessions_and_signups(wh, views).select(
        F.col("sessions").alias("total_sessions"),
        "signups",
        ratio("signups", "sessions", 6, 100).alias("session_to_signup_ratio"),
    )


# --- daily rollups ------------------------------------------------------------


def web_by_session(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Web events per (date, session, customer), pre-aggregated before any join."""
    return (
        wh.table("shopify_events")
        .where(in_days("occurred_at", start, end))
        .groupBy(day("occurred_at").alias("date"), "session_id", "customer_id")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("event_type") == "page_viewed").alias("page_views"),
            F.min("occurred_at").alias("first_at"),
            F.max("occurred_at").alias("last_at"),
        )
    )


def sessions_per_day(web: DataFrame) -> DataFrame:
    """Per (date, session): page views and the range of customers."""
    return (
        web.where("session_id is not null")
        .groupBy("date", "session_id")
        .agg(
            F.sum("page_views").alias("page_views"),
            F.min("customer_id").alias("lo"),
            F.max("customer_id").alias("hi"),
        )
    )


def mails_per_day(wh: Warehouse, start: Date, end: Date) -> DataFrame:
    return (
        wh.table("klaviyo_events")
        .where(F.col("customer_id").isNotNull() & in_days("occurred_at", start, end))
        .groupBy("customer_id", day("occurred_at").alias("date"))
        .agg(
            F.count("*").alias("n_mail"),
            F.count_if(F.col("event_type") == SUBSCRIBED).alias("n_sub"),
        )
    )


def acquisition_metrics_daily(
    wh: Warehouse, start: Date = None, end: Date = None, fan_out: bool = True
) -> DataFrame:
    """Ad performance per (platform, campaign, date) for all days at once.

    Ad rows, mail events and web events of a customer and day are not joined
    with each other; each is reduced to one row per customer and day first.
    ``fan_out=True`` multiplies the ad sums by the number of rows that the
    three-way join would have made.  Distinct sessions are added up per
    customer; only sessions that several customers share need a real distinct.
    """
    keys = ["platform", "campaign_id", "date"]
    sums = ["spend", "impressions", "clicks", "conversions", "revenue"]
    shown = (
        ads(wh, start=start, end=end)
        .groupBy(*keys, "customer_id")
        .agg(*[F.sum(s).cast("decimal(20,2)").alias(s) for s in sums])
    )
    people = wh.table("customers").select(
        F.col("id").alias("customer_id"),
        F.coalesce("is_first_time_customer", F.lit(False)).alias("first_time"),
    )
    # read by three branches below
    web = staged(
        web_by_session(wh, start, end).drop("first_at", "last_at"), "web-by-session"
    )
    sessions = sessions_per_day(web)
    per_customer = stack_sum(
        ["customer_id", "date"],
        [
            mails_per_day(wh, start, end),
            web.where("customer_id is not null").select(
                "customer_id", "date", F.col("events").alias("n_web")
            ),
            sessions.where("lo = hi").select(
                F.col("lo").alias("customer_id"),
                "date",
                F.lit(1).alias("own_sessions"),
                (F.col("page_views") == 1).cast("int").alias("own_bounced"),
            ),
        ],
        ["n_mail", "n_sub", "n_web", "own_sessions", "own_bounced"],
    )
    known = left_join_spread(
        shown, people, ["customer_id"], nullable="customer_id", spread_by="campaign_id"
    )
    rows = left_join_spread(
        known, per_customer, ["customer_id", "date"], nullable="customer_id", spread_by="campaign_id"
    )
    # ids that are no known customer meet no events
    is_known = F.col("first_time").isNotNull()
    weight = F.lit(1).cast("decimal(18,0)")
    if fan_out:
        weight = F.when(is_known, times_matched("n_mail") * times_matched("n_web")).otherwise(weight)
    own = rows.select(
        *keys,
        *[(F.col(s) * weight).alias(s) for s in sums],
        F.col("first_time").cast("int").alias("new_customers"),
        F.when(is_known, F.col("n_sub")).alias("signups"),
        F.when(is_known, F.col("own_sessions")).alias("sessions"),
        F.when(is_known, F.col("own_bounced")).alias("bounced"),
    )
    shared_sessions = sessions.where("lo <> hi").select("date", "session_id", "page_views")
    shared = (
        web.where("customer_id is not null")
        .select("date", "session_id", "customer_id")
        .join(shared_sessions, ["date", "session_id"])
        .join(known.where("first_time is not null").select(*keys, "customer_id"), ["customer_id", "date"])
        .groupBy(*keys, "session_id")
        .agg(F.max((F.col("page_views") == 1).cast("int")).alias("bounced"))
        .select(*keys, F.lit(1).alias("sessions"), "bounced")
    )
    counts = ["new_customers", "signups", "sessions", "bounced"]
    total = stack_sum(keys, [own, shared], [*sums, *counts])
    total = total.select(
        *keys, *sums, *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in counts]
    )
    return total.select(
        *keys,
        money("spend").alias("total_spend"),
        F.col("impressions").cast("long").alias("total_impressions"),
        F.col("clicks").cast("long").alias("total_clicks"),
        F.col("conversions").cast("long").alias("total_conversions"),
        money("revenue").alias("total_revenue"),
        ratio("spend", "clicks", 4).alias("cpc"),
        ratio("spend", "impressions", 4, 1000).alias("cpm"),
        ratio("clicks", "impressions", 4).alias("ctr"),
        ratio("conversions", "clicks", 4).alias("cvr"),
        ratio("revenue", "spend", 2).alias("roas"),
        F.col("new_customers").alias("new_customers_count"),
        F.col("signups").alias("email_signups_count"),
        ratio("spend", "new_customers", 2).alias("cost_per_customer"),
        ratio("spend", "signups", 2).alias("cost_per_signup"),
        F.col("sessions").alias("sessions_count"),
        F.col("bounced").alias("bounced_sessions_count"),
        ratio("bounced", "sessions", 4).alias("bounce_rate"),
        ratio("signups", "sessions", 4).alias("session_to_signup_ratio"),
    )


TRAFFIC_KEYS = ["source", "utm_source", "utm_medium", "utm_campaign", "date"]


def traffic_source_metrics_daily(
    wh: Warehouse, start: Date = None, end: Date = None, fan_out: bool = True
) -> DataFrame:
    """Sessions, signups, orders and revenue per traffic source and day.

    The source of a web event is that of the customer's orders on the day (one
    row per order), else its referrer, else 'direct'.  Web events are reduced
    to (customer, session, tags) and orders to (customer, source) per day
    before they meet; mail events only enter as a count.
    """
    tags = ["utm_source", "utm_medium", "utm_campaign"]
    events = wh.between("shopify_events", "occurred_at", start, end)
    web = (
        events.select(
            day("occurred_at").alias("date"),
            "session_id",
            "customer_id",
            (F.col("event_type") == "page_viewed").alias("is_view"),
            # one parse of the JSON for all four keys
            F.json_tuple("event_properties", "referrer", *tags).alias("referrer", *tags),
        )
        .groupBy("date", "session_id", "customer_id", "referrer", *tags)
        .agg(F.count("*").alias("events"), F.count_if("is_view").alias("views"))
    )
    sessions = (
        events.where("session_id is not null")
        .groupBy(day("occurred_at").alias("date"), "session_id")
        .agg(
            span_seconds(F.min("occurred_at"), F.max("occurred_at")).alias("seconds"),
            (F.count_if(F.col("event_type") == "page_viewed") == 1).cast("int").alias("bounced"),
        )
    )
    orders = (
        wh.table("shopify_orders")
        .where(F.col("customer_id").isNotNull() & in_days("order_date", start, end))
        .groupBy("customer_id", day("order_date").alias("date"), F.col("source").alias("order_source"))
        .agg(
            F.count("*").alias("n_orders"),
            F.count_if(F.col("financial_status") == "paid").alias("n_paid"),
            F.sum(F.when(F.col("financial_status") == "paid", F.col("total_price"))).alias("paid"),
        )
    )
    people = wh.table("customers").select(F.col("id").alias("customer_id"))
    # one small row per customer and day: mail counts and orders by source
    per_day = (
        mails_per_day(wh, start, end)
        .join(
            orders.groupBy("customer_id", "date").agg(
                # at most one entry per order source, not per order
                F.collect_list(F.struct("order_source", "n_orders", "n_paid", "paid")).alias("bought")
            ),
            ["customer_id", "date"],
            "full_outer",
        )
        .join(people, "customer_id", "left_semi")
    )
    joined = left_join_spread(
        web, per_day, ["customer_id", "date"], nullable="customer_id", spread_by="session_id"
    )
    joined = left_join_spread(
        joined, sessions, ["date", "session_id"], nullable="session_id", spread_by="customer_id"
    )
    joined = joined.select("*", F.explode_outer("bought").alias("b")).select(
        F.coalesce("b.order_source", "referrer", F.lit("direct")).alias("source"),
        *tags,
        "date",
        "session_id",
        "customer_id",
        F.col("b.order_source").alias("order_source"),
        "events",
        "views",
        "seconds",
        "bounced",
        "n_sub",
        F.coalesce("b.n_orders", F.lit(1)).alias("n_orders"),
        F.coalesce("b.n_paid", F.lit(0)).alias("n_paid"),
        F.col("b.paid").alias("paid"),
        (times_matched("n_mail") if fan_out else F.lit(1).cast("decimal(18,0)")).alias("w"),
    )
    repeats = F.col("n_orders") * F.col("w") if fan_out else F.lit(1)
    paid_times = F.col("events") * F.col("w") if fan_out else F.lit(1)
    timed = F.col("seconds").isNotNull()
    # Each row counts towards its customer (signups and orders once per customer
    # and order source) and towards its session.  Both views of the row are put
    # through one aggregation instead of joining everything twice.
    none = F.lit(None)
    row_sums = {
        "page_views": (F.col("views") * repeats).cast("decimal(38,0)"),
        "revenue": (F.col("paid") * paid_times.cast("decimal(16,0)")).cast("decimal(38,2)"),
        "seconds": F.when(timed, F.col("events") * repeats * F.col("seconds")).cast("double"),
        "timed_rows": F.when(timed, F.col("events") * repeats).cast("decimal(38,0)"),
    }
    once = ["paid", "n_sub", "n_paid", "bounced"]

    def view(of_session: bool) -> Column:
        own = F.lit(of_session)
        return F.struct(
            own.alias("of_session"),
            F.when(own, F.col("session_id")).alias("session_id"),
            F.when(~own, F.col("customer_id")).alias("customer_id"),
            F.when(~own, F.col("order_source")).alias("order_source"),
            *[F.when(~own, c).alias(name) for name, c in row_sums.items()],
            *[(F.col(c) if (c == "bounced") == of_session else none.cast(joined.schema[c].dataType)).alias(c) for c in once],
        )

    grouped_once = (
        joined.select(*TRAFFIC_KEYS, F.explode(F.array(view(True), view(False))).alias("v"))
        .select(*TRAFFIC_KEYS, "v.*")
        .where("not of_session or session_id is not null")
        .groupBy(*TRAFFIC_KEYS, "of_session", "session_id", "customer_id", "order_source")
        .agg(*[F.sum(c).alias(c) for c in row_sums], *[F.max(c).alias(c) for c in once])
        .groupBy(*TRAFFIC_KEYS, "of_session", "session_id", "customer_id")
        .agg(
            *[F.sum(c).alias(c) for c in row_sums],
            F.sum("paid").alias("paid_once"),
            F.max("n_sub").alias("signups"),
            F.sum("n_paid").alias("orders"),
            F.max("bounced").alias("bounced"),
        )
    )
    total = grouped_once.groupBy(*TRAFFIC_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("page_views", "seconds", "timed_rows", "signups", "orders", "bounced")],
        F.sum("revenue" if fan_out else "paid_once").alias("revenue"),
        F.count_if("of_session").alias("sessions"),
        F.count("customer_id").alias("visitors"),
    )
    measures = ["sessions", "page_views", "visitors", "bounced", "signups", "orders"]
    count = {m: F.coalesce(F.col(m).cast("long"), F.lit(0)) for m in measures}
    return total.select(
        *TRAFFIC_KEYS,
        count["sessions"].alias("sessions_count"),
        count["page_views"].alias("page_views_count"),
        count["visitors"].alias("unique_visitors_count"),
        count["bounced"].alias("bounced_sessions_count"),
        ratio("seconds", "timed_rows", 0).cast("long").alias("avg_session_duration_seconds"),
        count["signups"].alias("signups_count"),
        count["orders"].alias("orders_count"),
        F.coalesce(money("revenue"), F.lit(0.0)).alias("revenue"),
        ratio(count["bounced"], "sessions", 4).alias("bounce_rate"),
        ratio(count["signups"], "sessions", 4).alias("signup_rate"),
        ratio(count["orders"], "sessions", 4).alias("conversion_rate"),
    )


# --- summaries over the rollups ----------------------------------------------


def acquisition_metrics_summary(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    daily = acquisition_metrics_daily(wh) if daily is None else daily
    totals = {
        "total_spend": "total_spend",
        "total_impressions": "total_impressions",
        "total_clicks": "total_clicks",
        "total_conversions": "total_conversions",
        "total_revenue": "total_revenue",
        "total_new_customers": "new_customers_count",
        "total_signups": "email_signups_count",
    }
    sums = daily.groupBy("platform").agg(*[F.sum(c).alias(name) for name, c in totals.items()])
    return sums.select(
        "platform",
        *[
            (rounded(n, 2) if n in ("total_spend", "total_revenue") else F.col(n)).alias(n)
            for n in totals
        ],
        ratio0("total_spend", "total_clicks", 6).alias("avg_cpc"),
        ratio0("total_spend", "total_impressions", 6, 1000).alias("avg_cpm"),
        ratio0("total_clicks", "total_impressions", 6).alias("avg_ctr"),
        ratio0("total_conversions", "total_clicks", 6).alias("avg_cvr"),
        ratio0("total_revenue", "total_spend", 6).alias("avg_roas"),
        ratio0("total_spend", "total_new_customers", 6).alias("avg_cac"),
    )


def traffic_source_summary(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """Totals per raw (source, utm_source, utm_medium), labelled afterwards."""
    daily = traffic_source_metrics_daily(wh) if daily is None else daily
    totals = daily.groupBy("source", "utm_source", "utm_medium").agg(
        F.sum("sessions_count").alias("total_sessions"),
        F.sum("page_views_count").alias("total_page_views"),
        F.sum("signups_count").alias("total_signups"),
        F.sum("orders_count").alias("total_orders"),
        rounded(F.sum("revenue"), 2).alias("total_revenue"),
        rounded(F.avg("bounce_rate"), 6).alias("avg_bounce_rate"),
        rounded(F.avg("signup_rate"), 6).alias("avg_signup_rate"),
        rounded(F.avg("conversion_rate"), 6).alias("avg_conversion_rate"),
        ratio0(F.sum("signups_count"), F.sum("sessions_count"), 6).alias("session_to_signup_ratio"),
    )
    return totals.withColumns(
        {
            "utm_source": F.coalesce("utm_source", F.lit("unknown")),
            "utm_medium": F.coalesce("utm_medium", F.lit("unknown")),
        }
    )


def acquisition_last_7_days(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    since = wh.as_of - dt.timedelta(days=7)
    daily = acquisition_metrics_daily(wh, start=since) if daily is None else daily
    return (
        daily.where(F.col("date") >= F.lit(since))
        .select(
            "date",
            "platform",
            "campaign_id",
            "total_spend",
            "total_clicks",
            "total_conversions",
            "total_revenue",
            rounded("cpc", 2).alias("cpc"),
            rounded(F.col("ctr") * 100, 2).alias("ctr_pct"),
            rounded("roas", 2).alias("roas"),
        )
        .orderBy(F.desc("date"), "platform", "campaign_id")
    )


def top_traffic_sources(
    wh: Warehouse, by: str = "total_revenue", limit: int | None = 10
) -> DataFrame:
    """Best sources by revenue; ``by='total_signups'`` lists those with signups."""
    rows = traffic_source_summary(wh)
    if by == "total_signups":
        rows = rows.where("total_signups > 0")
    rows = rows.orderBy(F.desc(by), "source", "utm_source", "utm_medium")
    return rows.limit(limit) if limit else rows


def best_platform_by_roas(wh: Warehouse) -> DataFrame:
    return acquisition_metrics_summary(wh).orderBy(F.desc("avg_roas"), "platform").limit(1)


def _last_30(wh: Warehouse) -> tuple[dt.date, dt.date]:
    return wh.as_of - dt.timedelta(days=30), wh.as_of


def _ranged(fn):
    """The metric over the customary last 30 days."""

    def plan(wh: Warehouse) -> DataFrame:
        start, end = _last_30(wh)
        return fn(wh, start=start, end=end)

    return plan


for _fn in (cac, ctr, cvr, cost_per_signup, session_to_signup_ratio, bounce_rate):
    register(_fn.__name__, _ranged(_fn))
for _fn in (
    ltv_cac_ratio, acquisition_metrics_daily, traffic_source_metrics_daily,
    acquisition_metrics_summary, traffic_source_summary, source_roi_summary, cac_by_platform,
    ctr_by_platform, cpc_by_platform, cpm_by_platform, roas_by_platform, orders_by_source,
    new_vs_returning, source_roi_ranked, acquisition_last_7_days, top_traffic_sources,
    best_platform_by_roas, ctr_by_campaign, cpc_by_campaign, cpm_by_campaign, roas_by_campaign,
    cvr_ad_to_customer, cvr_ad_to_signup, cost_per_signup_by_campaign, cost_per_lead,
    traffic_by_referrer, new_customers_by_date, email_signup_rate, signups_by_source,
    session_signup_30d, bounce_breakdown, ad_daily_by_platform, roas_last_30_days, cpc_per_event,
    cac_conversion_only, ad_platform_performance,
):
    register(_fn.__name__, _fn)
register("top_signup_sources", lambda wh: top_traffic_sources(wh, "total_signups", None))
