"""Advocacy metrics: NPS, referrals, UGC, reviews, loyalty, VIPs, mail after purchase."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    CLICKED,
    MAIL_FUNNEL,
    OPENED,
    SENT,
    SOCIAL_PLATFORMS,
    day,
    in_dates,
    in_days,
    mean,
    money,
    ratio,
    ratio0,
    rounded,
    tagged_vip,
)
from tidefunnel.operators.calendar import days_between, running_totals
from tidefunnel.operators.combine import stack_sum
from tidefunnel.operators.gaps import order_days
from tidefunnel.operators.ledger import DayLedger, merged
from tidefunnel.plans.commerce import buyers, paid_orders
from tidefunnel.plans.consideration import is_event, percent
from tidefunnel.plans.retention import EVER, days_before, default_calendar
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

Date = dt.date | None
WEEK = 7


def vip_tier(wh: Warehouse) -> DataFrame:
    return (
        wh.table("loyalty_enrollments")
        .where("loyalty_tier = 'vip'")
        .select(F.col("customer_id").alias("id"), F.lit(True).alias("vip_tier"))
    )


def vips(wh: Warehouse) -> DataFrame:
    """Customers tagged 'VIP' or 'vip', or enrolled in the vip tier."""
    return (
        wh.table("customers")
        .join(vip_tier(wh), "id", "left")
        .where(tagged_vip() | F.coalesce("vip_tier", F.lit(False)))
        .drop("vip_tier")
    )


# --- single metrics ---------------------------------------------------------------


def _score(promoters: Column, detractors: Column, total: Column) -> Column:
    return ratio0(promoters - detractors, total, 2, 100)


def nps(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Share of scores 9-10 less the share of scores 0-6, in percent."""
    score = F.col("nps_score")
    return (
        wh.table("nps_surveys")
        .where(in_dates("survey_date", start, end))
        .agg(
            _score(F.count_if(score >= 9), F.count_if(score <= 6), F.count(score)).alias("nps")
        )
    )


def referral_conversion_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    converted = F.count_if(F.col("referral_status") == "converted")
    return (
        wh.table("referrals")
        .where(in_days("created_at", start, end))
        .agg(ratio0(converted, F.count("*"), 4).alias("referral_conversion_rate"))
    )


def _participation(wh: Warehouse, acts: DataFrame, name: str) -> DataFrame:
    """Share of buyers that occur in ``acts.customer_id``."""
    ids = acts.select(F.col("customer_id").alias("id"), F.lit(1).alias("took_part")).distinct()
    rows = buyers(wh).select("id").join(ids, "id", "left")
    return rows.agg(ratio0(F.count("took_part"), F.count("*"), 4).alias(name))


def ugc_submission_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    acts = wh.table("ugc_submissions").where(in_days("created_at", start, end))
    return _participation(wh, acts, "ugc_submission_rate")


def review_participation_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    acts = wh.table("reviews").where(in_days("created_at", start, end))
    return _participation(wh, acts, "review_participation_rate")


def loyalty_participation_rate(wh: Warehouse) -> DataFrame:
    return _participation(wh, wh.table("loyalty_enrollments"), "loyalty_participation_rate")


def social_engagement_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    acts = wh.table("ugc_submissions").where(
        F.col("platform").isin(*SOCIAL_PLATFORMS) & in_days("created_at", start, end)
    )
    return _participation(wh, acts, "social_engagement_rate")


def _revenue_with_vip(vip_ids: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """Paid revenue and the VIPs' (id) part, per customer first and then per key."""
    spent = orders.groupBy(*keys, F.col("customer_id").alias("id")).agg(
        F.sum("total_price").alias("revenue")
    )
    marked = spent.join(vip_ids.select("id", F.lit(1).alias("vip")), "id", "left")
    sums = [
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(F.col("vip") == 1, F.col("revenue"))).alias("vip_revenue"),
    ]
    return marked.groupBy(*keys).agg(*sums) if keys else marked.agg(*sums)


def vip_revenue_contribution(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    orders = paid_orders(wh).where(in_days("order_date", start, end))
    return _revenue_with_vip(vips(wh), orders, []).select(
        ratio0("vip_revenue", "revenue", 4).alias("vip_revenue_contribution")
    )


def post_purchase_mails(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Mail events sent at most seven days after a paid order of the recipient.

    ``purchase_days`` counts the distinct days with an order in [t - 7 d, t): full days
    in between always count, the first and the last day of the window by their latest
    and first order.  Orders are reduced to one row per customer and day, and those to
    one row per customer and block of seven days, which lists the purchase days of the
    block and of the one before it.  The days of a mail's window lie in these two, so a
    mail event meets at most one row, and a purchase day is handed on twice.  Orders
    more than a week older than the first mail meet none and are left out.
    """
    sent = (
        wh.table("klaviyo_events")
        .where(is_event(*MAIL_FUNNEL) & in_days("occurred_at", start, end))
        .select("profile_id", "event_type", "occurred_at", day("occurred_at").alias("date"))
    )
    people = wh.table("customers").select(F.col("id").alias("customer_id"))
    profiles = (
        wh.table("klaviyo_profiles")
        .select(F.col("id").alias("profile_id"), "customer_id")
        .join(people, "customer_id", "left_semi")
    )
    paid = paid_orders(wh).where(in_days("order_date", start and days_before(start, WEEK), end))
    if start is None:
        paid = paid.where(day("order_date") >= F.date_sub(sent.agg(F.min("date")).scalar(), WEEK))
    block = F.floor(F.unix_date("date") / WEEK)
    around = (
        order_days(paid)
        .select(
            "customer_id",
            F.explode(F.array(block, block + 1)).alias("block"),
            F.struct("date", "first_at", "last_at").alias("bought"),
        )
        .groupBy("customer_id", "block")
        .agg(F.collect_list("bought").alias("bought"))
    )
    t = F.col("occurred_at")

    def counts(bought: Column) -> Column:
        ago = F.datediff("date", bought["date"])
        return (
            F.when(ago == 0, bought["first_at"] < t)
            .when(ago == WEEK, bought["last_at"] >= t - F.expr("interval 7 days"))
            .otherwise(ago.between(1, WEEK - 1))
        )

    return (
        sent.withColumn("block", block)
        .join(profiles, "profile_id")
        .join(around, ["customer_id", "block"])
        .select("event_type", "date", F.size(F.filter("bought", counts)).alias("purchase_days"))
        .where("purchase_days > 0")
    )


def _purchase_days(*names: str) -> Column:
    """Distinct (mail event, purchase day) pairs of some event types."""
    return F.coalesce(F.sum(F.when(is_event(*names), F.col("purchase_days"))), F.lit(0))


def post_purchase_email_open_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return post_purchase_mails(wh, start, end).agg(
        ratio0(_purchase_days(OPENED), _purchase_days(SENT), 4).alias("post_purchase_email_open_rate")
    )


def post_purchase_email_ctr(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return post_purchase_mails(wh, start, end).agg(
        ratio0(_purchase_days(CLICKED), _purchase_days(OPENED), 4).alias("post_purchase_email_ctr")
    )


# --- daily rollup -------------------------------------------------------------------


FIRST_ACTS = ("ugc_people", "social_people", "review_people")


def _acts(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Acts of customers (id); each kind's column holds the day of the act."""
    created, social = day("created_at"), F.col("platform").isin(*SOCIAL_PLATFORMS)
    ugc, reviews = [
        wh.table(name).where(in_days("created_at", start, end)) for name in ("ugc_submissions", "reviews")
    ]
    return ugc.select(
        F.col("customer_id").alias("id"),
        created.alias("ugc_people"),
        F.when(social, created).alias("social_people"),
    ).unionByName(
        reviews.select(F.col("customer_id").alias("id"), created.alias("review_people")), allowMissingColumns=True
    )


def standing(wh: Warehouse) -> DataFrame:
    """What customers are now: one row each, with buyer, member and vip."""
    members = (
        wh.table("loyalty_enrollments")
        .where("customer_id is not null")
        .groupBy(F.col("customer_id").alias("id"))
        .agg(F.lit(True).alias("member"), F.max(F.col("loyalty_tier") == "vip").alias("vip_tier"))
    )
    false = F.lit(False)
    return wh.table("customers").join(members, "id", "left").select(
        "id",
        F.coalesce(F.col("total_orders") > 0, false).alias("buyer"),
        F.coalesce("member", false).alias("member"),
        (tagged_vip() | F.coalesce("vip_tier", false)).alias("vip"),
    )


def _people_changes(now: DataFrame, acts: DataFrame) -> DataFrame:
    """Headcounts per day: people on the day of their first act, others always.

    The running total of first acts is the number of distinct people so far.
    All acts meet the customers as they are now in one join.
    """
    per_person = acts.where("id is not null").groupBy("id").agg(*[F.min(c).alias(c) for c in FIRST_ACTS])
    days = {
        **{c: F.col(c) for c in FIRST_ACTS},
        "member_buyers": F.when(F.col("member"), F.lit(EVER)),
        "buyers": F.lit(EVER),
        "vips": F.when(F.col("vip"), F.lit(EVER)),
    }

    def mark(name: str) -> Column:
        ones = [F.lit(1 if n == name else 0).alias(n) for n in days]
        return F.struct(days[name].alias("date"), *ones)

    return (
        now.where("buyer")
        .join(per_person, "id", "left")
        .select(F.explode(F.array(*[mark(n) for n in days])).alias("m"))
        .select("m.*")
        .where("date is not null")
        .groupBy("date")
        .agg(*[F.sum(n).alias(n) for n in days])
    )


def _fact_changes(wh: Warehouse, start: Date = None, end: Date = None) -> list[DataFrame]:
    """What the rows of each day add, whoever they belong to."""
    score, created = F.col("nps_score"), day("created_at").alias("date")
    social = F.col("platform").isin(*SOCIAL_PLATFORMS)

    def made(name: str) -> DataFrame:
        return wh.table(name).where(in_days("created_at", start, end))

    surveys = wh.table("nps_surveys").where(in_dates("survey_date", start, end))
    return [
        surveys.groupBy(F.col("survey_date").alias("date")).agg(
            F.count("*").alias("responses"),
            F.count_if(score >= 9).alias("promoters"),
            F.count_if(score.between(7, 8)).alias("passives"),
            F.count_if(score <= 6).alias("detractors"),
            F.count(score).alias("scored"),
        ),
        made("referrals").groupBy(created).agg(
            F.count("*").alias("referrals"),
            F.count_if(F.col("referral_status") == "converted").alias("converted"),
        ),
        made("ugc_submissions").groupBy(created).agg(
            F.count("*").alias("ugc"),
            F.count_if(F.col("status") == "approved").alias("ugc_ok"),
            F.count_if(social).alias("social"),
        ),
        made("reviews").groupBy(created).agg(
            F.count("*").alias("reviews"),
            F.sum("rating").alias("rating_sum"),
            F.count("rating").alias("rating_n"),
        ),
        post_purchase_mails(wh, start, end).groupBy("date").agg(
            F.count_if(is_event(SENT)).alias("sent"),
            F.count_if(is_event(OPENED)).alias("opened"),
            F.count_if(is_event(CLICKED)).alias("clicked"),
            _purchase_days(SENT).alias("sent_days"),
            _purchase_days(OPENED).alias("opened_days"),
            _purchase_days(CLICKED).alias("clicked_days"),
        ),
    ]


def _dated_orders(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    orders = paid_orders(wh).where(in_days("order_date", start, end))
    return orders.select("customer_id", "total_price", day("order_date").alias("date"))


def _members(wh: Warehouse) -> DataFrame:
    return wh.table("loyalty_enrollments").agg(F.count("*").alias("members")).select(
        F.lit(EVER).alias("date"), "*"
    )


def advocacy_metrics_daily(wh: Warehouse, calendar: DataFrame | None = None) -> DataFrame:
    """One row per calendar day; every figure is cumulative up to that day.

    Each fact table is counted per day once and summed along the calendar.
    Loyalty and VIP headcounts carry no date and are those of now.
    """
    calendar = default_calendar(wh) if calendar is None else calendar
    return _figures(
        calendar,
        [
            *_fact_changes(wh),
            _people_changes(standing(wh), _acts(wh)),
            _revenue_with_vip(vips(wh), _dated_orders(wh), ["date"]),
            _members(wh),
        ],
    )


def _figures(calendar: DataFrame, parts: list[DataFrame]) -> DataFrame:
    measures = [c for part in parts for c in part.columns if c != "date"]
    totals = running_totals(calendar, stack_sum(["date"], parts, measures), measures)
    return totals.select(
        "date",
        F.col("responses").alias("total_nps_responses"),
        F.col("promoters").alias("promoters_count"),
        F.col("passives").alias("passives_count"),
        F.col("detractors").alias("detractors_count"),
        _score(F.col("promoters"), F.col("detractors"), F.col("scored")).alias("net_promoter_score"),
        F.col("referrals").alias("total_referrals"),
        F.col("converted").alias("referral_conversions"),
        ratio0("converted", "referrals", 4).alias("referral_conversion_rate"),
        F.col("ugc").alias("total_ugc_submissions"),
        F.col("ugc_ok").alias("ugc_approved"),
        ratio0("ugc_people", "buyers", 4).alias("ugc_submission_rate"),
        F.col("reviews").alias("total_reviews"),
        ratio0("review_people", "buyers", 4).alias("review_participation_rate"),
        ratio("rating_sum", "rating_n", 2).alias("avg_review_rating"),
        F.col("members").alias("loyalty_program_members"),
        ratio0("member_buyers", "buyers", 4).alias("loyalty_program_participation_rate"),
        F.col("vips").alias("vip_customers_count"),
        # no row yet gives NULL, as a sum over nothing does
        F.when(F.col("vip_revenue") > 0, money("vip_revenue")).alias("vip_segment_revenue"),
        ratio0("vip_revenue", "revenue", 4).alias("vip_revenue_contribution"),
        F.col("sent").alias("post_purchase_emails_sent"),
        F.col("opened").alias("post_purchase_emails_opened"),
        F.col("clicked").alias("post_purchase_emails_clicked"),
        ratio0("opened_days", "sent_days", 4).alias("post_purchase_email_open_rate"),
        ratio0("clicked_days", "opened_days", 4).alias("post_purchase_email_ctr"),
        F.col("social").alias("social_engagements"),
        ratio0("social_people", "buyers", 4).alias("social_engagement_rate"),
    )


# --- refresh from stored days ----------------------------------------------------------


def day_changes(wh: Warehouse, start: Date, end: Date) -> tuple[DataFrame, DataFrame]:
    """What the days in [start, end] add: one row per day, and acts and orders of customers.

    The latter are not merged yet; the ledger merges them by day or, as history, at once.
    """
    revenue = _dated_orders(wh, start, end)
    parts = [
        *_fact_changes(wh, start, end),
        revenue.groupBy("date").agg(F.sum("total_price").alias("revenue")),
    ]
    measures = [c for part in parts for c in part.columns if c != "date"]
    facts = stack_sum(["date"], parts, measures).where("date is not null")
    spent = revenue.select(F.col("customer_id").alias("id"), "date", F.col("total_price").alias("spent"))
    acts = _acts(wh, start, end)
    dated = acts.withColumn("date", F.coalesce("ugc_people", "review_people"))
    people = dated.unionByName(spent, allowMissingColumns=True).where("id is not null and date is not null")
    return facts, people


def ledger(wh: Warehouse, root: str) -> DayLedger:
    facts, people = day_changes(wh, wh.as_of, wh.as_of)
    merge = {**dict.fromkeys(FIRST_ACTS, F.min), "spent": F.sum}
    return DayLedger(wh.spark, root, facts.schema, merged(people, ["id", "date"], merge).schema, "id", merge)


def advocacy_from_ledger(
    wh: Warehouse, days: DayLedger, start: dt.date, end: dt.date, now: DataFrame | None = None
) -> DataFrame:
    """The rollup of [start, end] from stored days, a checkpoint and the customers of ``now``."""
    now = standing(wh) if now is None else now
    facts, people = days.changes(start, end)
    spent = people.select(F.col("id").alias("customer_id"), F.col("spent").alias("total_price"), "date")
    return _figures(
        days_between(wh.spark, start, end),
        [
            facts,
            _people_changes(now, people.select("id", *FIRST_ACTS)),
            _revenue_with_vip(now.where("vip"), spent, ["date"]).select("date", "vip_revenue"),
            _members(wh),
        ],
    )


def refresh_advocacy(
    wh: Warehouse,
    days: DayLedger,
    start: dt.date,
    end: dt.date,
    every: int = 7,
    now: DataFrame | None = None,
) -> DataFrame:
    """Read the facts of [start, end] and return the rollup rows that follow from them.

    Those are the rows from ``start`` to the newest stored day: a late row moves every
    total behind it, which the stored days give without their facts.  A late order also
    counts for mails of the week after it, so mails of those days are read again.  A row
    that changes later (an order refunded, a referral converted) is a late row of its
    day.  A checkpoint is added when the newest is ``every`` days old.  ``now`` is the
    ``standing`` of the customers, for callers that refresh several times.
    """
    last = max([end, *days.recorded()])
    through = min(end + dt.timedelta(days=7), last)
    days.record(*day_changes(wh, start, through), start, through)
    before = days_before(start, 1)
    newest = max(c for c in days.checkpoints() if c <= before)
    if (before - newest).days >= every:
        days.checkpoint(before)
    return advocacy_from_ledger(wh, days, start, last, now)


# --- customer level and summaries -----------------------------------------------------


def per_customer(df: DataFrame, key: str, **counts: Column) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(*[c.alias(name) for name, c in counts.items()])
    )


def vip_customer_performance(wh: Warehouse) -> DataFrame:
    """VIPs with tier, points and the number of reviews, posts and referrals."""
    reviews = per_customer(wh.table("reviews"), "customer_id", reviews_count=F.count("*"))
    ugc = per_customer(wh.table("ugc_submissions"), "customer_id", ugc_submissions_count=F.count("*"))
    referrals = per_customer(
        wh.table("referrals"),
        "referrer_customer_id",
        referrals_count=F.count("*"),
        referral_conversions=F.count_if(F.col("referral_status") == "converted"),
    )
    tiers = wh.table("loyalty_enrollments").select(
        F.col("customer_id").alias("id"), "loyalty_tier", "points_balance"
    )
    rows = wh.table("customers").join(tiers, "id", "left").where(
        tagged_vip() | F.coalesce(F.col("loyalty_tier") == "vip", F.lit(False))
    )
    counts = ["reviews_count", "ugc_submissions_count", "referrals_count", "referral_conversions"]
    return (
        rows.join(reviews, "id", "left")
        .join(ugc, "id", "left")
        .join(referrals, "id", "left")
        .select(
            F.col("id").alias("customer_id"),
            "email",
            F.col("total_orders").cast("long").alias("total_orders"),
            money("total_revenue").alias("total_revenue"),
            money("average_order_value").alias("average_order_value"),
            "loyalty_tier",
            "points_balance",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
    )


def top_vip_customers(wh: Warehouse, limit: int = 10) -> DataFrame:
    return vip_customer_performance(wh).limit(limit)


def referral_leaderboard(wh: Warehouse) -> DataFrame:
    return (
        wh.table("referrals")
        .groupBy("referrer_customer_id")
        .agg(
            F.count("*").alias("total_referrals"),
            F.count_if(F.col("referral_status") == "converted").alias("conversions"),
        )
        .orderBy(F.desc("conversions"), "referrer_customer_id")
    )


def top_reviewers(wh: Warehouse, limit: int = 10) -> DataFrame:
    reviews = per_customer(
        wh.table("reviews"), "customer_id", review_count=F.count("*"), avg_rating=mean("rating")
    )
    return (
        reviews.join(wh.table("customers").select("id", "email"), "id")
        .orderBy(F.desc("review_count"), "email")
        .limit(limit)
        .select("email", "review_count", rounded("avg_rating", 6).alias("avg_rating"))
    )


def ugc_by_platform(wh: Warehouse) -> DataFrame:
    return (
        wh.table("ugc_submissions")
        .groupBy("platform")
        .agg(
            F.count("*").alias("submissions"),
            F.count_if(F.col("status") == "approved").alias("approved"),
        )
        .orderBy(F.desc("submissions"), "platform")
    )


SUMS = {
    "total_nps_responses": "total_nps_responses",
    "total_referrals": "total_referrals",
    "total_ugc_submissions": "total_ugc_submissions",
    "total_reviews": "total_reviews",
    "total_post_purchase_emails_sent": "post_purchase_emails_sent",
}
MEANS = {
    "avg_nps": "net_promoter_score",
    "avg_referral_conversion_rate": "referral_conversion_rate",
    "avg_ugc_submission_rate": "ugc_submission_rate",
    "avg_review_participation_rate": "review_participation_rate",
    "avg_review_rating": "avg_review_rating",
    "avg_loyalty_participation_rate": "loyalty_program_participation_rate",
    "avg_vip_revenue_contribution": "vip_revenue_contribution",
    "avg_post_purchase_email_open_rate": "post_purchase_email_open_rate",
    "avg_post_purchase_email_ctr": "post_purchase_email_ctr",
    "avg_social_engagement_rate": "social_engagement_rate",
}


def advocacy_metrics_summary(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """Sums of the cumulative counts (days add up by design) and mean rates."""
    daily = advocacy_metrics_daily(wh) if daily is None else daily
    return daily.agg(
        *[F.sum(c).alias(name) for name, c in SUMS.items()],
        rounded(F.sum("vip_segment_revenue"), 2).alias("total_vip_revenue"),
        *[rounded(F.avg(c), 6).alias(name) for name, c in MEANS.items()],
    )


def advocacy_metrics_trends(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    daily = advocacy_metrics_daily(wh) if daily is None else daily
    loyalty = percent("loyalty_program_participation_rate").alias("loyalty_participation_rate_pct")
    return daily.select(
        "date",
        "total_nps_responses",
        "net_promoter_score",
        percent("referral_conversion_rate"),
        percent("ugc_submission_rate"),
        percent("review_participation_rate"),
        "avg_review_rating",
        loyalty,
        percent("vip_revenue_contribution"),
        percent("post_purchase_email_open_rate"),
        percent("post_purchase_email_ctr"),
        percent("social_engagement_rate"),
    ).orderBy(F.desc("date"))


def advocacy_last_7_days(wh: Warehouse) -> DataFrame:
    week = default_calendar(wh).where(F.col("date") >= F.lit(days_before(wh.as_of, 7)))
    return advocacy_metrics_trends(wh, advocacy_metrics_daily(wh, week)).limit(7)


for _fn in (
    nps, referral_conversion_rate, ugc_submission_rate, review_participation_rate,
    vip_revenue_contribution, post_purchase_email_open_rate, post_purchase_email_ctr,
    social_engagement_rate, loyalty_participation_rate, advocacy_metrics_daily,
    advocacy_metrics_summary, advocacy_metrics_trends, advocacy_last_7_days,
    vip_customer_performance, top_vip_customers, referral_leaderboard, top_reviewers,
    ugc_by_platform,
):
    register(_fn.__name__, _fn)
register(
    "nps_last_30_days", lambda wh: nps(wh, start=days_before(wh.as_of, 30), end=wh.as_of)
)
