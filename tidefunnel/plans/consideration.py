"""Consideration metrics: web sessions, carts, mail engagement, repeat visits.

These metrics say ``add_to_cart`` and ``add_to_wishlist`` where the base views
say ``cart_added``; both words occur in the data and are kept apart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    CLICKED,
    OPENED,
    SENT,
    day,
    in_dates,
    json_text,
    ratio,
    ratio0,
    rounded,
    span_seconds,
)
from tidefunnel.operators.calendar import source_range
from tidefunnel.operators.combine import left_join_spread, stack_sum
from tidefunnel.operators.daymaps import DayMaps
from tidefunnel.operators.tables import staged
from tidefunnel.plans.acquisition import BOUNCED, viewed_sessions
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse

Date = dt.date | None

CART = "add_to_cart"
WISH = "add_to_wishlist"


def seconds() -> Column:
    return span_seconds("first_at", "last_at")


def web_events(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return wh.between("shopify_events", "occurred_at", start, end)


def mail_events(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return wh.between("klaviyo_events", "occurred_at", start, end)


def is_event(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def sessions_with(df: DataFrame, **kinds: tuple[str, ...]) -> DataFrame:
    """One row: number of sessions that hold any event of each kind.

    One pass of session flags replaces one distinct count per kind.
    """
    flags = df.where("session_id is not null").groupBy("session_id").agg(
        *[F.max(is_event(*names).cast("int")).alias(kind) for kind, names in kinds.items()]
    )
    return flags.agg(*[F.sum(kind).alias(kind) for kind in kinds])


# --- single metrics -----------------------------------------------------------


def add_to_cart_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return sessions_with(
        web_events(wh, start, end), carts=(CART,), views=("product_viewed",)
    ).select(ratio0("carts", "views", 4).alias("add_to_cart_rate"))


def view_to_add_to_cart_ratio(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return web_events(wh, start, end).agg(
        ratio0(F.count_if(is_event(CART)), F.count_if(is_event("product_viewed")), 4).alias(
            "view_to_add_to_cart_ratio"
        )
    )


def product_view_depth(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Mean number of viewed pages per session."""
    return viewed_sessions(wh, "page_viewed", start, end).agg(
        ratio0(F.sum("views"), F.count("*"), 2).alias("product_view_depth")
    )


def session_spans(wh: Warehouse, keys: list[str], start: Date = None, end: Date = None) -> DataFrame:
    return (
        web_events(wh, start, end)
        .where("session_id is not null")
        .groupBy(*keys)
        .agg(span_seconds(F.min("occurred_at"), F.max("occurred_at")).alias("seconds"))
    )


def avg_session_duration(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    spans = session_spans(wh, ["session_id"], start, end)
    return spans.agg(
        F.coalesce(rounded(F.avg("seconds"), 0), F.lit(0.0)).cast("int").alias("avg_session_duration")
    )


def avg_scroll_depth(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    depth = json_text("event_properties", "scroll_depth").cast("decimal(12,4)")
    views = web_events(wh, start, end).where(is_event("page_viewed")).select(depth.alias("depth"))
    return views.agg(
        ratio0(F.sum("depth"), F.count("depth"), 2).alias("avg_scroll_depth")
    )


def wishlist_add_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return sessions_with(
        web_events(wh, start, end), wishes=(WISH,), views=("product_viewed", "page_viewed")
    ).select(ratio0("wishes", "views", 4).alias("wishlist_add_rate"))


def cart_abandonment_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Share of cart sessions without a checkout start in the range."""
    flags = (
        web_events(wh, start, end)
        .where(is_event(CART, "checkout_started") & F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.max(is_event(CART)).alias("cart"),
            F.max(is_event("checkout_started")).alias("checkout"),
        )
    )
    carts = F.count_if("cart")
    left = F.count_if(F.col("cart") & ~F.col("checkout"))
    return flags.agg(ratio0(left, carts, 4).alias("cart_abandonment_rate"))


SESSION_KINDS = (CART, WISH, "checkout_started", "product_viewed", "page_viewed")


def session_kinds(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Input of the session bitmaps: session, kind of event and day."""
    return web_events(wh, start, end).where(is_event(*SESSION_KINDS)).select(
        F.col("session_id").alias("key"), F.col("event_type").alias("kind"), day("occurred_at").alias("date")
    )


def session_rates(maps: DayMaps, start: dt.date, end: dt.date) -> DataFrame:
    """The session rates of [start, end] from stored bitmaps; reads no events.

    Sessions with a cart and no checkout are those with either less those with a checkout.
    """
    checkout = "checkout_started"
    got = maps.counts(
        start, end, carts=(CART,), checkouts=(checkout,), either=(CART, checkout), wishes=(WISH,),
        views=("product_viewed",), looks=("product_viewed", "page_viewed"),
    )
    return got.select(
        F.lit(start).alias("from_date"),
        F.lit(end).alias("to_date"),
        F.col("looks").alias("sessions"),
        ratio0("carts", "views", 4).alias("add_to_cart_rate"),
        ratio0(F.col("either") - F.col("checkouts"), "carts", 4).alias("cart_abandonment_rate"),
        ratio0("wishes", "looks", 4).alias("wishlist_add_rate"),
    )


def session_rates_from_maps(wh: Warehouse) -> DataFrame:
    """The rates of the last 7, 30 and 90 days from the bitmaps of all days."""
    maps = DayMaps(wh.spark, work_folder(wh.spark, "session-maps"))
    maps.record(session_kinds(wh))
    ranges = [session_rates(maps, wh.as_of - dt.timedelta(days=n - 1), wh.as_of) for n in (7, 30, 90)]
    return ranges[0].union(ranges[1]).union(ranges[2])


def product_page_bounce_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return viewed_sessions(wh, "product_viewed", start, end).agg(
        ratio0(F.count_if(F.expr(BOUNCED)), F.count("*"), 4).alias("product_page_bounce_rate")
    )


def email_open_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return mail_events(wh, start, end).agg(
        ratio0(F.count_if(is_event(OPENED)), F.count_if(is_event(SENT)), 4).alias("email_open_rate")
    )


def email_ctr(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return mail_events(wh, start, end).agg(
        ratio0(F.count_if(is_event(CLICKED)), F.count_if(is_event(OPENED)), 4).alias("email_ctr")
    )


LOOK_AHEAD = 7  # days within which a visit counts as repeated


def and_after(end: Date) -> Date:
    """End of the events that decide about repeat visits up to ``end``."""
    return end + dt.timedelta(days=LOOK_AHEAD) if end else None


def repeat_days(visits: DataFrame) -> DataFrame:
    """Customer days followed by a visit in another session within a week.

    ``visits`` has customer_id, session_id and date.  Two sessions exist in
    [d, d + 7] exactly when the least and the greatest session id there differ,
    and then every session of day d has another one.  The window only needs
    the least and greatest id per customer and day, so a busy customer brings
    one row per day, not one per event.
    """
    per_day = (
        visits.where("customer_id is not null and session_id is not null")
        .groupBy("customer_id", "date")
        .agg(F.min("session_id").alias("lo"), F.max("session_id").alias("hi"))
    )
    ahead = (
        Window.partitionBy("customer_id")
        .orderBy(F.unix_date("date"))
        .rangeBetween(Window.currentRow, LOOK_AHEAD)
    )
    return per_day.select(
        "customer_id",
        "date",
        (F.min("lo").over(ahead) != F.max("hi").over(ahead)).alias("repeats"),
    )


def _with_repeats(all_pairs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (date, session, customer) rows with the repeat flag.

    ``all_pairs`` also holds the days after the range (:func:`and_after`).
    """
    return left_join_spread(
        pairs,
        repeat_days(all_pairs),
        ["customer_id", "date"],
        nullable="customer_id",
        spread_by="session_id",
    )


def repeat_visit_rate_7d(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Sessions with another session of the customer within seven days of the
    session's first day in the range, per (session, customer) pair."""
    visits = staged(
        web_events(wh, start, and_after(end))
        .where("customer_id is not null and session_id is not null")
        .select("customer_id", "session_id", day("occurred_at").alias("date"))
        .distinct(),
        "visits",
    )
    pairs = (
        visits.where(in_dates("date", start, end))
        .groupBy("session_id", "customer_id")
        .agg(F.min("date").alias("date"))
    )
    flagged = pairs.join(repeat_days(visits), ["customer_id", "date"], "left")
    per_session = flagged.groupBy("session_id").agg(
        F.count("*").alias("pairs"), F.max(F.col("repeats").cast("int")).alias("repeats")
    )
    return per_session.agg(
        ratio0(F.sum("repeats"), F.sum("pairs"), 4).alias("repeat_visit_rate_7d")
    )


def _score(engaged: Column, seconds: Column, carts: Column, opened: Column, clicked: Column) -> Column:
    """70 % site (sessions, dwell time, carts) and 30 % mail (opens, clicks)."""
    site = engaged * 0.3 + F.coalesce(seconds, F.lit(0.0)) * 0.2 + carts * 0.2
    return site * 0.7 + (opened * 0.2 + clicked * 0.1) * 0.3


def _share(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def engagement_score(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Weighted score; the dwell time is that of (session, event type) groups."""
    spans = (
        web_events(wh, start, end)
        .where("session_id is not null")
        .groupBy("session_id", "event_type")
        .agg(span_seconds(F.min("occurred_at"), F.max("occurred_at")).alias("seconds"))
        .groupBy("session_id")
        .agg(
            F.max(is_event("product_viewed", CART).cast("int")).alias("engaged"),
            F.sum("seconds").alias("seconds"),
            F.count("*").alias("spans"),
        )
        .agg(*[F.sum(c).alias(c) for c in ("engaged", "seconds", "spans")])
    )
    carts = web_events(wh, start, end).agg(F.count_if(is_event(CART)).alias("carts"))
    mails = mail_events(wh, start, end).agg(
        F.count_if(is_event(SENT)).alias("sent"),
        F.count_if(is_event(OPENED)).alias("opened"),
        F.count_if(is_event(CLICKED)).alias("clicked"),
    )
    parts = stack_sum(
        [], [spans, carts, mails], ["engaged", "seconds", "spans", "carts", "sent", "opened", "clicked"]
    )
    zero = F.lit(0.0)
    score = _score(
        F.coalesce("engaged", F.lit(0)),
        _share(F.col("seconds"), F.col("spans")),
        F.col("carts"),
        F.coalesce(_share(F.col("opened"), F.col("sent")), zero),
        F.coalesce(_share(F.col("clicked"), F.col("opened")), zero),
    )
    return parts.select(rounded(score, 4).alias("engagement_score"))


# --- daily rollups --------------------------------------------------------------


def site_rates_daily(wh: Warehouse) -> DataFrame:
    """Add-to-cart rate and mean session length of the days with web events.

    The same figures as in the daily rollup, from one grouping by day and session.
    """
    per_session = (
        web_events(wh)
        .groupBy(day("occurred_at").alias("date"), "session_id")
        .agg(
            F.count_if(is_event("product_viewed")).alias("product_views"),
            F.count_if(is_event(CART)).alias("carts"),
            F.min("occurred_at").alias("first_at"),
            F.max("occurred_at").alias("last_at"),
        )
    )
    return (
        per_session.where("session_id is not null")
        .groupBy("date")
        .agg(
            F.count_if(F.col("product_views") > 0).alias("view_sessions"),
            F.count_if(F.col("carts") > 0).alias("cart_sessions"),
            F.avg(seconds()).alias("seconds"),
        )
        .select(
            "date",
            ratio("cart_sessions", "view_sessions", 4).alias("add_to_cart_rate"),
            rounded("seconds", 0).cast("int").alias("avg_session_duration_seconds"),
        )
    )


def consideration_metrics_daily(
    wh: Warehouse,
    start: Date = None,
    end: Date = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """One row per day with all web and mail counts, rates and the score.

    Days are those of ``calendar``, else every day from the first to the last
    web event; days without any event get zero counts and NULL rates.  One pass
    groups web events by (day, session, customer); everything about sessions
    follows from that much smaller table.
    """
    is_view = is_event("product_viewed")
    depth = json_text("event_properties", "scroll_depth").cast("decimal(12,4)")
    page = is_event("page_viewed")
    all_pairs = (
        web_events(wh, start, and_after(end))
        .groupBy(day("occurred_at").alias("date"), "session_id", "customer_id")
        .agg(
            F.count_if(is_view).alias("product_views"),
            F.count_if(is_event(CART)).alias("carts"),
            F.count_if(is_event(WISH)).alias("wishes"),
            F.count_if(is_event("checkout_started")).alias("checkout_starts"),
            F.count_if(is_event("checkout_completed")).alias("checkout_ends"),
            F.count_if(page).alias("page_views"),
            F.min("occurred_at").alias("first_at"),
            F.max("occurred_at").alias("last_at"),
            F.min(F.when(is_view, F.col("occurred_at"))).alias("first_view"),
            F.max(F.when(is_view, F.col("occurred_at"))).alias("last_view"),
            F.sum(F.when(page, depth)).alias("depth_sum"),
            F.count(F.when(page, depth)).alias("depth_n"),
        )
    )
    # staged, so the events are read once for sessions, repeat visits and days
    all_pairs = staged(all_pairs, "session-pairs")
    pairs = all_pairs.where(in_dates("date", start, end))
    per_pair = _with_repeats(all_pairs, pairs)
    if calendar is None:
        calendar = source_range(pairs, "date")
    counts = [
        "product_views", "carts", "wishes", "checkout_starts", "checkout_ends", "page_views",
        "depth_sum", "depth_n",
    ]
    has_customer = F.col("customer_id").isNotNull()
    per_session = per_pair.groupBy("date", "session_id").agg(
        *[F.sum(c).alias(c) for c in counts],
        *[F.min(c).alias(c) for c in ("first_at", "first_view")],
        *[F.max(c).alias(c) for c in ("last_at", "last_view")],
        F.max(has_customer.cast("int")).alias("known"),
        F.max((has_customer & F.col("repeats")).cast("int")).alias("repeats"),
    )
    named = F.col("session_id").isNotNull()

    def sessions_if(cond: Column) -> Column:
        return F.count_if(named & cond)

    view_seconds = rounded(span_seconds("first_view", "last_view"), 0)
    site = per_session.groupBy("date").agg(
        *[F.sum(c).alias(c) for c in counts],
        sessions_if(F.lit(True)).alias("sessions"),
        sessions_if(F.col("product_views") > 0).alias("view_sessions"),
        sessions_if(F.col("carts") > 0).alias("cart_sessions"),
        sessions_if(F.col("wishes") > 0).alias("wish_sessions"),
        sessions_if((F.col("product_views") > 0) | (F.col("carts") > 0)).alias("engaged"),
        sessions_if(
            (F.col("product_views") == 1) | ((F.col("product_views") > 0) & (view_seconds < 30))
        ).alias("view_bounces"),
        sessions_if(F.col("page_views") > 0).alias("page_sessions"),
        F.sum(F.when(named, F.col("page_views"))).alias("session_pages"),
        F.avg(F.when(named, seconds())).alias("seconds"),
        sessions_if(F.col("known") == 1).alias("known_sessions"),
        sessions_if(F.col("repeats") == 1).alias("repeat_sessions"),
    )
    mails = (
        mail_events(wh, start, end)
        .groupBy(day("occurred_at").alias("date"))
        .agg(
            F.count_if(is_event(SENT)).alias("sent"),
            F.count_if(is_event(OPENED)).alias("opened"),
            F.count_if(is_event(CLICKED)).alias("clicked"),
        )
    )
    rows = calendar.select("date").join(site, "date", "left").join(mails, "date", "left")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in [*site.columns, *mails.columns] if c != "date"}
    score = _score(
        n["engaged"],
        F.col("seconds"),
        n["carts"],
        _share(n["opened"], n["sent"]),
        _share(n["clicked"], n["opened"]),
    )
    rate = F.when(F.col("repeat_sessions") > 0, ratio("repeat_sessions", "known_sessions", 4))
    return rows.select(
        "date",
        n["product_views"].alias("total_product_views"),
        n["carts"].alias("total_add_to_cart"),
        n["wishes"].alias("total_wishlist_adds"),
        n["checkout_starts"].alias("total_checkout_starts"),
        n["checkout_ends"].alias("total_checkout_completions"),
        ratio(n["cart_sessions"], n["view_sessions"], 4).alias("add_to_cart_rate"),
        ratio(n["carts"], n["product_views"], 4).alias("view_to_add_to_cart_ratio"),
        ratio(n["wish_sessions"], n["sessions"], 4).alias("wishlist_add_rate"),
        ratio(n["carts"] - n["checkout_starts"], n["carts"], 4).alias("cart_abandonment_rate"),
        ratio(n["view_bounces"], n["view_sessions"], 4).alias("product_page_bounce_rate"),
        n["sessions"].alias("total_sessions"),
        n["page_views"].alias("total_page_views"),
        ratio("session_pages", "page_sessions", 2).alias("avg_pages_per_session"),
        rounded("seconds", 0).cast("int").alias("avg_session_duration_seconds"),
        ratio("depth_sum", "depth_n", 2).alias("avg_scroll_depth_percent"),
        n["repeat_sessions"].alias("sessions_with_repeat_visits_7d"),
        rate.alias("repeat_visit_rate_7d"),
        n["sent"].alias("total_emails_sent"),
        n["opened"].alias("total_emails_opened"),
        n["clicked"].alias("total_emails_clicked"),
        ratio(n["opened"], n["sent"], 4).alias("email_open_rate"),
        ratio(n["clicked"], n["opened"], 4).alias("email_ctr"),
        rounded(score, 4).alias("engagement_score"),
    )


def session_engagement_daily(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """One row per (day, session, customer) with counts and behaviour flags."""
    page = is_event("page_viewed")
    depth = json_text("event_properties", "scroll_depth").cast("decimal(12,4)")
    all_pairs = (
        web_events(wh, start, and_after(end))
        .where("session_id is not null")
        .groupBy(day("occurred_at").alias("date"), "session_id", "customer_id")
        .agg(
            F.count_if(page).alias("page_views_count"),
            F.count_if(is_event("product_viewed")).alias("product_views_count"),
            F.count_if(is_event(CART)).alias("add_to_cart_count"),
            F.count_if(is_event(WISH)).alias("wishlist_add_count"),
            F.max(is_event("checkout_started")).alias("checkout_started"),
            F.max(is_event("checkout_completed")).alias("checkout_completed"),
            F.min("occurred_at").alias("first_at"),
            F.max("occurred_at").alias("last_at"),
            ratio(F.sum(depth), F.count(depth), 2).alias("avg_scroll_depth_percent"),
        )
    )
    all_pairs = staged(all_pairs, "session-pairs")
    rows = _with_repeats(all_pairs, all_pairs.where(in_dates("date", start, end)))
    one_page = F.col("page_views_count") == 1
    brief = seconds() < 30
    return rows.select(
        "date",
        "session_id",
        "customer_id",
        "page_views_count",
        "product_views_count",
        "add_to_cart_count",
        "wishlist_add_count",
        "checkout_started",
        "checkout_completed",
        rounded(seconds(), 0).cast("int").alias("session_duration_seconds"),
        "avg_scroll_depth_percent",
        (one_page | brief).alias("bounce"),
        ((F.col("product_views_count") > 0) & one_page & brief).alias("is_product_page_bounce"),
        F.coalesce("repeats", F.lit(False)).alias("has_repeat_visit_7d"),
    )


# --- summaries ------------------------------------------------------------------

SUMMED = [
    "total_product_views", "total_add_to_cart", "total_wishlist_adds", "total_checkout_starts",
    "total_checkout_completions", "total_sessions", "total_page_views", "total_emails_sent",
    "total_emails_opened", "total_emails_clicked",
]
AVERAGED = {
    "avg_add_to_cart_rate": "add_to_cart_rate",
    "avg_view_to_add_to_cart_ratio": "view_to_add_to_cart_ratio",
    "avg_wishlist_add_rate": "wishlist_add_rate",
    "avg_cart_abandonment_rate": "cart_abandonment_rate",
    "avg_product_page_bounce_rate": "product_page_bounce_rate",
    "avg_pages_per_session": "avg_pages_per_session",
    "avg_session_duration_seconds": "avg_session_duration_seconds",
    "avg_scroll_depth_percent": "avg_scroll_depth_percent",
    "avg_repeat_visit_rate_7d": "repeat_visit_rate_7d",
    "avg_email_open_rate": "email_open_rate",
    "avg_email_ctr": "email_ctr",
    "avg_engagement_score": "engagement_score",
}


def consideration_metrics_summary(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """All-time sums and unweighted means of the daily rates (NULL days skipped)."""
    daily = consideration_metrics_daily(wh) if daily is None else daily
    return daily.agg(
        *[F.sum(c).alias(c) for c in SUMMED],
        *[rounded(F.avg(c), 6).alias(name) for name, c in AVERAGED.items()],
    )


def percent(c: str) -> Column:
    return rounded(F.col(c) * 100, 2).alias(f"{c}_pct")


def consideration_metrics_trends(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    daily = consideration_metrics_daily(wh) if daily is None else daily
    return daily.select(
        "date",
        "total_product_views",
        "total_add_to_cart",
        percent("add_to_cart_rate"),
        percent("view_to_add_to_cart_ratio"),
        "avg_pages_per_session",
        "avg_session_duration_seconds",
        percent("cart_abandonment_rate"),
        percent("product_page_bounce_rate"),
        percent("email_open_rate"),
        percent("email_ctr"),
        "engagement_score",
    ).orderBy(F.desc("date"))


def _recent_daily(wh: Warehouse, days: int) -> DataFrame:
    return consideration_metrics_daily(wh, start=wh.as_of - dt.timedelta(days=days))


def consideration_last_7_days(wh: Warehouse) -> DataFrame:
    return consideration_metrics_trends(wh, _recent_daily(wh, 7)).limit(7)


def cart_abandonment_last_7_days(wh: Warehouse) -> DataFrame:
    return consideration_metrics_trends(wh, _recent_daily(wh, 7)).select(
        "date", F.col("cart_abandonment_rate_pct").alias("abandonment_pct")
    )


def engagement_score_trend(wh: Warehouse) -> DataFrame:
    return _recent_daily(wh, 30).select("date", "engagement_score").orderBy(F.desc("date"))


def mail_rates_trend(wh: Warehouse) -> DataFrame:
    return (
        _recent_daily(wh, 30)
        .select(
            "date",
            rounded(F.col("email_open_rate") * 100, 2).alias("open_rate_pct"),
            rounded(F.col("email_ctr") * 100, 2).alias("ctr_pct"),
        )
        .orderBy(F.desc("date"))
    )


def _last_30(fn):
    def plan(wh: Warehouse) -> DataFrame:
        return fn(wh, start=wh.as_of - dt.timedelta(days=30), end=wh.as_of)

    return plan


for _fn in (
    add_to_cart_rate, view_to_add_to_cart_ratio, product_view_depth, avg_session_duration,
    avg_scroll_depth, wishlist_add_rate, cart_abandonment_rate, product_page_bounce_rate,
    email_open_rate, email_ctr, repeat_visit_rate_7d, engagement_score,
):
    register(_fn.__name__, _last_30(_fn))
for _fn in (
    consideration_metrics_daily, session_engagement_daily, consideration_metrics_summary,
    consideration_metrics_trends, consideration_last_7_days, cart_abandonment_last_7_days,
    engagement_score_trend, mail_rates_trend, session_rates_from_maps,
):
    register(_fn.__name__, _fn)
