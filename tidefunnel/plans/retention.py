"""Retention metrics: repeat purchases, activity, churn, predictions, cohorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import (
    ACQUIRING,
    CLICKED,
    MAIL_FUNNEL,
    OPENED,
    SENT,
    WINBACK_WORDS,
    day,
    in_dates,
    mean,
    midnight,
    money,
    ratio,
    ratio0,
    rounded,
)
from tidefunnel.operators import gaps
from tidefunnel.operators.calendar import running_totals, sampled_history
from tidefunnel.operators.quantile import exact_median
from tidefunnel.operators.tables import staged
from tidefunnel.plans.commerce import buyers, paid_orders
from tidefunnel.plans.consideration import is_event, percent
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

Date = dt.date | None

FUTURE, PAST, UNKNOWN = 0.8, 0.3, 0.5  # reorder likelihood by predicted date
EVER = dt.date(1900, 1, 1)  # day on which constants enter running totals


def days_before(day_: dt.date, n: int) -> dt.date:
    return day_ - dt.timedelta(days=n)


def active_since(cutoff: dt.date) -> Column:
    return F.col("last_order_date") >= F.lit(cutoff)


# --- single metrics ---------------------------------------------------------------


def repeat_purchase_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    people = wh.table("customers").where(in_dates("first_order_date", start, end))
    return people.agg(
        ratio0(
            F.count_if(F.col("total_orders") > 1), F.count_if(F.col("total_orders") > 0), 4
        ).alias("repeat_purchase_rate")
    )


def avg_days_between_purchases(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Each customer's shortest gap between two paid orders, averaged.

    The range restricts the earlier order of the pair only.
    """
    shortest = (
        gaps.shortest_gaps(gaps.order_days(paid_orders(wh)))
        .where(in_dates("date", start, end))
        .groupBy("customer_id")
        .agg(F.min("gap").alias("gap"))
    )
    return shortest.agg(
        ratio0(F.sum("gap"), F.count("gap"), 2).alias("avg_days_between_purchases")
    )


def active_customer_rate(wh: Warehouse, days: int = 30) -> DataFrame:
    active = F.count_if(active_since(days_before(wh.as_of, days)))
    return wh.table("customers").agg(
        ratio0(active, F.count_if(F.col("total_orders") > 0), 4).alias("active_customer_rate")
    )


def churn_rate(wh: Warehouse, days: int = 30) -> DataFrame:
    """Share of buyers whose last order is older than ``days`` or unknown."""
    gone = ~F.coalesce(active_since(days_before(wh.as_of, days)), F.lit(False))
    return buyers(wh).agg(ratio0(F.count_if(gone), F.count("*"), 4).alias("churn_rate"))


def churn_rates(wh: Warehouse) -> DataFrame:
    def rate(days: int) -> Column:
        gone = ~F.coalesce(active_since(days_before(wh.as_of, days)), F.lit(False))
        return ratio0(F.count_if(gone), F.count("*"), 4).alias(f"churn_{days}d")

    return buyers(wh).agg(*[rate(d) for d in (30, 60, 90)])


def avg_ltv(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    people = buyers(wh).where(in_dates("first_order_date", start, end))
    return people.agg(F.coalesce(rounded(mean("total_revenue"), 2), F.lit(0.0)).alias("avg_ltv"))


def avg_reorder_probability(wh: Warehouse) -> DataFrame:
    """0.8 for a predicted date still ahead, 0.3 for one passed, 0.5 for none."""
    latest = (
        wh.table("klaviyo_predictive_metrics")
        .groupBy("profile_id")
        .agg(F.max_by("predicted_next_order_date", "calculated_at").alias("due"))
    )
    today = F.lit(wh.as_of)
    ahead = F.count_if(F.col("due") >= today)
    passed = F.count_if(F.col("due") < today)
    none = F.count_if(F.col("due").isNull())
    return latest.agg(
        ratio0(ahead * FUTURE + passed * PAST + none * UNKNOWN, F.count("*"), 4).alias(
            "avg_reorder_probability"
        )
    )


def subscription_retention_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Share of repeat customers with an order in the last 90 days."""
    repeat = wh.table("customers").where(
        (F.col("total_orders") > 1) & in_dates("first_order_date", start, end)
    )
    active = F.count_if(active_since(days_before(wh.as_of, 90)))
    return repeat.agg(ratio0(active, F.count("*"), 4).alias("subscription_retention_rate"))


def until_midnight(ts: str, start: Date, end: Date) -> Column:
    """Timestamps in [start 00:00, end 00:00]: the end day itself is left out."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= midnight(start))
    if end is not None:
        cond = cond & (F.col(ts) <= midnight(end))
    return cond


def _slope(first: Column, last: Column, days: Column) -> Column:
    slope = rounded((last - first) / F.greatest(days, F.lit(1)), 4)
    return F.coalesce(slope, F.lit(0.0))


def engagement_decay_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    """Daily change of the weekly share of profiles that open or click mails.

    Compares the first and the last week; negative values mean decay.
    """
    weekly = (
        wh.table("klaviyo_events")
        .where(is_event(*MAIL_FUNNEL) & until_midnight("occurred_at", start, end))
        .groupBy(F.trunc(day("occurred_at"), "week").alias("week"), "profile_id")
        .agg(F.max(is_event(OPENED, CLICKED).cast("int")).alias("engaged"))
        .groupBy("week")
        .agg(
            F.count("profile_id").alias("total"),
            F.sum(F.when(F.col("profile_id").isNotNull(), F.col("engaged"))).alias("engaged"),
        )
        .select(
            "week",
            F.coalesce(
                F.try_divide(F.col("engaged").cast("double"), F.col("total").cast("double")),
                F.lit(0.0),
            ).alias("rate"),
        )
    )
    return weekly.agg(
        _slope(
            F.min_by("rate", "week"), F.max_by("rate", "week"), F.datediff(F.max("week"), F.min("week"))
        ).alias("engagement_decay_rate")
    )


def winback_events(wh: Warehouse) -> DataFrame:
    """Sent and opened mails of campaigns whose name says they win customers back."""
    name = F.lower("name")
    wanted = F.lit(False)
    for word in WINBACK_WORDS:
        wanted = wanted | name.contains(word)
    campaigns = wh.table("klaviyo_campaigns").where(wanted).select(F.col("id").alias("campaign_id"))
    return (
        wh.table("klaviyo_events")
        .where(is_event(SENT, OPENED))
        .join(campaigns, "campaign_id", "left_semi")
    )


def winback_email_open_rate(wh: Warehouse, start: Date = None, end: Date = None) -> DataFrame:
    return (
        winback_events(wh)
        .where(until_midnight("occurred_at", start, end))
        .agg(
            ratio0(F.count_if(is_event(OPENED)), F.count_if(is_event(SENT)), 4).alias(
                "winback_email_open_rate"
            )
        )
    )


def customer_predictions(wh: Warehouse) -> DataFrame:
    """Prediction snapshots with the customer of their profile."""
    profiles = wh.table("klaviyo_profiles").select(F.col("id").alias("profile_id"), "customer_id")
    return wh.table("klaviyo_predictive_metrics").join(profiles, "profile_id")


def _replenishment_misses(wh: Warehouse, order_days: DataFrame | None) -> DataFrame:
    """Days between each buyer's latest predicted order date and the next order."""
    ids = buyers(wh).select(F.col("id").alias("customer_id"))
    predicted = (
        customer_predictions(wh)
        .where("predicted_next_order_date is not null and customer_id is not null")
        .groupBy("customer_id")
        .agg(
            F.max_by(
                F.struct("predicted_next_order_date", day("calculated_at").alias("made_on")),
                F.struct("calculated_at", "profile_id"),
            ).alias("p")
        )
        .join(ids, "customer_id", "left_semi")
    )
    days = gaps.order_days(paid_orders(wh)) if order_days is None else order_days
    return (
        days.join(predicted, "customer_id")
        .where("date > p.made_on")
        .groupBy("customer_id")
        .agg(
            F.abs(
                F.datediff(F.first("p.predicted_next_order_date"), F.min("date"))
            ).alias("miss")
        )
    )


def replenishment_accuracy(wh: Warehouse, order_days: DataFrame | None = None) -> DataFrame:
    return _replenishment_misses(wh, order_days).agg(
        ratio0(F.sum("miss"), F.count("miss"), 2).alias("replenishment_accuracy")
    )


def avg_ltv_cac_ratio(wh: Warehouse) -> DataFrame:
    """Mean over buyers of revenue per (mean spend of an acquiring ad event)."""
    cost = (
        wh.table("ad_events")
        .where(F.col("event_type").isin(*ACQUIRING) & F.col("customer_id").isNotNull())
        .groupBy(F.col("customer_id").alias("id"))
        .agg((F.sum("spend").cast("double") / F.count("*")).alias("cac"))
        .where("cac > 0")
    )
    ratio_ = F.col("total_revenue").cast("double") / F.col("cac")
    return (
        buyers(wh)
        .join(cost, "id")
        .agg(F.coalesce(rounded(F.avg(ratio_), 2), F.lit(0.0)).alias("avg_ltv_cac_ratio"))
    )


# --- daily rollup -------------------------------------------------------------------


def _customer_changes(wh: Warehouse) -> DataFrame:
    """Customer state is that of now on every day; only the cut-offs move.

    Each buyer is read once and leaves a few dated marks: constants that count
    on every day, the first order, and the days on which the last order falls
    out of the 30, 60 and 90 day windows.
    """
    one, repeat = F.lit(1), (F.col("total_orders") > 1).cast("int")
    first, last = F.col("first_order_date"), F.col("last_order_date")
    revenue = F.col("total_revenue").cast("decimal(12,2)")
    kept = F.coalesce(active_since(days_before(wh.as_of, 90)).cast("int"), F.lit(0)) * repeat
    marks = [
        (F.lit(EVER), {"customers": one, "repeaters": repeat, "dated": last.isNotNull().cast("int")}),
        (F.lit(EVER), {"ltv_all": revenue}),
        (first, {"ltv_sum": revenue, "ltv_n": revenue.isNotNull().cast("int")}),
        (first, {"subscribers": repeat, "kept": kept}),
        *[(F.date_add(last, n + 1), {f"lapsed_{n}": one}) for n in (30, 60, 90)],
    ]
    names = [name for _, values in marks for name in values]
    money_names = {"ltv_all", "ltv_sum"}

    def mark(date: Column, values: dict[str, Column]) -> Column:
        cells = [
            F.coalesce(
                values.get(name, F.lit(None)).cast("decimal(12,2)" if name in money_names else "int"),
                F.lit(0),
            ).alias(name)
            for name in names
        ]
        return F.struct(date.alias("date"), *cells)

    return (
        buyers(wh)
        .select(F.explode(F.array(*[mark(date, values) for date, values in marks])).alias("m"))
        .select("m.*")
        .where("date is not null")
        .groupBy("date")
        .agg(*[F.sum(n).cast("double" if n in money_names else "long").alias(n) for n in names])
    )


def _gap_changes(shortest: DataFrame) -> DataFrame:
    """How the sum and number of customers' shortest gaps change day by day."""
    so_far = Window.partitionBy("customer_id").orderBy("date")
    upto = F.min("gap").over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.min("gap").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    return (
        shortest.select("date", upto.alias("now"), before.alias("was"))
        .where("now is not null")
        .groupBy("date")
        .agg(
            F.sum(F.col("now") - F.coalesce("was", F.lit(0))).alias("gap_sum"),
            F.count_if(F.col("was").isNull()).alias("gap_n"),
        )
    )


def _prediction_changes(wh: Warehouse) -> list[DataFrame]:
    """Day-by-day changes of the averages over each profile's latest prediction."""
    values = {
        "churn": "predicted_churn_probability",
        "pltv": "predicted_lifetime_value",
        "engage": "email_engagement_probability",
    }
    made = F.col("calculated_at")
    per_day = (
        wh.table("klaviyo_predictive_metrics")
        .groupBy("profile_id", day("calculated_at").alias("date"))
        .agg(
            F.max_by("predicted_next_order_date", made).alias("due"),
            *[F.max_by(v, F.when(F.col(v).isNotNull(), made)).alias(k) for k, v in values.items()],
        )
    )
    history = Window.partitionBy("profile_id").orderBy("date")
    before = history.rowsBetween(Window.unboundedPreceding, -1)
    steps = per_day.select(
        "date",
        "due",
        F.lead("date").over(history).alias("until"),
        *[F.col(k) for k in values],
        *[F.last(k, ignorenulls=True).over(before).alias(f"{k}_was") for k in values],
    )
    averages = steps.groupBy("date").agg(
        *[
            F.sum(
                F.when(F.col(k).isNotNull(), F.col(k) - F.coalesce(F.col(f"{k}_was"), F.lit(0)))
            ).cast("double").alias(f"{k}_sum")
            for k in values
        ],
        *[
            F.count_if(F.col(k).isNotNull() & F.col(f"{k}_was").isNull()).alias(f"{k}_n")
            for k in values
        ],
    )
    # A prediction counts from its day until the next one; its date is ahead up
    # to and including the due day and passed afterwards.
    due, until = F.col("due"), F.col("until")
    overdue = F.date_add(due, 1)

    def change(when: Column, ahead: Column | int, passed: Column | int, n: int) -> Column:
        return F.struct(
            when.alias("date"),
            (F.lit(ahead) if isinstance(ahead, int) else ahead).cast("long").alias("ahead"),
            (F.lit(passed) if isinstance(passed, int) else passed).cast("long").alias("passed"),
            F.lit(n).cast("long").alias("predicted"),
        )

    starts_ahead = F.coalesce((due >= F.col("date")).cast("int"), F.lit(0))
    starts_passed = F.coalesce((due < F.col("date")).cast("int"), F.lit(0))
    ends_ahead = F.coalesce((overdue >= until).cast("int"), F.lit(0))
    ends_passed = F.coalesce((overdue < until).cast("int"), F.lit(0))
    turns = (due >= F.col("date")) & (until.isNull() | (overdue < until))
    moves = steps.select(
        F.explode(
            F.array(
                change(F.col("date"), starts_ahead, starts_passed, 1),
                change(F.when(turns, overdue), -1, 1, 0),
                change(until, -ends_ahead, -ends_passed, -1),
            )
        ).alias("m")
    ).select("m.*")
    return [averages, moves]


def _seen_from(ts: str) -> Column:
    """First day t with ts <= t 00:00."""
    d = day(ts)
    return F.when(F.col(ts) == d.cast("timestamp_ntz"), d).otherwise(F.date_add(d, 1))


def _winback_changes(wh: Warehouse, trailing: int) -> DataFrame:
    """Mails enter a trailing window and leave it ``trailing`` days later."""
    daily = (
        winback_events(wh)
        .groupBy(_seen_from("occurred_at").alias("from"), day("occurred_at").alias("d"))
        .agg(F.count_if(is_event(OPENED)).alias("wb_open"), F.count_if(is_event(SENT)).alias("wb_sent"))
    )
    enter = daily.select(F.col("from").alias("date"), "wb_open", "wb_sent")
    leave = daily.select(
        F.date_add("d", trailing + 1).alias("date"),
        (-F.col("wb_open")).alias("wb_open"),
        (-F.col("wb_sent")).alias("wb_sent"),
    )
    return enter.union(leave)


def trailing_decay(wh: Warehouse, calendar: DataFrame, trailing: int = 30) -> DataFrame:
    """Engagement decay over [t - trailing, t] for every calendar day t.

    Per profile and week only the first moment it becomes visible and the last
    day it stays visible matter: whole weeks and the running week need the
    former, the cut-off first week the latter.  Counting profiles by those days
    leaves a few rows per week, which then meet the calendar.
    """
    engaged = is_event(OPENED, CLICKED)
    seen, d = _seen_from("occurred_at"), day("occurred_at")
    per_profile = (
        wh.table("klaviyo_events")
        .where(is_event(*MAIL_FUNNEL))
        .groupBy("profile_id", F.trunc(d, "week").alias("week"))
        .agg(
            F.min(seen).alias("from"),
            F.max(d).alias("to"),
            F.min(F.when(engaged, seen)).alias("e_from"),
            F.max(F.when(engaged, d)).alias("e_to"),
        )
    )
    one = F.col("profile_id").isNotNull().cast("long")
    # four marks per row, reduced to counts before the union is shuffled further
    marks = per_profile.select(
        "week",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("whole"), F.col("from").alias("d"), one.alias("total"), F.lit(0).cast("long").alias("engaged")),
                F.struct(F.lit(False).alias("whole"), F.col("to").alias("d"), one.alias("total"), F.lit(0).cast("long").alias("engaged")),
                F.struct(F.lit(True).alias("whole"), F.col("e_from").alias("d"), F.lit(0).cast("long").alias("total"), one.alias("engaged")),
                F.struct(F.lit(False).alias("whole"), F.col("e_to").alias("d"), F.lit(0).cast("long").alias("total"), one.alias("engaged")),
            )
        ).alias("m"),
    ).select("week", "m.*")
    counts = (
        marks.where("d is not null")
        .groupBy("week", "whole", "d")
        .agg(F.sum("total").alias("total"), F.sum("engaged").alias("engaged"))
    )
    since = F.date_sub("date", trailing)
    weeks = calendar.select(
        "date",
        since.alias("since"),
        F.explode(
            F.sequence(F.trunc(since, "week"), F.trunc("date", "week"), F.expr("interval 7 day"))
        ).alias("week"),
    )
    visible = (F.col("whole") & (F.col("week") >= F.col("since")) & (F.col("d") <= F.col("date"))) | (
        ~F.col("whole") & (F.col("week") < F.col("since")) & (F.col("d") >= F.col("since"))
    )
    weekly = (
        weeks.join(counts, "week")
        .where(visible)
        .groupBy("date", "week")
        .agg(
            F.coalesce(
                F.try_divide(F.sum("engaged").cast("double"), F.sum("total").cast("double")), F.lit(0.0)
            ).alias("rate")
        )
    )
    return weekly.groupBy("date").agg(
        _slope(
            F.min_by("rate", "week"), F.max_by("rate", "week"), F.datediff(F.max("week"), F.min("week"))
        ).alias("engagement_decay_rate")
    )


def default_calendar(wh: Warehouse) -> DataFrame:
    return sampled_history(wh.table("shopify_orders"), "order_date", wh.as_of)


def retention_metrics_daily(
    wh: Warehouse, calendar: DataFrame | None = None, trailing: int = 30
) -> DataFrame:
    """One row per calendar day, for all days in one job.

    Every ingredient is turned into changes per day; running totals along the
    calendar give each day's value.  Customer totals and last order dates are
    those of now on every day, as established.
    """
    calendar = default_calendar(wh) if calendar is None else calendar
    days = staged(gaps.order_days(paid_orders(wh)), "order-days")
    constants = [
        replenishment_accuracy(wh, days).select(F.lit(EVER).alias("date"), "*"),
        avg_ltv_cac_ratio(wh).select(F.lit(EVER).alias("date"), "*"),
        exact_median(buyers(wh), "total_revenue", "ltv_median").select(F.lit(EVER).alias("date"), "*"),
    ]
    parts = [
        _customer_changes(wh),
        _gap_changes(gaps.shortest_gaps(days)),
        *_prediction_changes(wh),
        _winback_changes(wh, trailing),
        *constants,
    ]
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part, allowMissingColumns=True)
    measures = [c for c in changes.columns if c != "date"]
    totals = running_totals(calendar, changes, measures).join(
        trailing_decay(wh, calendar, trailing), "date", "left"
    )
    totals = gaps.with_median_gap(totals, gaps.gap_first_seen(days), "gap_median")
    active = {n: F.col("dated") - F.col(f"lapsed_{n}") for n in (30, 60, 90)}
    reorder = F.col("ahead") * FUTURE + F.col("passed") * PAST + (
        F.col("predicted") - F.col("ahead") - F.col("passed")
    ) * UNKNOWN
    bought = F.col("customers") > 0
    return totals.select(
        "date",
        F.col("customers").alias("total_customers"),
        *[active[n].alias(f"active_customers_{n}d") for n in active],
        F.col("repeaters").alias("repeat_customers"),
        ratio("repeaters", "customers", 4).alias("repeat_purchase_rate"),
        *[ratio(active[n], "customers", 4).alias(f"active_customer_rate_{n}d") for n in active],
        *[
            ratio(F.col("customers") - active[n], "customers", 4).alias(f"churn_rate_{n}d")
            for n in active
        ],
        ratio0("gap_sum", "gap_n", 2).alias("avg_days_between_purchases"),
        rounded("gap_median", 2).alias("median_days_between_purchases"),
        ratio0("ltv_sum", "ltv_n", 2).alias("avg_ltv"),
        F.when(bought, rounded("ltv_median", 2)).alias("median_ltv"),
        F.when(bought, money("ltv_all")).alias("total_ltv"),
        ratio(reorder, "predicted", 4).alias("avg_reorder_probability"),
        ratio("churn_sum", "churn_n", 4).alias("avg_churn_probability"),
        ratio("pltv_sum", "pltv_n", 2).alias("avg_predicted_ltv"),
        ratio("engage_sum", "engage_n", 4).alias("avg_email_engagement_probability"),
        F.coalesce("engagement_decay_rate", F.lit(0.0)).alias("engagement_decay_rate"),
        ratio0("wb_open", "wb_sent", 4).alias("winback_email_open_rate"),
        ratio0("kept", "subscribers", 4).alias("subscription_retention_rate"),
        F.col("replenishment_accuracy").alias("avg_replenishment_accuracy_days"),
        "avg_ltv_cac_ratio",
    )


# --- cohorts --------------------------------------------------------------------------


def customer_retention_cohorts(wh: Warehouse) -> DataFrame:
    """One row per buyer with cohort month, activity flags and latest prediction."""
    spacing = gaps.mean_distinct_gap(gaps.order_days(paid_orders(wh)))
    fields = [
        "predicted_next_order_date", "predicted_churn_probability", "predicted_lifetime_value",
        "email_engagement_probability",
    ]
    latest = (
        customer_predictions(wh)
        .where("customer_id is not null")
        .groupBy("customer_id")
        .agg(F.max_by(F.struct(*fields), F.struct("calculated_at", "profile_id")).alias("p"))
    )
    today = F.lit(wh.as_of)
    last = F.col("last_order_date")

    def active(n: int) -> Column:
        return active_since(days_before(wh.as_of, n))

    return (
        buyers(wh)
        .withColumnRenamed("id", "customer_id")
        .join(spacing, "customer_id", "left")
        .join(latest, "customer_id", "left")
        .select(
            "customer_id",
            F.trunc("first_order_date", "month").alias("cohort_date"),
            "first_order_date",
            "last_order_date",
            F.col("total_orders").cast("long").alias("total_orders"),
            money("total_revenue").alias("total_revenue"),
            F.datediff(today, "first_order_date").alias("days_since_first_order"),
            F.datediff(today, last).alias("days_since_last_order"),
            rounded("mean_gap", 2).alias("avg_days_between_orders"),
            *[active(n).alias(f"is_active_{n}d") for n in (30, 60, 90)],
            *[
                F.coalesce(~active(n), F.lit(True)).alias(f"is_churned_{n}d")
                for n in (30, 60, 90)
            ],
            (F.col("total_orders") > 1).alias("is_repeat_customer"),
            "p.predicted_next_order_date",
            F.col("p.predicted_churn_probability").cast("double").alias("predicted_churn_probability"),
            money("p.predicted_lifetime_value").alias("predicted_ltv"),
            F.col("p.email_engagement_probability").cast("double").alias("email_engagement_probability"),
        )
    )


def customer_retention_cohorts_summary(wh: Warehouse, cohorts: DataFrame | None = None) -> DataFrame:
    cohorts = customer_retention_cohorts(wh) if cohorts is None else cohorts
    flags = {
        "repeat_customers": "is_repeat_customer",
        **{f"active_{n}d": f"is_active_{n}d" for n in (30, 60, 90)},
        **{f"churned_{n}d": f"is_churned_{n}d" for n in (30, 60, 90)},
    }
    means = {
        "avg_orders_per_customer": "total_orders",
        "avg_revenue_per_customer": "total_revenue",
        "avg_days_between_orders": "avg_days_between_orders",
        "avg_churn_probability": "predicted_churn_probability",
    }
    return (
        cohorts.groupBy("cohort_date")
        .agg(
            F.count("*").alias("cohort_size"),
            *[F.count_if(c).alias(name) for name, c in flags.items()],
            *[rounded(F.avg(c), 6).alias(name) for name, c in means.items()],
        )
        .orderBy(F.desc("cohort_date"))
    )


def recent_cohorts(wh: Warehouse, limit: int = 5) -> DataFrame:
    rows = customer_retention_cohorts_summary(wh).limit(limit)
    return rows.select(
        "*",
        ratio("active_30d", "cohort_size", 1, 100).alias("active_30d_pct"),
        ratio("active_90d", "cohort_size", 1, 100).alias("active_90d_pct"),
    )


def cohort_retention_pct(wh: Warehouse) -> DataFrame:
    return customer_retention_cohorts_summary(wh).select(
        "cohort_date",
        "cohort_size",
        "active_30d",
        "active_90d",
        ratio("active_90d", "cohort_size", 6, 100).alias("retention_90d_pct"),
    )


def high_churn_risk(wh: Warehouse, above: float = 0.5) -> DataFrame:
    people = wh.table("customers").select(F.col("id").alias("customer_id"), "email")
    return (
        customer_retention_cohorts(wh)
        .where(F.col("predicted_churn_probability") > above)
        .join(people, "customer_id")
        .select("email", "total_orders", "total_revenue", "predicted_churn_probability", "is_churned_30d")
        .orderBy(F.desc("predicted_churn_probability"), "email")
    )


def churn_risk_top5(wh: Warehouse, above: float = 0.7, limit: int = 5) -> DataFrame:
    risk = F.col("predicted_churn_probability")
    profiles = wh.table("klaviyo_profiles").select(F.col("id").alias("profile_id"), "email")
    return (
        wh.table("klaviyo_predictive_metrics")
        .where(risk > above)
        .join(profiles, "profile_id")
        .orderBy(risk.desc(), "email", "calculated_at")
        .limit(limit)
        .select(
            "email",
            risk.cast("double").alias("predicted_churn_probability"),
            money("predicted_lifetime_value").alias("predicted_lifetime_value"),
            "predicted_next_order_date",
        )
    )


def replenishment_priority(wh: Warehouse) -> DataFrame:
    """How soon inactive customers are expected to buy again."""
    due = F.col("predicted_next_order_date")
    people = wh.table("customers").select(F.col("id").alias("customer_id"), "email")

    def within(n: int) -> Column:
        return due <= F.lit(wh.as_of + dt.timedelta(days=n))

    priority = F.when(within(7), "IMMEDIATE").when(within(30), "SOON").otherwise("LATER")
    return (
        customer_retention_cohorts(wh)
        .where("predicted_next_order_date is not null and not is_active_30d")
        .join(people, "customer_id")
        .select(
            "email", due, "avg_days_between_orders", priority.alias("replenishment_priority")
        )
        .orderBy("predicted_next_order_date", "email")
    )


# --- summaries ------------------------------------------------------------------------

SUMMARY_MEANS = {
    "avg_repeat_purchase_rate": "repeat_purchase_rate",
    **{f"avg_active_customer_rate_{n}d": f"active_customer_rate_{n}d" for n in (30, 60, 90)},
    **{f"avg_churn_rate_{n}d": f"churn_rate_{n}d" for n in (30, 60, 90)},
    "avg_days_between_purchases": "avg_days_between_purchases",
    "avg_median_days_between_purchases": "median_days_between_purchases",
    "avg_ltv": "avg_ltv",
    "avg_median_ltv": "median_ltv",
    "avg_reorder_probability": "avg_reorder_probability",
    "avg_churn_probability": "avg_churn_probability",
    "avg_predicted_ltv": "avg_predicted_ltv",
    "avg_email_engagement_probability": "avg_email_engagement_probability",
    "avg_engagement_decay_rate": "engagement_decay_rate",
    "avg_winback_email_open_rate": "winback_email_open_rate",
    "avg_subscription_retention_rate": "subscription_retention_rate",
    "avg_replenishment_accuracy_days": "avg_replenishment_accuracy_days",
    "avg_ltv_cac_ratio": "avg_ltv_cac_ratio",
}


def retention_metrics_summary(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """Means of the daily values; customers and LTV are summed over days by design."""
    daily = retention_metrics_daily(wh) if daily is None else daily
    return daily.agg(
        F.sum("total_customers").alias("total_customers_all_time"),
        rounded(F.sum("total_ltv"), 2).alias("total_ltv_all_time"),
        *[rounded(F.avg(c), 6).alias(name) for name, c in SUMMARY_MEANS.items()],
    )


def retention_metrics_trends(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    daily = retention_metrics_daily(wh) if daily is None else daily
    return daily.select(
        "date",
        "total_customers",
        percent("repeat_purchase_rate"),
        *[percent(f"active_customer_rate_{n}d") for n in (30, 60, 90)],
        *[percent(f"churn_rate_{n}d") for n in (30, 60, 90)],
        "avg_days_between_purchases",
        "avg_ltv",
        percent("avg_reorder_probability"),
        percent("avg_churn_probability"),
        "engagement_decay_rate",
        percent("winback_email_open_rate"),
        percent("subscription_retention_rate"),
        "avg_replenishment_accuracy_days",
        "avg_ltv_cac_ratio",
    ).orderBy(F.desc("date"))


def retention_last_7_days(wh: Warehouse) -> DataFrame:
    week = default_calendar(wh).where(F.col("date") >= F.lit(days_before(wh.as_of, 7)))
    return retention_metrics_trends(wh, retention_metrics_daily(wh, week)).limit(7)


for _fn in (
    repeat_purchase_rate, avg_days_between_purchases, active_customer_rate, churn_rate, churn_rates,
    avg_ltv, avg_reorder_probability, subscription_retention_rate, replenishment_accuracy,
    avg_ltv_cac_ratio, retention_metrics_daily, customer_retention_cohorts,
    retention_metrics_summary, customer_retention_cohorts_summary, retention_metrics_trends,
    recent_cohorts, cohort_retention_pct, retention_last_7_days, high_churn_risk, churn_risk_top5,
    replenishment_priority,
):
    register(_fn.__name__, _fn)
for _fn in (engagement_decay_rate, winback_email_open_rate):
    register(_fn.__name__, lambda wh, fn=_fn: fn(wh, start=days_before(wh.as_of, 30), end=wh.as_of))
