"""Which mail touches earn the credit for an order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import MAIL_TOUCHES, micros_between, rounded
from tidefunnel.operators.ordered import HOUR, floor_to, running
from tidefunnel.operators.tables import staged
from tidefunnel.registry import register
from tidefunnel.sources.warehouse import Warehouse

WEEK = 7 * 24 * HOUR
EPOCH = dt.datetime(1970, 1, 1)


def micros(ts: str) -> Column:
    """A timestamp as microseconds on one time line."""
    return micros_between(F.lit(EPOCH.isoformat(sep=" ")).cast("timestamp_ntz"), ts)


def order_moments(wh: Warehouse) -> DataFrame:
    return (
        wh.table("shopify_orders")
        .where("customer_id is not null")
        .select(
            "customer_id",
            F.col("id").alias("order_id"),
            micros("order_date").alias("t"),
            F.col("total_price").cast("double").alias("value"),
        )
    )


def mail_touches(wh: Warehouse) -> DataFrame:
    return (
        wh.table("klaviyo_events")
        .where(F.col("event_type").isin(*MAIL_TOUCHES) & F.col("customer_id").isNotNull())
        .select(
            "customer_id",
            micros("occurred_at").alias("t"),
            F.col("id").alias("touch_id"),
            "event_type",
            "campaign_id",
            "occurred_at",
        )
    )


def _weight(t: Column, half_life: int | None, lookback: int) -> Column:
    """Weight of a touch relative to the start of its lookback-wide block."""
    if half_life is None:
        return F.lit(1.0)
    return F.pow(F.lit(2.0), F.pmod(t, F.lit(lookback)) / F.lit(float(half_life)))


def _block_decay(half_life: int | None, lookback: int) -> float:
    return 1.0 if half_life is None else 2.0 ** (-lookback / half_life)


def _slots(rows: DataFrame, lookback: int) -> DataFrame:
    return rows.withColumns(
        {"block": floor_to(F.col("t"), lookback), "hour": floor_to(F.col("t"), HOUR)}
    )


SLOT_KEYS = ["customer_id", "block"]


def touch_windows(
    orders: DataFrame, touches: DataFrame, lookback: int = WEEK, half_life: int | None = None
) -> DataFrame:
    """Per order: the touches in [t - lookback, t), without listing them.

    Gives their number, their summed weight and the first and the last one;
    orders without a touch are left out.  Time is cut into blocks as wide as
    the lookback, so a window is the tail of one block and the head of the
    next; both are running aggregates over touches and order marks.  Weights
    are relative to the block start: no overflow, and only sums of positive
    numbers.
    """
    seen = F.struct("t", "touch_id", "event_type", "campaign_id", "occurred_at")
    points = touches.select(
        "customer_id",
        "t",
        F.lit(1).alias("rank"),
        F.lit(None).cast(orders.schema["order_id"].dataType).alias("order_id"),
        F.lit(1).alias("n"),
        _weight(F.col("t"), half_life, lookback).alias("w"),
        seen.alias("first"),
        seen.alias("last"),
    )

    def marks(shift: int) -> DataFrame:
        # rank 0: a mark stands before touches of the same moment
        return orders.select(
            "customer_id", (F.col("t") - F.lit(shift)).alias("t"), F.lit(0).alias("rank"), "order_id"
        )

    def along(marked: DataFrame, descending: bool) -> DataFrame:
        rows = _slots(points.unionByName(marked, allowMissingColumns=True), lookback)
        ran = running(
            rows, SLOT_KEYS, "hour", ["t", "rank"], ["n", "w"], ["first"], ["last"], descending
        )
        return ran.where("rank = 0").select("customer_id", "order_id", "n", "w", "first", "last")

    head = along(marks(0), descending=False)
    tail = along(marks(lookback), descending=True).withColumn(
        "w", F.col("w") * _block_decay(half_life, lookback)
    )
    return (
        head.unionByName(tail)
        .groupBy("customer_id", "order_id")
        .agg(
            F.sum("n").alias("n"),
            F.sum("w").alias("w"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .where("n > 0")
    )


def touch_credit(
    orders: DataFrame, touches: DataFrame, lookback: int = WEEK, half_life: int | None = None
) -> DataFrame:
    """Credit of every touch from all orders within ``lookback`` after it.

    ``orders`` has customer_id, t and the shares ``share`` (of an order) and
    ``amount`` (of its value) that a touch of weight 1 gets.  The orders after
    a touch are the tail of its block and the head of the next one.
    """
    points = orders.select(
        "customer_id", "t", F.lit(0).alias("rank"), "share", "amount"
    )

    def marks(shift: int) -> DataFrame:
        # rank 1: orders of the mark's own moment lie before it
        return touches.select(
            "customer_id",
            (F.col("t") + F.lit(shift)).alias("t"),
            F.lit(1).alias("rank"),
            "event_type",
            "campaign_id",
            _weight(F.col("t"), half_life, lookback).alias("w"),
        )

    def along(marked: DataFrame, descending: bool) -> DataFrame:
        rows = _slots(points.unionByName(marked, allowMissingColumns=True), lookback)
        ran = running(rows, SLOT_KEYS, "hour", ["t", "rank"], ["share", "amount"], descending=descending)
        return ran.where("rank = 1").select("event_type", "campaign_id", "w", "share", "amount")

    later = along(marks(0), descending=True)
    decay = _block_decay(half_life, lookback)
    next_block = along(marks(lookback), descending=False).withColumn("w", F.col("w") * decay)
    return later.unionByName(next_block).select(
        "campaign_id",
        "event_type",
        (F.col("share") * F.col("w")).alias("credited_orders"),
        (F.col("amount") * F.col("w")).alias("credited_revenue"),
    )


def _by_channel(credit: DataFrame) -> DataFrame:
    return (
        credit.groupBy("campaign_id", "event_type")
        .agg(
            rounded(F.sum("credited_orders"), 4).alias("credited_orders"),
            rounded(F.sum("credited_revenue"), 4).alias("credited_revenue"),
        )
        .where("credited_orders > 0")
    )


def _with_shares(orders: DataFrame, windows: DataFrame, per_weight: Column) -> DataFrame:
    """Orders with touches, staged because the credit passes read them repeatedly."""
    shares = orders.join(windows, ["customer_id", "order_id"]).select(
        "customer_id",
        "t",
        "value",
        "n",
        "first",
        "last",
        per_weight.alias("share"),
        (F.col("value") * per_weight).alias("amount"),
    )
    return staged(shares, "order-shares")


def multi_touch_linear(wh: Warehouse, lookback: int = WEEK) -> DataFrame:
    """Every touch of an order gets the same credit."""
    orders, touches = order_moments(wh), mail_touches(wh)
    shares = _with_shares(orders, touch_windows(orders, touches, lookback), 1 / F.col("n"))
    return _by_channel(touch_credit(shares, touches, lookback))


def multi_touch_time_decay(
    wh: Warehouse, lookback: int = WEEK, half_life: int = WEEK
) -> DataFrame:
    """A touch ``half_life`` before another gets half of its credit."""
    orders, touches = order_moments(wh), mail_touches(wh)
    windows = touch_windows(orders, touches, lookback, half_life)
    shares = _with_shares(orders, windows, 1 / F.col("w"))
    return _by_channel(touch_credit(shares, touches, lookback, half_life))


def multi_touch_position(wh: Warehouse, lookback: int = WEEK) -> DataFrame:
    """40 % for the first and the last touch, 20 % for those between.

    Up to two touches share evenly.  All touches get the middle share; the
    first and the last of three or more get the rest of their 40 % on top.
    """
    orders, touches = order_moments(wh), mail_touches(wh)
    n = F.col("n")
    middle = F.when(n > 2, 0.2 / (n - 2)).otherwise(1 / n)
    shares = _with_shares(orders, touch_windows(orders, touches, lookback), middle)
    extra = F.lit(0.4) - F.col("share")
    ends = (
        shares.where("n > 2")
        .select("value", extra.alias("extra"), F.explode(F.array("first", "last")).alias("touch"))
        .select(
            "touch.campaign_id",
            "touch.event_type",
            F.col("extra").alias("credited_orders"),
            (F.col("extra") * F.col("value")).alias("credited_revenue"),
        )
    )
    return _by_channel(touch_credit(shares, touches, lookback).unionByName(ends))


def last_touch_attribution(wh: Warehouse, lookback: int = WEEK) -> DataFrame:
    """The latest opened or clicked mail in the seven days before each order."""
    windows = touch_windows(order_moments(wh), mail_touches(wh), lookback)
    return windows.select(
        "order_id",
        F.col("last.event_type").alias("last_touch"),
        "last.campaign_id",
        "last.occurred_at",
    )


def first_touch_attribution(wh: Warehouse) -> DataFrame:
    """Per order and event type: the customer's first mail event up to the order.

    The first event of a type does not depend on the order, only whether it
    counts does, so orders meet one row per customer and event type.
    """
    firsts = (
        wh.table("klaviyo_events")
        .where("customer_id is not null")
        .groupBy("customer_id", "event_type")
        .agg(F.min("occurred_at").alias("first_touch_date"))
    )
    orders = wh.table("shopify_orders").select(
        F.col("id").alias("order_id"), "customer_id", "order_date"
    )
    return (
        orders.join(firsts, "customer_id")
        .where("first_touch_date <= order_date")
        .select("order_id", F.col("event_type").alias("first_touch"), "first_touch_date")
    )


for _fn in (
    last_touch_attribution, first_touch_attribution, multi_touch_linear, multi_touch_time_decay,
    multi_touch_position,
):
    register(_fn.__name__, _fn)
