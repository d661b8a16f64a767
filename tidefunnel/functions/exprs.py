"""Column expressions shared by all metrics.  Everything here stays JVM-side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str

# Vocabulary of the event tables (fixed values).
SUBSCRIBED = "Subscribed to List"
SENT = "Sent Email"
OPENED = "Opened Email"
CLICKED = "Clicked Email"
VIEWED_PAGE = "Viewed Page"
MAIL_TOUCHES = (OPENED, CLICKED)
MAIL_FUNNEL = (SENT, OPENED, CLICKED)
ACQUIRING = ("conversion", "purchase")
SOCIAL_PLATFORMS = ("instagram", "facebook", "tiktok", "twitter")
WINBACK_WORDS = ("winback", "re-engage", "reactivate")


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: ColumnLike) -> Column:
    return col(c).cast("double")


def rounded(c: ColumnLike, scale: int) -> Column:
    """Half-up rounding to a declared scale.

    The nudge of 1e-9 away from zero makes exact decimal ties come out half-up
    although the value is held as a double.
    """
    c = col(c)
    return F.round(c + F.signum(c) * 1e-9, scale)


def ratio(a: ColumnLike, b: ColumnLike, scale: int, times: float = 1) -> Column:
    """``times * a / b`` at a declared scale; NULL when ``b`` is zero or NULL."""
    value = F.try_divide(num(a), num(b))
    return rounded(value * times if times != 1 else value, scale)


def ratio0(a: ColumnLike, b: ColumnLike, scale: int, times: float = 1) -> Column:
    """As :func:`ratio`, but 0 instead of NULL."""
    return F.coalesce(ratio(a, b, scale, times), F.lit(0.0))


def money(c: ColumnLike) -> Column:
    """An exact decimal amount handed out as a double with two decimals."""
    return F.round(num(c), 2)


def mean(c: ColumnLike) -> Column:
    """Average as exact sum over count (decimal sums do not depend on order)."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)).cast("double"))


def day(c: ColumnLike) -> Column:
    return col(c).cast("date")


def midnight(d: dt.date) -> Column:
    return F.lit(dt.datetime(d.year, d.month, d.day).isoformat(sep=" ")).cast("timestamp_ntz")


def micros_between(start: ColumnLike, end: ColumnLike) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def span_seconds(start: ColumnLike, end: ColumnLike) -> Column:
    """Elapsed seconds with microsecond precision, as a double."""
    return micros_between(start, end) / F.lit(1e6)


def in_days(ts: ColumnLike, start: dt.date | None, end: dt.date | None) -> Column:
    """Timestamp falls on a day in [start, end]; open ends when None.

    Written as a half-open timestamp range so that it reaches the file
    statistics instead of hiding the column behind a cast.
    """
    ts = col(ts)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= midnight(start))
    if end is not None:
        cond = cond & (ts < midnight(end + dt.timedelta(days=1)))
    return cond


def in_dates(d: ColumnLike, start: dt.date | None, end: dt.date | None) -> Column:
    """Date column in [start, end]; open ends when None."""
    d = col(d)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (d >= F.lit(start))
    if end is not None:
        cond = cond & (d <= F.lit(end))
    return cond


def json_text(c: ColumnLike, key: str) -> Column:
    """Text of a top-level JSON key; JSON null and missing keys give NULL."""
    return F.get_json_object(col(c), f"$.{key}")


def tagged_vip(tags: ColumnLike = "tags") -> Column:
    tags = col(tags)
    return F.coalesce(
        F.array_contains(tags, "VIP") | F.array_contains(tags, "vip"), F.lit(False)
    )


def grouped(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Group by ``keys``, or one global row when there are none."""
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def base64url(text: Column) -> Column:
    """URL-safe base64 without padding or line breaks."""
    encoded = F.base64(text.cast("binary"))
    # byte-wise replace is far quicker on long texts than translate
    for old, new in (("\r\n", ""), ("+", "-"), ("/", "_")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return F.rtrim(encoded, F.lit("="))
