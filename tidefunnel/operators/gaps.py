"""Gaps between the purchase days of each customer.

Orders are first reduced to one row per customer and day.  From there on the
work per customer is bounded by the number of days in history, however many
orders a customer has, and pairs of orders are never written out as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import day


def order_days(paid: DataFrame) -> DataFrame:
    """Per customer and day of a paid order: its first and last moment."""
    return (
        paid.where("customer_id is not null")
        .groupBy("customer_id", day("order_date").alias("date"))
        .agg(F.min("order_date").alias("first_at"), F.max("order_date").alias("last_at"))
    )


def shortest_gaps(days: DataFrame) -> DataFrame:
    """Days from each purchase day to the next later order (0 on the same day)."""
    following = F.lead("date").over(Window.partitionBy("customer_id").orderBy("date"))
    return days.select(
        "customer_id",
        "date",
        F.when(F.col("first_at") < F.col("last_at"), F.lit(0))
        .otherwise(F.datediff(following, "date"))
        .alias("gap"),
    )


FEW = 16  # up to so many days the pairs are listed, which is cheaper than bitmaps
WORD = 63  # days of a bitmap word; the sign bit stays clear
NO_WORDS = "array<bigint>"


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("long"))


def _word(d: Column) -> Column:
    return F.floor(d / WORD).cast("int")


def _bit(d: Column) -> Column:
    return F.pmod(d, F.lit(WORD))


def _day_bits(days: Column) -> Column:
    """Bitmap of sorted days: words of 63 days from the word of the first to that of the last."""
    one = F.lit(1).cast("long")

    def word(w: Column) -> Column:
        own = F.filter(days, lambda d: _word(d) == w)
        return F.aggregate(
            own, F.lit(0).cast("long"), lambda bits, d: bits.bitwiseOR(F.call_function("shiftleft", one, _bit(d)))
        )

    return F.transform(F.sequence(_word(F.get(days, F.lit(0))), _word(F.element_at(days, -1))), word)


def _from_day(words: Column, first: Column, d: Column) -> Column:
    """The bitmap moved so that day ``d`` is bit 0: bit g stands for a purchase g days after it."""
    skip = _word(d) - _word(first)

    def joined(low: Column, high: Column) -> Column:
        carried = F.call_function("shiftleft", _zero(high), F.lit(WORD) - _bit(d))
        return F.call_function("shiftright", low, _bit(d)).bitwiseOR(carried.bitwiseAND(F.lit(2**WORD - 1)))

    return F.zip_with(
        F.slice(words, skip + 1, F.size(words)), F.slice(words, skip + 2, F.size(words)), joined
    )


def _moved(days: Column) -> Column:
    """Per purchase day: the day and the bitmap as seen from it."""
    return F.flatten(
        F.transform(
            F.array(_day_bits(days)),  # bound once for all days
            lambda words: F.transform(
                days, lambda d: F.struct(d.alias("since"), _from_day(words, F.get(days, F.lit(0)), d).alias("bits"))
            ),
        )
    )


def _set_bits(words: Column) -> Column:
    """Numbers of the set bits but bit 0 (the day itself)."""

    def of_word(w: Column, i: Column) -> Column:
        def lowest(acc: Column, _: Column) -> Column:
            x, less = acc["left"], acc["left"] - 1
            number = i * WORD + F.bit_count(x.bitwiseXOR(less)) - 1
            return F.struct(
                x.bitwiseAND(less).alias("left"), F.concat(acc["out"], F.array(number)).alias("out")
            )

        none = F.array().cast("array<int>")
        start = F.struct(w.alias("left"), none.alias("out"))
        steps = F.sequence(F.lit(1), F.bit_count(w))
        return F.when(w == 0, none).otherwise(F.aggregate(steps, start, lowest, lambda acc: acc["out"]))

    return F.filter(F.flatten(F.transform(words, of_word)), lambda g: g > 0)


def _listed(days: Column) -> Column:
    """(since, gap) of all pairs of a few days."""
    return F.flatten(
        F.transform(
            days,
            lambda d: F.transform(
                F.filter(days, lambda e: e > d), lambda e: F.struct(d.alias("since"), (e - d).alias("gap"))
            ),
        )
    )


def _days_per_customer(days: DataFrame, *aggs: Column) -> DataFrame:
    return days.groupBy("customer_id").agg(
        F.sort_array(F.collect_set(F.unix_date("date"))).alias("days"), *aggs
    )


def mean_distinct_gap(days: DataFrame) -> DataFrame:
    """Per customer: mean of the distinct day gaps over all pairs of orders.

    A customer's days are a bitmap; the bitmaps as seen from each of the days, put
    together by OR, hold the gaps, 63 of them in a step.
    """
    per_customer = _days_per_customer(days, F.max(F.col("first_at") < F.col("last_at")).alias("same_day"))
    held = F.aggregate(
        _moved(F.col("days")),
        F.array().cast(NO_WORDS),
        lambda seen, m: F.zip_with(seen, m["bits"], lambda x, y: _zero(x).bitwiseOR(_zero(y))),
    )
    pairs = F.array_distinct(F.transform(_listed(F.col("days")), lambda p: p["gap"]))
    apart = F.when(F.size("days") > FEW, _set_bits(held)).otherwise(pairs)
    gaps = F.when(F.col("same_day"), F.concat(F.array(F.lit(0)), apart)).otherwise(apart)
    total = F.aggregate("gaps", F.lit(0).cast("long"), lambda acc, g: acc + g)
    return per_customer.select("customer_id", gaps.alias("gaps")).select(
        "customer_id",
        F.try_divide(total.cast("double"), F.size("gaps").cast("double")).alias("mean_gap"),
    )


def gap_first_seen(days: DataFrame) -> DataFrame:
    """Each distinct gap over all customers, with the earliest day it starts on.

    Walking through a customer's days in order, only bits not met before are
    listed, so a customer of many days contributes each gap once; the result has
    at most one row per day of history.
    """
    empty = F.struct(
        F.array().cast(NO_WORDS).alias("seen"),
        F.array().cast("array<struct<since:int,gap:int>>").alias("out"),
    )

    def step(acc: Column, m: Column) -> Column:
        fresh = F.zip_with(m["bits"], acc["seen"], lambda x, y: _zero(x).bitwiseAND(F.bitwise_not(_zero(y))))
        return F.struct(
            F.zip_with(acc["seen"], m["bits"], lambda x, y: _zero(x).bitwiseOR(_zero(y))).alias("seen"),
            F.concat(
                acc["out"],
                F.transform(_set_bits(fresh), lambda g: F.struct(m["since"].alias("since"), g.alias("gap"))),
            ).alias("out"),
        )

    met = F.aggregate(_moved(F.col("days")), empty, step, lambda a: a["out"])
    spread = (
        _days_per_customer(days)
        .where(F.size("days") > 1)
        .select(F.explode(F.when(F.size("days") > FEW, met).otherwise(_listed(F.col("days")))).alias("o"))
        .select(F.date_from_unix_date("o.since").alias("since"), F.col("o.gap").alias("gap"))
    )
    same_day = days.where("first_at < last_at").select(
        F.col("date").alias("since"), F.lit(0).alias("gap")
    )
    return spread.union(same_day).groupBy("gap").agg(F.min("since").alias("since"))


def with_median_gap(rows: DataFrame, gaps: DataFrame, name: str) -> DataFrame:
    """Add the median of the gaps that have started by each row's ``date``.

    The gap table is bounded by the days of history, so it travels as one
    sorted array to the calendar rows.
    """
    listed = gaps.agg(F.sort_array(F.collect_list(F.struct("gap", "since")))).scalar()
    seen = F.transform(
        F.filter("gap_list", lambda g: g["since"] <= F.col("date")),
        lambda g: g["gap"].cast("double"),
    )
    n = F.size("gaps_seen")
    low = F.get("gaps_seen", F.floor((n - 1) / 2).cast("int"))
    high = F.get("gaps_seen", F.floor(n / 2).cast("int"))
    return (
        rows.withColumn("gap_list", listed)
        .withColumn("gaps_seen", seen)
        .withColumn(name, (low + high) / 2)
        .drop("gap_list", "gaps_seen")
    )
