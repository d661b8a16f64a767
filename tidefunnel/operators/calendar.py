"""Calendars of target days and totals along them.

Refreshing many days is one job over a calendar table, not one job per day.
Calendars and per-day totals hold one row per day, so their size is bounded by
the length of history, not by the amount of data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import day


def days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    n = (end - start).days + 1
    return spark.range(max(n, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date")
    )


def trailing_days(spark: SparkSession, as_of: dt.date, days: int) -> DataFrame:
    """``as_of`` and the ``days`` days before it."""
    return days_between(spark, as_of - dt.timedelta(days=days), as_of)


def source_range(source: DataFrame, when: str) -> DataFrame:
    """Every day from the first to the last one in ``source``."""
    ends = source.agg(F.min(day(when)).alias("lo"), F.max(day(when)).alias("hi"))
    return ends.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("date"))


def sampled_history(orders: DataFrame, when: str, as_of: dt.date, recent: int = 30) -> DataFrame:
    """``as_of``, the ``recent`` days before it and the 15th of earlier months.

    A month is sampled when it lies in [first month, month of as_of - recent].
    The walk starts on the first order's own day, so the very first sample may
    precede that order; a month only counts while the walk, standing on the
    15th after its first step, is still before ``as_of - recent``.
    """
    spark = orders.sparkSession
    limit = as_of - dt.timedelta(days=recent)
    first = orders.agg(F.min(day(when)).alias("lo")).where(F.col("lo") < F.lit(limit))
    mid = F.date_add(F.trunc("month", "month"), 14)
    months = first.select(
        "lo", F.explode(F.sequence(F.trunc("lo", "month"), F.lit(limit), F.expr("interval 1 month"))).alias("month")
    )
    samples = months.where((mid < F.lit(limit)) | (F.col("month") == F.trunc("lo", "month"))).select(
        mid.alias("date")
    )
    return trailing_days(spark, as_of, recent).union(samples).distinct().orderBy("date")


def session_days(events: DataFrame, as_of: dt.date, recent: int = 30, latest: int = 100) -> DataFrame:
    """The last ``recent`` days and the ``latest`` most recent days with sessions."""
    spark = events.sparkSession
    seen = (
        events.where("session_id is not null")
        .select(day("occurred_at").alias("date"))
        .distinct()
        .orderBy(F.desc("date"))
        .limit(latest)
    )
    return trailing_days(spark, as_of, recent - 1).union(seen).distinct().orderBy("date")


def running_totals(calendar: DataFrame, changes: DataFrame, measures: list[str]) -> DataFrame:
    """Total of all changes up to and including each calendar day.

    ``changes`` is reduced to one row per day before the ordered pass, which
    therefore sees at most one row per day of history.
    """
    marks = calendar.select("date", F.lit(True).alias("wanted"))
    per_day = (
        changes.where("date is not null")
        .select("date", *measures, F.lit(None).cast("boolean").alias("wanted"))
        .unionByName(marks, allowMissingColumns=True)
        .groupBy("date")
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("wanted").alias("wanted"))
    )
    upto = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals: list[Column] = [F.coalesce(F.sum(m).over(upto), F.lit(0)).alias(m) for m in measures]
    return per_day.select("date", *totals, "wanted").where("wanted").drop("wanted")
