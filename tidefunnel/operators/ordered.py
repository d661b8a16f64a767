"""Running aggregates along time that split even a single hot key.

A window over one key runs in one task.  Here the key's rows are cut into time
buckets; running values are computed inside each bucket, and bucket totals,
which are few, carry over from bucket to bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.operators.tables import staged

HOUR = 3_600_000_000  # microseconds


def floor_to(t: Column, width: int) -> Column:
    """Start of the ``width``-wide slot that holds ``t`` (exact on longs)."""
    return t - F.pmod(t, F.lit(width))


def running(
    rows: DataFrame,
    keys: list[str],
    bucket: str,
    order: list[str],
    sums: list[str],
    mins: list[str] = (),
    maxs: list[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Replace the named columns by their running value within ``keys``.

    Rows run in ``order`` (or backwards); ``bucket`` must not decrease along
    it.  The current row is included.
    """

    def direct(c: str) -> Column:
        return F.desc(c) if descending else F.asc(c)

    inside = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*[direct(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    across = (
        Window.partitionBy(*keys)
        .orderBy(direct(bucket))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    folds = {**{c: F.sum for c in sums}, **{c: F.min for c in mins}, **{c: F.max for c in maxs}}
    totals = rows.groupBy(*keys, bucket).agg(*[fold(c).alias(c) for c, fold in folds.items()])
    carried = totals.select(
        *keys, bucket, *[fold(c).over(across).alias(f"carry_{c}") for c, fold in folds.items()]
    )
    joined = rows.withColumns({c: fold(c).over(inside) for c, fold in folds.items()}).join(
        carried, [*keys, bucket]
    )
    merged: dict[str, Column] = {}
    for c in folds:
        here, before = F.col(c), F.col(f"carry_{c}")
        if c in sums:
            merged[c] = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        elif c in mins:
            merged[c] = F.least(here, before)
        else:
            merged[c] = F.greatest(here, before)
    return joined.withColumns(merged).drop(*[f"carry_{c}" for c in folds])


def total_order_sum(df: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """``df`` with the running sum of ``amount`` along one order of the whole table.

    Rows are dealt by ranges of the order, so tasks follow the session's number
    of partitions and not the table.  The dealt rows are written once: the bounds
    of the ranges are drawn from a sample and must not change between the two
    readers.  Sums of whole ranges, one row each, carry over.  Rows that are equal
    in ``order`` lie in one range and are summed in an arbitrary order.
    """
    dealt = df.repartitionByRange(*order).withColumns({"_part": F.spark_partition_id(), "_amount": amount})
    dealt = staged(dealt, "ranges")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = dealt.groupBy("_part").agg(F.sum("_amount").alias("_all"))
    carried = carried.select("_part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_carry"))
    # one row for each partition of the session
    placed = dealt.withColumn("_upto", F.sum("_amount").over(inside)).join(F.broadcast(carried), "_part")
    return placed.select(*df.columns, (F.col("_upto") + F.col("_carry")).alias(name))


def descending_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """SQL RANK by a non-null ``value``, highest first, without a one-task window.

    Equal values are counted together first, so a frequent value is one row of
    the order; the running count of the values before it is its rank.
    """
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    upto = total_order_sum(counts, [F.desc("_v")], F.col("_n"), "_upto")
    ranks = upto.select(F.col("_v").alias(value), (F.col("_upto") - F.col("_n") + 1).alias(name))
    return df.join(ranks, value)
