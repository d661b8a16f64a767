"""Joins and unions that stay exact and balanced on hot or missing keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 500_000  # of a table, for one task


def stack_sum(keys: list[str], frames: list[DataFrame], measures: list[str]) -> DataFrame:
    """Put partial results of the same groups together.

    Every frame carries ``keys`` and some of ``measures``.  Summing a union
    treats NULL keys as one group (a join on them would lose the row) and, with
    no keys, merges one-row aggregates without a product of tables.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    sums = [F.sum(m).alias(m) for m in measures]
    return stacked.groupBy(*keys).agg(*sums) if keys else stacked.agg(*sums)


def left_join_spread(
    left: DataFrame, right: DataFrame, keys: list[str], nullable: str, spread_by: str
) -> DataFrame:
    """Left join whose NULL-key rows do not pile up in one task.

    Rows with a NULL ``nullable`` key can match nothing, yet plain hashing
    sends them all to one partition.  A second join column gives them a
    partition by ``spread_by``; for all other rows it is 0 on both sides.
    """
    slot = F.when(
        F.col(nullable).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(1024))
    ).otherwise(F.lit(0).cast("long"))
    # pmod(.., 1) is 0 for every row, but not a literal that would fold away.
    zero = F.pmod(F.xxhash64(nullable), F.lit(1).cast("long"))
    return (
        left.withColumn("_slot", slot)
        .join(right.withColumn("_slot", zero), [*keys, "_slot"], "left")
        .drop("_slot")
    )


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` so that a task gets about ROWS of its ``rows``.

    What a task holds then does not grow with the table.  Tables that the session's
    partitions already cut so small are left to Spark, which also merges small ones.
    """
    parts = -(-rows // ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > usual else df
