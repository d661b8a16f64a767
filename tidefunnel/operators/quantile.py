"""Exact median without bringing all values into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000


def exact_median(values: DataFrame, column: str, name: str) -> DataFrame:
    """One row with the interpolated median (NULL when there are no values).

    A sketch, whose rank error is at most n / ACCURACY, gives two bounds that
    surely enclose the median.  Only the distinct values between them, some
    n / 20,000, go through the ordered pass; all others are merely counted.
    """
    values = values.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    slack = 2.0 / ACCURACY
    bounds = values.agg(
        F.percentile_approx("v", [0.5 - slack, 0.5 + slack], ACCURACY).alias("b")
    ).scalar()
    marked = values.select("v", bounds.alias("b"))
    below = F.count_if(F.col("v") < F.col("b")[0])
    sizes = marked.agg(F.count("*").alias("n"), below.alias("below"))
    middle = marked.where("v between b[0] and b[1]").groupBy("v").agg(F.count("*").alias("times"))
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = middle.select("v", "times", F.sum("times").over(upto).alias("upto")).select(
        "v", "times", "upto", sizes.select(F.struct("n", "below")).scalar().alias("s")
    )
    last = F.col("s.below") + F.col("upto")
    first = last - F.col("times") + 1
    n = F.col("s.n")
    # ranks of the lower and upper middle value, counted from 1
    low, high = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    return ranked.agg(
        (
            (
                F.max(F.when(low.between(first, last), F.col("v"))).cast("double")
                + F.max(F.when(high.between(first, last), F.col("v"))).cast("double")
            )
            / 2
        ).alias(name)
    )
