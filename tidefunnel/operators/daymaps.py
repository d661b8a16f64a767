"""Distinct counts over any range of days from stored bitmaps, without the events.

``ids`` numbers every key once, from 1, in the order of the days on which keys appear, so
the keys of a day lie close together.  ``maps/date=D`` holds, for each kind of event of
day D, bitmaps of the keys with such an event, cut into pieces of 32,768 numbers.  The OR
of the days' pieces counts each key once; nothing is estimated.

Recording a day again replaces its bitmaps; numbers stay as given.  Rows without a key
or a day are left out.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefunnel.operators.tables import folder_exists, read_days, replace_days, staged

SLOTS = 64  # a day's new keys are numbered in so many tasks
MAPS = "kind string, piece long, bits binary, date date"


class DayMaps:
    def __init__(self, spark: SparkSession, root: str, key_type: str = "string") -> None:
        self.spark, self.root, self.key_type = spark, root, key_type

    def ids(self) -> DataFrame:
        """key, number."""
        schema = f"key {self.key_type}, number long"
        if not folder_exists(self.spark, f"{self.root}/ids"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/ids")

    def _number(self, rows: DataFrame) -> None:
        """Give the keys that have none the next numbers."""
        fresh = staged(
            rows.groupBy("key")
            .agg(F.min("date").alias("date"))
            .join(self.ids(), "key", "left_anti")
            .withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(SLOTS))),
            "new-keys",
        )
        last = self.ids().agg(F.max("number")).first()[0] or 0
        # one row per day and slot, however many keys
        before = Window.orderBy("date", "slot").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            fresh.groupBy("date", "slot")
            .agg(F.count("*").alias("n"))
            .select("date", "slot", (F.coalesce(F.sum("n").over(before), F.lit(0)) + last).alias("offset"))
        )
        place = F.row_number().over(Window.partitionBy("date", "slot").orderBy("key"))
        numbered = fresh.withColumn("place", place).join(offsets, ["date", "slot"])
        numbered.select("key", (F.col("offset") + F.col("place")).alias("number")).write.mode("append").parquet(
            f"{self.root}/ids"
        )

    def record(self, events: DataFrame, days: list[dt.date] | None = None) -> None:
        """Store the bitmaps of ``events`` (key, kind, date); ``days`` names days that may be empty now."""
        rows = staged(events.where("key is not null and date is not null").distinct(), "day-keys")
        self._number(rows)
        maps = (
            rows.join(self.ids(), "key")
            .groupBy("date", "kind", F.bitmap_bucket_number("number").alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        )
        replace_days(maps.select("kind", "piece", "bits", "date"), f"{self.root}/maps", days)

    def counts(self, start: dt.date, end: dt.date, **kinds: tuple[str, ...]) -> DataFrame:
        """One row: number of distinct keys with any event of each group of kinds in [start, end]."""
        days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
        names = sorted({n for group in kinds.values() for n in group})
        maps = read_days(self.spark, f"{self.root}/maps", MAPS, "date", days).where(F.col("kind").isin(*names))

        def any_of(group: tuple[str, ...]) -> Column:
            return F.bitmap_count(F.bitmap_or_agg(F.when(F.col("kind").isin(*group), F.col("bits"))))

        pieces = maps.groupBy("piece").agg(*[any_of(group).alias(name) for name, group in kinds.items()])
        return pieces.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in kinds])
