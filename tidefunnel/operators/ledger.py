"""Running totals that a new day extends: changes by day and checkpoints of their sums.

Below ``root`` lie four tables.  ``facts/date=D`` holds one row with what day D adds to
each figure, ``people/date=D`` one row per person with an act on D.  ``marks/upto=D`` and
``held/upto=D`` hold the same two merged over all days up to D.  Figures of day D need
the newest checkpoint before D and the folders of the days behind it; neither the history
of facts nor the folders of other days are opened.

``begin`` stores history as one checkpoint.  Days behind it may be recorded again: that
replaces them and drops the checkpoints that contained them, so late rows and repeated
runs give what a first run with all rows gives.  Days up to the first checkpoint are
closed; rows that come later for them need a new ``begin``.  A checkpoint exists once its
folder in ``marks`` does, which is written last and dropped first.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidefunnel.operators.tables import drop_folders, folder_names, read_days, replace_days

Merge = Callable[[str], Column]


def _with(schema: StructType, name: str) -> StructType:
    return StructType([*[f for f in schema.fields if f.name not in ("date", "upto")], StructField(name, DateType())])


def merged(people: DataFrame, keys: list[str], merge: dict[str, Merge]) -> DataFrame:
    return people.groupBy(*keys).agg(*[how(c).alias(c) for c, how in merge.items()])


class DayLedger:
    """``facts`` and ``people`` are the stored schemas; a person's columns merge by ``merge``.

    Rows of people need not be merged when they are handed in.
    """

    def __init__(
        self, spark: SparkSession, root: str, facts: StructType, people: StructType, key: str, merge: dict[str, Merge]
    ) -> None:
        self.spark, self.root, self.key, self.merge = spark, root, key, merge
        self.schemas = {"facts": facts, "people": people, "marks": facts, "held": people}

    def _folder(self, name: str, part: str, days: list[dt.date]) -> DataFrame:
        """Rows of some days; their folders are named, so no others are listed."""
        return read_days(self.spark, f"{self.root}/{name}", _with(self.schemas[name], part), part, days)

    def _days(self, name: str, part: str) -> list[dt.date]:
        names = folder_names(self.spark, f"{self.root}/{name}")
        return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith(f"{part}="))

    def checkpoints(self) -> list[dt.date]:
        return self._days("marks", "upto")

    def recorded(self) -> list[dt.date]:
        """The days with facts behind the first checkpoint."""
        return self._days("facts", "date")

    def _forget(self, gone: list[dt.date]) -> None:
        for name in ("marks", "held"):
            drop_folders(self.spark, [f"{self.root}/{name}/upto={c}" for c in gone])

    def _typed(self, name: str, rows: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in self.schemas[name].fields}
        return rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])

    def begin(self, facts: DataFrame, people: DataFrame, upto: dt.date) -> None:
        """Store all days up to ``upto`` as the first checkpoint; forgets what was stored."""
        self._forget(self.checkpoints())
        drop_folders(self.spark, [f"{self.root}/facts", f"{self.root}/people"])
        self._merge(facts, people, upto)

    def record(self, facts: DataFrame, people: DataFrame, start: dt.date, end: dt.date) -> None:
        """Store the days in [start, end] instead of what was known of them."""
        held = self.checkpoints()
        if not held or start <= held[0]:
            raise ValueError(f"{start} is not behind the first checkpoint; begin again")
        self._forget([c for c in held if c >= start])
        days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
        replace_days(facts, f"{self.root}/facts", days)
        by_day = merged(people, [self.key, "date"], self.merge)
        replace_days(self._typed("people", by_day), f"{self.root}/people", days)

    def changes(self, start: dt.date, end: dt.date) -> tuple[DataFrame, DataFrame]:
        """Rows whose totals up to a day in [start, end] are that day's figures.

        A checkpoint's rows carry its own day as ``date``.
        """
        base = max(c for c in self.checkpoints() if c < start)
        days = [base + dt.timedelta(days=i) for i in range(1, (end - base).days + 1)]

        def rows(daily: str, base_name: str) -> DataFrame:
            held = self._folder(base_name, "upto", [base]).withColumnRenamed("upto", "date")
            return self._folder(daily, "date", days).unionByName(held)

        return rows("facts", "marks"), rows("people", "held")

    def checkpoint(self, upto: dt.date) -> None:
        """Merge the newest earlier checkpoint and the days behind it, up to ``upto``."""
        self._merge(*self.changes(upto, upto), upto)

    def _merge(self, facts: DataFrame, people: DataFrame, upto: dt.date) -> None:
        sums = facts.agg(*[F.sum(c).alias(c) for c in facts.columns if c != "date"])
        held = merged(people, [self.key], self.merge)
        for name, rows in (("held", held), ("marks", sums)):
            (
                self._typed(name, rows)
                .withColumn("upto", F.lit(upto))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("upto")
                .parquet(f"{self.root}/{name}")
            )
