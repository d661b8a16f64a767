"""Daily event counts kept up to date while events arrive.

Each micro-batch is reduced to one row for each day and type and stored as a change of
that day.  The watermark is the newest event minus LATENESS: a day that falls behind it
is closed, its changes become one folder and nothing of it is held any more.  A late
event is a change like any other; it goes the side way, where the day it belongs to,
and no other, is refreshed at once.  What is open is bounded by the days inside the
watermark and OPEN batches each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tidefunnel.operators.tables import drop_folders, folder_exists
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse
from tidefunnel.streaming.logs import compact, open_batches, stored, write_batch

LATENESS = dt.timedelta(days=2)
OPEN = 16  # batches that a day inside the watermark may have open
COUNTS = StructType(
    [StructField("event_type", StringType()), StructField("events", LongType()), StructField("date", DateType())]
)


def daily_counts(events: DataFrame) -> DataFrame:
    """Events per day and type of a batch DataFrame."""
    return events.groupBy(F.to_date("occurred_at").alias("date"), "event_type").agg(F.count("*").alias("events"))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("date", "event_type").agg(F.sum("events").alias("events"))


def store_counts(root: str, lateness: dt.timedelta = LATENESS, most_open: int = OPEN):
    """Sink: the batch's changes by day, then the days that are due are closed."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # events without a time belong to no day; a day and type is one row
        write_batch(daily_counts(batch.where("occurred_at is not null")), root, batch_id)
        opened = open_batches(spark, root, COUNTS)
        newest = newest_day(spark, root, opened.agg(F.max("date")).first()[0], batch_id)
        behind = F.col("date") < F.lit(newest) - F.lit(lateness)
        days = [r.date for r in opened.where(behind | (F.col("batches") > most_open)).collect()]
        compact(spark, root, COUNTS, days, batch_id, _summed)

    return store


def newest_day(spark: SparkSession, root: str, here: dt.date | None, batch_id: int) -> dt.date | None:
    """The newest day up to this batch; one row a batch keeps it, the last two are held."""
    path, schema = f"{root}/newest", "day date, batch long"
    past = spark.read.schema(schema).parquet(path).collect() if folder_exists(spark, path) else []
    past = [r for r in past if r.batch < batch_id]
    day = max((d for d in [here, *(r.day for r in past)] if d is not None), default=None)
    spark.createDataFrame([(day,)], "day date").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    last = max((r.batch for r in past), default=batch_id)
    drop_folders(spark, [f"{path}/batch={r.batch}" for r in past if r.batch < last])
    return day


def run_daily_counts(
    events: DataFrame, root: str, lateness: dt.timedelta = LATENESS, most_open: int = OPEN
) -> DataFrame:
    """Count all available events, batch by batch, and return the counts."""
    query = (
        events.select("occurred_at", "event_type")
        .writeStream.foreachBatch(store_counts(f"{root}/counts", lateness, most_open))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _summed(stored(events.sparkSession, f"{root}/counts", COUNTS)).select("date", "event_type", "events")


def stream_daily_event_counts(wh: Warehouse) -> DataFrame:
    files = wh.stream("events")
    return run_daily_counts(
        files.select(F.col("ts").cast("timestamp").alias("occurred_at"), "event_type"),
        work_folder(wh.spark, "daily-counts"),
    )


register("stream_daily_event_counts", stream_daily_event_counts)
