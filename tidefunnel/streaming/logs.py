"""Stored micro-batches: parquet folders by day and batch, compacted once a day is closed.

Below ``root`` lie ``open/date=D/batch=N`` with the rows that batch N brought for day D
and ``closed/date=D/upto=N`` with what all batches up to N come to.  A reader takes the
newest closed rows of a day and the open batches behind them, so a crash between
writing a closed folder and removing what it replaces changes nothing; a batch that is
run again replaces its own folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidefunnel.operators.tables import drop_folders, folder_exists


def write_batch(rows: DataFrame, root: str, batch_id: int) -> None:
    """Rows with a column ``date`` as the open rows of one batch.

    Each day is written by one task: files follow the days, not days times tasks.
    """
    dealt = rows.repartition("date")  # a hint does nothing in a stream, where plans do not adapt
    dealt.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("date", "batch").parquet(f"{root}/open")


def _read(spark: SparkSession, path: str, schema: StructType, number: str) -> DataFrame:
    whole = StructType([*schema.fields, StructField(number, LongType())])
    if not folder_exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def stored(spark: SparkSession, root: str, schema: StructType, days: list[dt.date] | None = None) -> DataFrame:
    """All rows that count, of the given days or of all; other days are not read."""
    opened = _read(spark, f"{root}/open", schema, "batch")
    closed = _read(spark, f"{root}/closed", schema, "upto")
    if days is not None:
        opened, closed = (d.where(F.col("date").isin(days)) for d in (opened, closed))
    # one row for each closed folder; partition columns only
    upto = closed.groupBy("date").agg(F.max("upto").alias("upto"))
    newest = closed.join(upto, ["date", "upto"], "left_semi").drop("upto")
    behind = opened.join(upto, "date", "left").where("upto is null or batch > upto").drop("batch", "upto")
    return newest.unionByName(behind)


def open_batches(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """(date, batches): how many folders each day has open."""
    opened = _read(spark, f"{root}/open", schema, "batch")
    return opened.groupBy("date").agg(F.countDistinct("batch").alias("batches"))


def compact(spark: SparkSession, root: str, schema: StructType, days: list[dt.date], batch_id: int, merge) -> None:
    """Replace the open batches of ``days`` up to ``batch_id`` by one closed folder each.

    ``merge`` reduces the rows of a day to what they come to.  Only these days are read.
    """
    if not days:
        return
    merged = merge(stored(spark, root, schema, days)).withColumn("upto", F.lit(batch_id).cast("long"))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "upto").parquet(
        f"{root}/closed"
    )
    # the folders that the closed ones replace; a reader skips them already
    old = _read(spark, f"{root}/open", schema, "batch").where(F.col("date").isin(days) & (F.col("batch") <= batch_id))
    gone = [f"{root}/open/date={r.date}/batch={r.batch}" for r in old.select("date", "batch").distinct().collect()]
    was = _read(spark, f"{root}/closed", schema, "upto").where(F.col("date").isin(days) & (F.col("upto") < batch_id))
    gone += [f"{root}/closed/date={r.date}/upto={r.upto}" for r in was.select("date", "upto").distinct().collect()]
    drop_folders(spark, gone)
