"""Written rollup tables: parquet partitioned by date, refreshed day by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidefunnel.session import work_folder


def replace_days(df: DataFrame, path: str, days: Iterable[dt.date] | None = None) -> None:
    """Replace the partitions of the days in ``df``; leave all others alone.

    ``days`` names the refreshed days when some of them may have no rows any
    more: their old partitions are removed.  Running it twice changes nothing.
    The rebalance hint splits a heavy day over several files and merges light
    ones.
    """
    seen = Observation("days written")
    observed = df.hint("rebalance", "date").observe(
        seen, F.collect_set(F.col("date").cast("string")).alias("days")
    )
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    written = set(seen.get["days"] or [])
    gone = [day.isoformat() for day in days or () if day.isoformat() not in written]
    drop_folders(df.sparkSession, [f"{path}/date={day}" for day in gone])


def replace_all(df: DataFrame, path: str) -> None:
    """Full rebuild of a table without day partitions."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read back with the schema of ``like`` (nothing is inferred)."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result once and go on from the written table.

    For results that several branches of one job read: Spark would compute
    each branch from the facts again.  The table lies in the shared folder, so
    lost executors cost nothing but their running tasks.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _file_system(spark, folder)
    return fs.exists(path)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, path = _file_system(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def read_days(
    spark: SparkSession, path: str, schema: StructType | str, part: str, days: Iterable[dt.date]
) -> DataFrame:
    """Rows of some days of a table in folders by day; no other folders are listed."""
    held = set(folder_names(spark, path))
    wanted = [f"{path}/{part}={d}" for d in days if f"{part}={d}" in held]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*wanted)


def drop_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Remove partitions that have no rows any more."""
    for folder in folders:
        fs, path = _file_system(spark, folder)
        if fs.exists(path):
            fs.delete(path, True)
