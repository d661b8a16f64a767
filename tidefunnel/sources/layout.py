"""Entities laid out by date and customer: ranges open their folders only, customer joins move nothing.

``lay_out`` writes a table in folders by day or month, each cut into the same number of
buckets by the customer.  A metric bounded in time reads the folders of its range
(``Warehouse.between``); a join or grouping by the customer finds both sides in the same
buckets, so neither is shuffled.

A bucket is read by one task.  Buckets are therefore counted first, and a table whose
largest holds more than ``SKEW`` times the mean (a hot customer, many rows without one)
is laid out by date alone: its joins shuffle and adaptive execution can split them.

Rows without a date lie in a folder of their own and match no bounded range.  The list of
tables is written last; a run that ends before it leaves a folder that no reader accepts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidefunnel.functions.exprs import in_dates
from tidefunnel.sources.warehouse import Warehouse

PART = "_part"
SKEW = 4.0
LISTED = "name string, fields string, moment string, grain string, key string, buckets int"


@dataclass(frozen=True)
class Layout:
    """How a table lies: folders by ``grain`` of ``moment`` (or none), buckets by ``key``."""

    key: str
    moment: str | None = None
    grain: str = "day"


# Orders span years, so that folders by day and bucket would be many small files.
LAYOUTS = {
    "customers": Layout("id"),
    "shopify_orders": Layout("customer_id", "order_date", "month"),
    "shopify_events": Layout("customer_id", "occurred_at"),
    "klaviyo_events": Layout("customer_id", "occurred_at"),
    "ad_events": Layout("customer_id", "date"),
}


def _bucket(key: str, buckets: int) -> Column:
    """The number that bucketed tables give to a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _is_even(rows: DataFrame, key: str, buckets: int) -> bool:
    sizes = rows.groupBy(_bucket(key, buckets).alias("b")).count()
    found = sizes.agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    return not found.n or found.most * buckets <= SKEW * found.n


def _catalog_name(root: str, name: str) -> str:
    return f"laid_{hashlib.sha256(root.encode()).hexdigest()[:16]}_{name}"


def lay_out(wh: Warehouse, root: str, buckets: int, layouts: dict[str, Layout] = LAYOUTS) -> None:
    """Write the tables of ``layouts`` below ``root``, which must not exist.

    Rows are dealt by folder and bucket, so each bucket of a folder is one file and a
    customer's rows go to as many tasks as there are folders.
    """
    listed = []
    for name, how in layouts.items():
        rows = wh.table(name)
        even = _is_even(rows, how.key, buckets)
        listed.append((name, rows.schema.json(), how.moment, how.grain, how.key, buckets if even else 0))
        dealt = [_bucket(how.key, buckets)] if even else []
        if how.moment:
            rows = rows.withColumn(PART, F.trunc(how.moment, "month") if how.grain == "month" else F.to_date(how.moment))
            dealt.insert(0, F.col(PART))
        placed = rows.repartition(*dealt) if even else rows.hint("rebalance", *([PART] if how.moment else []))
        writer = placed.write.format("parquet").option("path", f"{root}/{name}")
        if how.moment:
            writer = writer.partitionBy(PART)
        if even:
            writer = writer.bucketBy(buckets, how.key)
        writer.saveAsTable(_catalog_name(root, name))
    wh.spark.createDataFrame(listed, LISTED).coalesce(1).write.parquet(f"{root}/layout")


def _attach(spark: SparkSession, root: str, listed) -> str:
    """The table's name in the catalog of this session, which may not know it yet."""
    table = _catalog_name(root, listed.name)
    if not spark.catalog.tableExists(table):
        fields = StructType.fromJson(json.loads(listed.fields)).fields
        if listed.moment:
            fields = [*fields, StructField(PART, DateType())]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parts = f"PARTITIONED BY ({PART})" if listed.moment else ""
        cut = f"CLUSTERED BY (`{listed.key}`) INTO {listed.buckets} BUCKETS" if listed.buckets else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} {cut} LOCATION '{root}/{listed.name}'")
        if listed.moment:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    return table


def open_layout(base: Warehouse, root: str) -> Warehouse:
    """A warehouse that reads laid-out tables from ``root`` and all others from ``base``."""
    spark = base.spark
    listed = {r.name: r for r in spark.read.schema(LISTED).parquet(f"{root}/layout").collect()}
    tables = {name: _attach(spark, root, row) for name, row in listed.items()}

    def load(name: str) -> DataFrame:
        return spark.table(tables[name]).drop(PART) if name in tables else base.table(name)

    def slice_of(name: str, column: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
        row = listed.get(name)
        if row is None or row.moment != column:
            return load(name)
        if row.grain == "month":
            start = start and start.replace(day=1)
        return spark.table(tables[name]).where(in_dates(PART, start, end)).drop(PART)

    return Warehouse(spark, load, base.as_of, base.names, base.raw_dir, slicer=slice_of)
