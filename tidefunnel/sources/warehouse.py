"""Typed access to the business entities, whatever they are stored as."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidefunnel.functions.exprs import in_dates, in_days
from tidefunnel.sources.mapping import ENTITIES
from tidefunnel.sources.mapping_mail import raw_messages
from tidefunnel.sources.schemas import ENTITY_SCHEMAS, MAILBOX_SCHEMAS, RAW_SCHEMAS

FIXTURE_AS_OF = dt.date(2024, 1, 30)


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw parquet table with its declared schema (no inference pass)."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class Warehouse:
    """Hands out entity DataFrames by name and carries the ``as_of`` date.

    ``as_of`` stands in for the wall clock so that every metric is repeatable.
    """

    def __init__(
        self,
        spark: SparkSession,
        loader: Callable[[str], DataFrame],
        as_of: dt.date,
        names: tuple[str, ...],
        raw_dir: str | None = None,
        streamer: Callable[[str], DataFrame] | None = None,
        slicer: Callable[..., DataFrame] | None = None,
    ) -> None:
        # One time zone for all stored moments; days begin at UTC midnight.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.as_of = as_of
        self.names = names
        self.raw_dir = raw_dir
        self._loader = loader
        self._streamer = streamer
        self._slicer = slicer
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loader(name)
        return self._frames[name]

    def between(self, name: str, column: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
        """Rows of a table whose date or moment falls on a day in [start, end].

        A table laid out by that column opens the folders of the range only.
        """
        rows = self._slicer(name, column, start, end) if self._slicer else self.table(name)
        inside = in_dates if isinstance(rows.schema[column].dataType, DateType) else in_days
        return rows.where(inside(column, start, end))

    def stream(self, name: str) -> DataFrame:
        """A table as a stream of its files."""
        if self._streamer is None:
            raise ValueError("this warehouse has no files to stream")
        return self._streamer(name)

    def raw(self, name: str) -> DataFrame:
        """A raw parquet table of the fixture folder."""
        if self.raw_dir is None:
            raise ValueError("this warehouse has no folder of raw tables")
        return read_raw(self.spark, self.raw_dir, name)

    @classmethod
    def from_fixture(
        cls, spark: SparkSession, sf_dir: str, as_of: dt.date = FIXTURE_AS_OF
    ) -> Warehouse:
        """Entities derived from the raw parquet tables by the fixture mapping."""
        return cls(
            spark,
            lambda name: _mapped(spark, sf_dir, name),
            as_of,
            tuple(ENTITIES),
            sf_dir,
            lambda name: _mapped_stream(spark, sf_dir, name),
        )

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, as_of: dt.date) -> Warehouse:
        """Entities stored as parquet folders under ``root``, one per entity."""

        schemas = ENTITY_SCHEMAS | MAILBOX_SCHEMAS

        def load(name: str) -> DataFrame:
            return spark.read.schema(schemas[name]).parquet(f"{root}/{name}")

        def stream(name: str) -> DataFrame:
            return spark.readStream.schema(schemas[name]).parquet(f"{root}/{name}")

        return cls(spark, load, as_of, tuple(ENTITY_SCHEMAS), streamer=stream)

    @classmethod
    def from_frames(
        cls, spark: SparkSession, frames: dict[str, DataFrame], as_of: dt.date = FIXTURE_AS_OF
    ) -> Warehouse:
        """Entities given as DataFrames (hand-made tables, temp views, streams)."""
        return cls(spark, frames.__getitem__, as_of, tuple(frames))

    def register_views(self, prefix: str = "") -> None:
        """Expose every entity to ``spark.sql`` as a temp view."""
        for name in self.names:
            self.table(name).createOrReplaceTempView(prefix + name)


def _mapped_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files, one a batch, be it one file or a folder of parts."""
    base = "documents" if name == "messages" else name
    # as a pattern, the path may name a file as well as a folder
    files = spark.readStream.schema(RAW_SCHEMAS[base]).option("maxFilesPerTrigger", 1)
    rows = files.parquet(f"{sf_dir}/{base}.parque[t]")
    return raw_messages(rows) if name == "messages" else rows


def _mapped(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "messages":
        return raw_messages(read_raw(spark, sf_dir, "documents"))
    entity = ENTITIES[name]
    if name == "customers":
        base = _customers_base(spark, sf_dir)
    elif name == "klaviyo_flow_steps":
        # Five steps per flow: the region table has a fixed five rows.
        steps = read_raw(spark, sf_dir, "region").select(F.collect_list("r_regionkey")).scalar()
        base = read_raw(spark, sf_dir, "nation").select("*", F.explode(steps).alias("r_regionkey"))
    elif name == "klaviyo_predictive_metrics":
        snapshots = F.explode(F.array(F.lit(0), F.lit(10))).alias("k")
        base = read_raw(spark, sf_dir, "customer").select("c_custkey", snapshots).alias("s")
    else:
        base = read_raw(spark, sf_dir, entity.base)
    if entity.where:
        base = base.where(entity.where)
    out = base.selectExpr(*[f"{expr} as {col}" for col, expr in entity.columns])
    if name == "customers":
        tags = F.when(F.col("tag").isNotNull(), F.array("tag")).alias("tags")
        out = out.select("*", tags).drop("tag")
    return out


def _customers_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = (
        _mapped(spark, sf_dir, "shopify_orders")
        .where("financial_status = 'paid'")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("total_price").alias("rev"),
            F.min(F.col("order_date").cast("date")).alias("f"),
            F.max(F.col("order_date").cast("date")).alias("l"),
        )
    )
    people = read_raw(spark, sf_dir, "customer").alias("c")
    return people.join(paid.alias("o"), F.expr("o.customer_id = c.c_custkey"), "left")
