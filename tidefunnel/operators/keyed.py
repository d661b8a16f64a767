"""Tables cut into buckets by their key: a merge rewrites only the buckets it touches.

Below ``root`` lie ``data/version=V/bucket=B`` and ``commits/version=V``, which lists the
buckets that version V wrote.  The live files of a bucket are those of its newest
committed version; the files of all other buckets stay as they are.  A run that ends
before its commit leaves files that no reader sees, and the next run takes their number.
One writer at a time.

Rows carry the change that wrote them ('insert' or 'update', NULL if they were only
copied), so the changes of a version are read from its own files.  Rows without a
whole key match nothing and lie in the bucket of the parts they have.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidefunnel.operators.merge import keyed_merge
from tidefunnel.operators.tables import drop_folders, folder_exists, staged

CHANGE = "_change"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], buckets: int) -> None:
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root, schema, keys, buckets

    @classmethod
    def create(cls, content: DataFrame, root: str, keys: list[str], buckets: int) -> KeyedTable:
        """Write ``content``, whose keys do not repeat, as the first version."""
        spark = content.sparkSession
        table = cls(spark, root, content.schema, keys, buckets)
        meta = [(content.schema.json(), keys, buckets)]
        spark.createDataFrame(meta, "schema string, keys array<string>, buckets int").write.parquet(f"{root}/meta")
        table._commit(content.withColumn(CHANGE, F.lit("insert")), 0, list(range(buckets)))
        return table

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> KeyedTable:
        meta = spark.read.parquet(f"{root}/meta").first()
        return cls(spark, root, StructType.fromJson(json.loads(meta["schema"])), list(meta["keys"]), meta.buckets)

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> dict[int, int]:
        """The live version of each bucket that has rows; as many entries as buckets at most."""
        commits = self.spark.read.schema("bucket int, rows boolean, version int").parquet(f"{self.root}/commits")
        newest = commits.groupBy("bucket").agg(F.max_by("rows", "version").alias("rows"), F.max("version").alias("v"))
        return {r.bucket: r.v for r in newest.where("rows").collect()}

    def last_version(self) -> int:
        commits = self.spark.read.schema("bucket int, rows boolean, version int").parquet(f"{self.root}/commits")
        return commits.agg(F.max("version")).first()[0]

    def _files(self, paths: list[str], changes: bool = False) -> DataFrame:
        fields = [*self.schema.fields, StructField(CHANGE, StringType())] if changes else self.schema.fields
        schema = StructType(fields)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The live rows, of all or of the given buckets; no other files are opened."""
        live = self.versions()
        wanted = sorted(live) if buckets is None else [b for b in buckets if b in live]
        return self._files([f"{self.root}/data/version={live[b]}/bucket={b}" for b in wanted])

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The live rows of some keys; reads the buckets of these keys only."""
        keys = self._typed(keys.select(*self.keys))
        buckets = [r.b for r in keys.select(self.bucket_of().alias("b")).distinct().collect()]
        return self.read(buckets).join(keys.distinct(), self.keys, "left_semi")

    def _typed(self, rows: DataFrame) -> DataFrame:
        """Columns of the table in its own types, because a hash depends on the type."""
        return rows.withColumns({c: F.col(c).cast(self.schema[c].dataType) for c in rows.columns if c in self.schema.names})

    def merge(
        self, batch: DataFrame, update: list[str], order_by: list[str], stamp: tuple[str, Column] | None = None
    ) -> list[int]:
        """Upsert as :func:`keyed_merge` does; returns the buckets that were rewritten."""
        rows = staged(self._typed(batch).withColumn("_bucket", self.bucket_of()), "merge-batch")
        touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())
        if touched:
            merged = keyed_merge(self.read(touched), rows.drop("_bucket"), self.keys, update, order_by, stamp, CHANGE)
            self._commit(merged, self.last_version() + 1, touched)
        return touched

    def _commit(self, content: DataFrame, version: int, touched: list[int]) -> None:
        path = f"{self.root}/data/version={version}"
        placed = content.withColumn("bucket", self.bucket_of()).hint("rebalance", "bucket")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)
        full = [b for b in touched if folder_exists(self.spark, f"{path}/bucket={b}")]
        listed = self.spark.createDataFrame([(b, b in set(full)) for b in touched], "bucket int, rows boolean")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")

    def changes(self, after: int) -> DataFrame:
        """Rows written by versions behind ``after`` as they were then: columns, change, version."""
        out = self._files([], True).withColumn("version", F.lit(0))
        for version in range(after + 1, self.last_version() + 1):
            path = f"{self.root}/data/version={version}"
            if folder_exists(self.spark, path):
                rows = self._files([path], True).where(F.col(CHANGE).isNotNull())
                out = out.unionByName(rows.withColumn("version", F.lit(version)))
        return out.withColumnRenamed(CHANGE, "change")

    def vacuum(self) -> None:
        """Remove files that no reader needs any more (and with them old changes)."""
        live = self.versions()
        gone = []
        for version in range(self.last_version() + 1):
            path = f"{self.root}/data/version={version}"
            gone += [
                f"{path}/bucket={b}"
                for b in range(self.buckets)
                if live.get(b) != version and folder_exists(self.spark, f"{path}/bucket={b}")
            ]
        drop_folders(self.spark, gone)
