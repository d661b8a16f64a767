"""An inverted-list index of vectors that outlives the call.

A folder holds the centres of the cells (written once, fitted on a bounded sample)
and the vectors, partitioned by the cell of their nearest centre.  New vectors are
assigned to the stored centres and appended; a vector that is stored already is
replaced, and only the cells that lose or gain a changed row are rewritten.  A search
gives each question the cells of its nearest centres: few questions scan just these
partitions, many meet them in tiles cell by cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefunnel.operators import vectors
from tidefunnel.operators.tables import drop_folders, staged
from tidefunnel.operators.vectors import matrix, usable

SAMPLE = 50_000  # vectors that the centres are fitted on, about


def train_centres(corpus: DataFrame, cells: int, sample: int = SAMPLE, seed: int = 7) -> np.ndarray:
    """Centres by cosine k-means over a sample of about ``sample`` vectors, drawn by a hash of the id."""
    rows = usable(corpus)
    share = min(1.0, sample / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(seed), "email_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    features = drawn.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine", featuresCol="features", maxIter=10).fit(features)
    return np.array(model.clusterCenters())


def nearest_cells(rows: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the ``probes`` centres with the highest cosine for each vector."""
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return np.argsort(-(rows @ unit.T), axis=1, kind="stable")[:, :probes]


class VectorIndex:
    """Vectors of one length in cells below ``root``; rows are (email_id, embedding)."""

    def __init__(self, spark: SparkSession, root: str, centres: np.ndarray, id_type: str) -> None:
        self.spark, self.root, self.centres, self.id_type = spark, root, centres, id_type

    @classmethod
    def create(cls, corpus: DataFrame, root: str, cells: int, sample: int = SAMPLE) -> VectorIndex:
        """Fit and write the centres; the cells are empty until ``add``."""
        centres = train_centres(corpus, cells, sample)
        id_type = corpus.schema["email_id"].dataType.simpleString()
        rows = [(n, id_type, [float(x) for x in c]) for n, c in enumerate(centres)]
        spark = corpus.sparkSession
        spark.createDataFrame(rows, "cell int, id_type string, centre array<double>").write.parquet(f"{root}/centres")
        index = cls(spark, root, centres, id_type)
        empty = spark.createDataFrame([], f"email_id {id_type}, embedding array<float>, cell int")
        empty.write.parquet(index.path)
        return index

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> VectorIndex:
        rows = spark.read.parquet(f"{root}/centres").orderBy("cell").collect()
        return cls(spark, root, np.array([r.centre for r in rows]), rows[0].id_type)

    @property
    def path(self) -> str:
        return f"{self.root}/cells"

    def table(self) -> DataFrame:
        """All stored rows: email_id, embedding, cell."""
        schema = f"email_id {self.id_type}, embedding array<float>, cell int"
        return self.spark.read.schema(schema).parquet(self.path)

    def _fitting(self, rows: DataFrame) -> DataFrame:
        return usable(rows).where(F.size("embedding") == self.centres.shape[1])

    def placed(self, rows: DataFrame) -> DataFrame:
        """(email_id, embedding, cell) of usable vectors; of a repeated id the least vector."""
        centres, kind = self.centres, self.id_type

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cell = nearest_cells(matrix(batch.column("embedding")), centres, 1)[:, 0]
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["email_id", "embedding", "cell"])

        once = self._fitting(rows).where("email_id is not null").groupBy("email_id").agg(
            F.min(F.col("embedding").cast("array<float>")).alias("embedding")
        )
        return once.mapInArrow(assign, f"email_id {kind}, embedding array<float>, cell int")

    def add(self, rows: DataFrame) -> list[int]:
        """Store vectors; returns the cells that were rewritten (new vectors are only appended).

        A row that is stored as it is stays where it lies, so a repeated call changes nothing.
        """
        new = staged(self.placed(rows), "index-batch")
        ids = self.table().select("email_id", F.col("cell").alias("old_cell"), F.xxhash64("embedding").alias("old"))
        met = staged(
            new.select("email_id", "cell", F.xxhash64("embedding").alias("now"))
            .join(ids, "email_id", "left")
            .select("email_id", "cell", "old_cell", F.coalesce(F.col("old") == F.col("now"), F.lit(False)).alias("same")),
            "index-known",
        )
        fresh = new.join(met.where("old_cell is null").select("email_id"), "email_id", "left_semi")
        self._write(fresh, "append")
        changed = met.where("old_cell is not null and not same")
        touched = changed.select(F.explode(F.array("cell", "old_cell")).alias("cell")).distinct()
        cells = sorted(r.cell for r in touched.collect())  # no more than there are cells
        if cells:
            ids = changed.select("email_id")
            kept = self.table().where(F.col("cell").isin(cells)).join(ids, "email_id", "left_anti")
            content = kept.unionByName(new.join(ids, "email_id", "left_semi"))
            self._replace(staged(content, "index-cells"), cells)
        return cells

    def _write(self, rows: DataFrame, mode: str) -> None:
        writer = rows.select("email_id", "embedding", "cell").hint("rebalance", "cell").write
        writer.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("cell").parquet(self.path)

    def _replace(self, content: DataFrame, cells: list[int]) -> None:
        self._write(content, "overwrite")
        left = {r.cell for r in content.select("cell").distinct().collect()}
        drop_folders(self.spark, [f"{self.path}/cell={c}" for c in cells if c not in left])

    def search(self, questions: DataFrame, k: int, probes: int) -> DataFrame:
        """The k nearest stored rows of each question among the cells of its ``probes`` nearest centres."""
        centres = self.centres
        kind = questions.schema["question_id"].dataType.simpleString()

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cells = nearest_cells(matrix(batch.column("embedding")), centres, probes).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(list(cells), pa.list_(pa.int32()))],
                        names=["question_id", "embedding", "cells"],
                    )

        asked = self._fitting(questions).where("question_id is not null").select(
            "question_id", F.col("embedding").cast("array<float>").alias("embedding")
        )
        asked = staged(
            asked.mapInArrow(probe, f"question_id {kind}, embedding array<float>, cells array<int>"), "questions"
        )
        wanted = asked.select(F.explode("cells").alias("cell")).distinct()
        stored = self.table().where(F.col("cell").isin([r.cell for r in wanted.collect()]))
        if asked.count() <= vectors.BLOCK:
            return vectors._best(vectors._scanned(stored, asked, k), k)
        width = F.size("embedding").alias("width")
        each = asked.select("question_id", "embedding", width, F.explode("cells").alias("cell"))
        return vectors._best(vectors._tiled(stored.select("*", width), each, k, ["cell"]), k)
