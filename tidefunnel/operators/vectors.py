"""Nearest neighbours over an embedding table: exact, and through a stored index.

A question's answer is the k rows with the least Euclidean distance, ties by id.
Distances of whole blocks come from one matrix product; the rows that may be among
the k nearest are then measured again in plain double precision, so an answer does
not depend on how the work was cut.

Few questions (counted, at most BLOCK) travel with the tasks, and the corpus is
scanned where it lies.  Many questions meet the corpus in tiles: questions and corpus
are cut by a hash of the id into tiles of about TILE_BYTES, every pair of tiles is one
group of a shuffle, and each group hands on k rows for each of its questions.  No
vector passes the driver then, and the plan does not grow with the questions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024  # questions that travel with the tasks; more meet the corpus in tiles
TILE_BYTES = 16 << 20  # vectors of one side of a tile
STRIPE = 1 << 21  # numbers of one block of distances


def usable(table: DataFrame) -> DataFrame:
    """Rows whose vector is there, has no NULL and only finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return table.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def matrix(column: pa.Array, kind: type | None = np.float64) -> np.ndarray:
    """List array of equal-length float lists as a 2-d double array; as it is stored without a ``kind``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind or flat.dtype, copy=False).reshape(len(column), -1)


def closest(questions: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, row, distance) of the k nearest rows of each question and of all ties with the last."""
    parts = []
    sizes = np.einsum("ij,ij->i", vectors, vectors)
    step = max(1, STRIPE // max(1, len(vectors)))
    for at in range(0, len(questions), step):
        q = questions[at : at + step].astype(np.float64)
        own = (q**2).sum(axis=1)
        rough = sizes[None, :] - 2.0 * (q @ vectors.T) + own[:, None]
        near = np.full(len(q), np.inf)
        if len(vectors) > k:
            near = np.partition(rough, k - 1, axis=1)[:, k - 1]
        # the product loses some digits of the larger terms
        near = near + 1e-9 * (own + sizes.max(initial=0.0))
        i, row = np.nonzero(rough <= near[:, None])
        exact = np.empty(len(i))
        for c in range(0, len(i), 1 << 14):
            difference = vectors[row[c : c + (1 << 14)]] - q[i[c : c + (1 << 14)]]
            exact[c : c + (1 << 14)] = np.sqrt((difference**2).sum(axis=1))
        order = np.lexsort((exact, i))
        i, row, exact = i[order], row[order], exact[order]
        begin = np.searchsorted(i, np.arange(len(q)))
        last = np.minimum(begin + k, np.searchsorted(i, np.arange(len(q)), side="right")) - 1
        keep = exact <= exact[last][i]
        parts.append((i[keep] + at, row[keep], exact[keep]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _cosines(questions: np.ndarray, vectors: np.ndarray, i: np.ndarray, row: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for c in range(0, len(i), 1 << 14):
        q, v = questions[i[c : c + (1 << 14)]].astype(np.float64), vectors[row[c : c + (1 << 14)]]
        with np.errstate(divide="ignore", invalid="ignore"):
            out[c : c + (1 << 14)] = (v * q).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (q * q).sum(axis=1))
    return out


def _hits_table(ids: pa.Array, names: pa.Array, questions, vectors, k: int) -> pa.Table:
    i, row, distance = closest(questions, vectors, k)
    return pa.table(
        {
            "question_id": names.take(pa.array(i)),
            "email_id": ids.take(pa.array(row)),
            "l2": pa.array(distance),
            "similarity": pa.array(_cosines(questions, vectors, i, row)),
        }
    )


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("question_id").orderBy("l2", "email_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("question_id", "rank", "email_id", "l2", "similarity")


def _types(corpus: DataFrame, questions: DataFrame) -> str:
    question, email = (t.simpleString() for t in (questions.schema["question_id"].dataType, corpus.schema["email_id"].dataType))
    return f"question_id {question}, email_id {email}, l2 double, similarity double"


def _scanned(corpus: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """Hits of at most BLOCK questions: they travel with the tasks, the corpus stays where it is.

    With a column ``cell`` on the corpus and ``cells`` on the questions, a question meets its cells only.
    """
    probed = "cells" in questions.columns
    rows = questions.toArrow()
    names, sizes = rows.column("question_id").combine_chunks(), np.array([len(v) for v in rows.column("embedding")])
    vectors = rows.column("embedding").to_pylist()
    wanted = [set(c) for c in rows.column("cells").to_pylist()] if probed else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = np.asarray(batch.column("embedding").value_lengths())
            cells = np.asarray(batch.column("cell")) if probed else np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes).tolist():
                for cell in np.unique(cells).tolist():
                    asked = [n for n in np.flatnonzero(sizes == size).tolist() if not probed or cell in wanted[n]]
                    here = np.flatnonzero((lengths == size) & (cells == cell))
                    if not asked or not len(here):
                        continue
                    part = batch.take(pa.array(here))
                    table = _hits_table(
                        part.column("email_id"),
                        names.take(pa.array(asked)),
                        np.array([vectors[n] for n in asked], np.float64),
                        matrix(part.column("embedding")),
                        k,
                    )
                    yield from table.to_batches()

    columns = ["email_id", "embedding", "cell"] if probed else ["email_id", "embedding"]
    return corpus.select(*columns).mapInArrow(run, _types(corpus, questions))


def _tiled(corpus: DataFrame, questions: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """Hits of any number of questions, by pairs of tiles within ``keys`` (size of the vectors, cell)."""
    key = [F.col(c) for c in keys]

    def tiles(df: DataFrame) -> DataFrame:
        """Number of tiles of each key, from its rows and their size."""
        return df.groupBy(*key).agg(F.ceil(F.count("*") * F.max("width") * 4 / TILE_BYTES).alias("tiles"))

    left, right = tiles(corpus), tiles(questions)
    # one row for each length of vector (and cell)
    many = left.withColumnRenamed("tiles", "ctiles").join(right.withColumnRenamed("tiles", "qtiles"), keys)

    def dealt(df: DataFrame, name: str, own: str, other: str, own_tile: str, other_tile: str) -> DataFrame:
        """Each row in its own tile, once for each tile of the other side."""
        placed = df.join(F.broadcast(many), keys).withColumns(
            {
                own_tile: F.pmod(F.xxhash64(name), F.col(own)).cast("int"),
                other_tile: F.explode(F.sequence(F.lit(0), (F.col(other) - 1).cast("int"))),
            }
        )
        return placed.select(*keys, "i", "j", name, "embedding")

    c = dealt(corpus, "email_id", "ctiles", "qtiles", "j", "i")
    q = dealt(questions, "question_id", "qtiles", "ctiles", "i", "j")
    both = c.unionByName(q, allowMissingColumns=True).withColumn("asks", F.col("email_id").isNull())

    def run(table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("asks").combine_chunks())
        q_rows, c_rows = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        if not len(q_rows) or not len(c_rows):
            return schema.empty_table()
        return _hits_table(
            c_rows.column("email_id").combine_chunks(),
            q_rows.column("question_id").combine_chunks(),
            matrix(q_rows.column("embedding"), None),  # doubles block by block
            matrix(c_rows.column("embedding")),
            k,
        )

    types = {f.name: f.dataType for f in both.schema}
    schema = pa.schema(
        [
            ("question_id", _arrow(types["question_id"])),
            ("email_id", _arrow(types["email_id"])),
            ("l2", pa.float64()),
            ("similarity", pa.float64()),
        ]
    )
    return both.groupBy(*keys, "i", "j").applyInArrow(run, _types(corpus, questions))


def _arrow(kind) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32()}.get(kind.simpleString(), pa.int64())


def _ready(table: DataFrame, name: str, *more: str) -> DataFrame:
    rows = usable(table).where(F.col(name).isNotNull())
    return rows.select(name, "embedding", F.size("embedding").alias("width"), *more)


def nearest_tiled(corpus: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """As :func:`nearest`, always in tiles."""
    return _best(_tiled(_ready(corpus, "email_id"), _ready(questions, "question_id"), k, ["width"]), k)


def nearest(corpus: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of ``corpus`` (email_id, embedding) for each question.

    ``questions`` has question_id, without repeats, and embedding.  The result has
    question_id, rank, email_id, l2 and the cosine similarity.  Vectors that are
    NULL, not finite or of another length than the question's are no neighbours;
    rows without an id are left out.
    """
    asked = _ready(questions, "question_id")
    if asked.limit(BLOCK + 1).count() > BLOCK:
        return nearest_tiled(corpus, questions, k)
    return _best(_scanned(_ready(corpus, "email_id"), asked.select("question_id", "embedding"), k), k)
