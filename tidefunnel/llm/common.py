"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL = 1 << 20  # bytes of a small batch, if it has more than one row


def small_batches(batches: Iterator[pa.RecordBatch], most: int = SMALL) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that Python holds few texts at once."""
    for batch in batches:
        at, n = 0, batch.num_rows
        while at < n:
            rows = max(1, min(n - at, int(most * n / max(1, batch.nbytes))))
            while rows > 1 and batch.slice(at, rows).nbytes > 2 * most:
                rows //= 2
            yield batch.slice(at, rows)
            at += rows


def free_name(name: str, columns: list[str]) -> str:
    """``name`` with as many marks behind it as no column of a caller needs."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(source: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so that no other column can clash; NULL texts are empty."""
    return source.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
