"""Files of a stored micro-batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidefunnel.streaming.logs import write_batch


def test_a_day_of_a_batch_is_one_file(spark, tmp_path):
    rows = spark.range(4000, numPartitions=7).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("date"))
    write_batch(rows, f"file://{tmp_path}/mails", 3)
    files = list(tmp_path.glob("mails/open/date=*/batch=3/*.parquet"))
    assert len(files) == 20  # one for each task and day before: 140
    assert spark.read.parquet(f"file://{tmp_path}/mails/open").count() == 4000
