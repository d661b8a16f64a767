"""Message ingest as a stream: parse, drop repeats, store each mail once, admit some per poll.

Repeats are dropped by keyed state that forgets an id HORIZON after its arrival
(``dropDuplicatesWithinWatermark`` on the arrival time, so no mail is too late for it).
A message that is older than the horizon may be a repeat of a forgotten id: only such
messages are compared with what is stored, and only with the stored mails of their own
days, because a repeat carries the received time of the first.  The work of a batch
follows the batch and those days, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tidefunnel.operators.tables import drop_folders, folder_exists
from tidefunnel.plans.mail import normalize_messages
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse
from tidefunnel.streaming.logs import stored, write_batch

POLL = "2 minutes"
HORIZON = "7 days"
KEY = "gmail_message_id"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_mails(messages: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Normalised mails of a stream of (id, received_at, message), without repeats inside the horizon.

    Messages that cannot be read are left out, as one bad mail must not stop
    the rest.  Mails of any age pass: nothing is dropped for being late.
    """
    mails = normalize_messages(messages, "received_at").where(F.col(KEY).isNotNull())
    arrived = mails.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", horizon)
    return arrived.dropDuplicatesWithinWatermark([KEY])


def stored_mails(spark: SparkSession, path: str, like: StructType, days: list | None = None) -> DataFrame:
    """All stored mails, or those received on the given days (no others are read)."""
    return stored(spark, path, StructType([*like.fields, StructField("date", DateType())]), days)


def store_new(root: str, horizon: str = HORIZON, per_poll: int | None = None):
    """Sink that stores each mail once, by the day it was received.

    A retried batch is compared with the batches before it, so it stores the same
    rows again.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{root}/mails"
        batch = batch.persist()
        # mails without a time lie together on one day
        day = F.coalesce(F.to_date("received_at"), F.to_date(F.lit("1970-01-01")))
        inside = F.col("received_at").between(F.col("arrived") - F.expr(f"interval {horizon}"), F.col("arrived"))
        rows = batch.select("*", day.alias("date"), (~F.coalesce(inside, F.lit(False))).alias("old")).drop("arrived")
        days = [r.date for r in rows.where("old").select("date").distinct().collect()]
        known = before(spark, path, rows.drop("old", "date").schema, days, batch_id)
        fresh = rows.join(known.withColumn("old", F.lit(True)), [KEY, "old"], "left_anti").drop("old")
        write_batch(fresh, path, batch_id)
        if per_poll is not None:
            admit(fresh.select(KEY, "received_at"), root, batch_id, per_poll)
        batch.unpersist()

    return store


def before(spark: SparkSession, path: str, like: StructType, days: list, batch_id: int) -> DataFrame:
    """Ids stored on the given days by the batches before ``batch_id``."""
    if not days or not folder_exists(spark, f"{path}/open"):
        return spark.createDataFrame([], StructType([like[KEY]]))
    schema = f"{KEY} string, date date, batch long"
    rows = spark.read.schema(schema).parquet(f"{path}/open")
    return rows.where(F.col("date").isin(days) & (F.col("batch") < batch_id)).select(KEY)


def admit(fresh: DataFrame, root: str, batch_id: int, per_poll: int) -> None:
    """Take the ``per_poll`` newest of the waiting and the new mails; the others wait for the next poll.

    The queue is written anew with each poll, as it holds what waits and not the
    history; a poll that is run again starts from the queue before it.
    """
    spark, path = fresh.sparkSession, f"{root}/waiting"
    schema = StructType(fresh.schema.fields)
    queue = fresh
    past = []
    if folder_exists(spark, path):
        rows = spark.read.schema(StructType([*schema.fields, StructField("poll", LongType())])).parquet(path)
        past = sorted(r.poll for r in rows.select("poll").distinct().collect() if r.poll < batch_id)
        if past:
            queue = rows.where(F.col("poll") == past[-1]).drop("poll").unionByName(fresh)
    taken = queue.orderBy(F.desc("received_at"), KEY).limit(per_poll)
    taken.write.mode("overwrite").parquet(f"{root}/admitted/poll={batch_id}")
    admitted = spark.read.schema(schema).parquet(f"{root}/admitted/poll={batch_id}").select(KEY)
    rest = queue.join(F.broadcast(admitted), KEY, "left_anti")  # at most ``per_poll`` ids
    rest.write.mode("overwrite").parquet(f"{path}/poll={batch_id}")
    drop_folders(spark, [f"{path}/poll={p}" for p in past[:-1]])


def admitted_mails(spark: SparkSession, root: str) -> DataFrame:
    """(gmail_message_id, received_at, poll) of all admitted mails."""
    return spark.read.schema(f"{KEY} string, received_at timestamp, poll long").parquet(f"{root}/admitted")


def run_ingest(
    messages: DataFrame,
    root: str,
    once: bool = True,
    poll: str = POLL,
    horizon: str = HORIZON,
    per_poll: int | None = None,
) -> DataFrame:
    """Start the ingest; with ``once`` take all there is, wait and return the mails."""
    spark = messages.sparkSession
    if spark.conf.get(STATE_STORE, None) is None or "HDFSBacked" in spark.conf.get(STATE_STORE):
        spark.conf.set(STATE_STORE, ROCKSDB)  # state beside the heap, snapshots of changes only
    mails = new_mails(messages, horizon)
    writer = mails.writeStream.foreachBatch(store_new(root, horizon, per_poll)).option(
        "checkpointLocation", f"{root}/checkpoint"
    )
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()
    if once:
        query.awaitTermination()
    like = mails.drop("arrived")
    return stored_mails(spark, f"{root}/mails", like.schema).drop("date", "received_at")


def stream_ingest_messages(wh: Warehouse) -> DataFrame:
    """The mailbox's messages as a stream through the ingest job."""
    messages = wh.stream("messages")
    # deliver every message twice, as a mailbox that is polled does
    twice = messages.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    return run_ingest(twice, work_folder(wh.spark, "ingest"))


register("stream_ingest_messages", stream_ingest_messages)
