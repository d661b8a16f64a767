from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidefunnel.session import work_folder
from tidefunnel.streaming import ingest, logs
from tidefunnel.streaming.daily_counts import COUNTS, daily_counts, run_daily_counts, store_counts
from tidefunnel.streaming.ingest import admitted_mails, run_ingest

START = dt.datetime(2024, 1, 1, 12)


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_each_mail_is_stored_once_and_bad_ones_are_skipped(spark):
    folder = work_folder(spark, "test-mails")
    schema = "id string, received_at timestamp, message string"

    def mail(i: int) -> tuple:
        body = json.dumps({"id": f"m{i}", "threadId": "t", "payload": {}})
        return (f"m{i}", START + dt.timedelta(minutes=i), body)

    root = work_folder(spark, "test-ingest")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/*")
    write(spark, folder, "a", [mail(1), mail(2), mail(2), ("bad", START, "no json")], schema)
    assert run_ingest(stream, root).count() == 2
    # a restart takes up only what is new, and knows the earlier ids
    write(spark, folder, "b", [mail(2), mail(3)], schema)
    got = run_ingest(stream, root)
    assert sorted(r.gmail_message_id for r in got.collect()) == ["m1", "m2", "m3"]


def test_no_mail_is_too_late(spark):
    """Four files, the newest first, one a batch: every mail is stored once."""
    folder, root = work_folder(spark, "test-late"), work_folder(spark, "test-late-ingest")
    schema = "id string, received_at timestamp, message string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    for part in (3, 2, 1, 0):
        mails = [
            (f"m{i}", START + dt.timedelta(days=i), json.dumps({"id": f"m{i}", "payload": {}}))
            for i in range(part * 10, part * 10 + 12)
        ]
        write(spark, folder, f"p{3 - part}", mails, schema)
    ids = [r.gmail_message_id for r in run_ingest(stream, root).collect()]
    assert sorted(ids) == sorted(f"m{i}" for i in range(42))


def test_stream_counts_equal_batch_counts(spark):
    folder = work_folder(spark, "test-events")
    schema = "occurred_at timestamp, event_type string"
    root = work_folder(spark, "test-counts")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/*")
    day = dt.timedelta(days=1)
    # the second file brings events of an earlier day, still within the lateness
    first = [(START, "view"), (START + day, "view"), (START + day, "click")]
    second = [(START, "view"), (START + 2 * day, "click")]
    write(spark, folder, "a", first, schema)
    run_daily_counts(stream, root)
    write(spark, folder, "b", second, schema)
    got = run_daily_counts(stream, root)
    batch = daily_counts(spark.createDataFrame(first + second, schema))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    # ten days later an event of the first day still counts
    write(spark, folder, "c", [(START + 12 * day, "view")], schema)
    run_daily_counts(stream, root)
    write(spark, folder, "d", [(START, "view")], schema)
    late = run_daily_counts(stream, root).where(F.col("date") == START.date())
    assert [r.events for r in late.collect()] == [3]


MAIL = "id string, received_at timestamp, message string"


def mail(i: int, at: dt.datetime | None = None) -> tuple:
    body = json.dumps({"id": f"m{i}", "threadId": "t", "payload": {}})
    return (f"m{i}", at or START + dt.timedelta(hours=i), body)


def test_repeats_behind_the_horizon_meet_their_own_days_only(spark, monkeypatch):
    """With a horizon of no time the state forgets every id; stored days still know it."""
    folder, root = work_folder(spark, "test-mails"), work_folder(spark, "test-ingest")
    stream = spark.readStream.schema(MAIL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    asked = []
    plain = ingest.before
    monkeypatch.setattr(ingest, "before", lambda *a: asked.append(sorted(map(str, a[3]))) or plain(*a))
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    batches = [[mail(i) for i in range(60)], [mail(70)], [mail(3), mail(71), ("m72", None, mail(72)[2])], [mail(3), mail(70), ("m72", None, mail(72)[2])], [mail(80, now)]]
    for n, rows in enumerate(batches):
        write(spark, folder, f"p{n}", rows, MAIL)
        got = run_ingest(stream, root, horizon="0 seconds")
    ids = [r.gmail_message_id for r in got.collect()]
    assert sorted(ids) == sorted(f"m{i}" for i in [*range(60), 70, 71, 72, 80])
    first = {str((START + dt.timedelta(hours=i)).date()) for i in range(60)}
    days = [d for d in asked if d]
    assert days[0] == sorted(first) and all(len(d) <= 3 for d in days[1:])
    # no batch reads what other days hold
    like = got.schema
    known = plain(spark, f"{root}/mails", like, [START.date()], 99)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_state_drops_repeats_inside_the_horizon(spark, monkeypatch):
    """Repeats of recent mails are known to the state; nothing stored is read for them."""
    folder, root = work_folder(spark, "test-mails"), work_folder(spark, "test-ingest")
    stream = spark.readStream.schema(MAIL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    asked = []
    plain = ingest.before
    monkeypatch.setattr(ingest, "before", lambda *a: asked.append(a[3]) or plain(*a))
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None) - dt.timedelta(minutes=5)
    for n, ids in enumerate([(1, 2, 2), (2, 3), (1, 2, 3, 4)]):
        write(spark, folder, f"p{n}", [mail(i, now) for i in ids], MAIL)
        got = run_ingest(stream, root)
    assert sorted(r.gmail_message_id for r in got.collect()) == ["m1", "m2", "m3", "m4"]
    assert asked and not any(asked)


def test_a_batch_that_is_run_again_stores_the_same(spark):
    root = work_folder(spark, "test-again")
    store = ingest.store_new(root, per_poll=2)
    now = dt.datetime(2024, 2, 1)
    rows = [(f"m{i}", START + dt.timedelta(hours=i), now) for i in range(5)]
    batch = spark.createDataFrame(rows, "gmail_message_id string, received_at timestamp, arrived timestamp")
    more = spark.createDataFrame([("m9", START, now), ("m1", START + dt.timedelta(hours=1), now)], batch.schema)
    like = batch.drop("arrived").schema
    for batch_id, df in ((0, batch), (0, batch), (1, more), (1, more), (2, more.limit(0))):
        store(df, batch_id)
    mails = ingest.stored_mails(spark, f"{root}/mails", like).collect()
    assert sorted(r.gmail_message_id for r in mails) == ["m0", "m1", "m2", "m3", "m4", "m9"]
    # the newest first, two a poll, each once; the queue holds what waits
    polls = {(r.poll, r.gmail_message_id) for r in admitted_mails(spark, root).collect()}
    assert polls == {(0, "m4"), (0, "m3"), (1, "m2"), (1, "m1"), (2, "m0"), (2, "m9")}
    assert len(os.listdir(f"{root}/waiting")) <= 2


def test_late_events_refresh_their_day_and_folders_stay_few(spark):
    folder, root = work_folder(spark, "test-events"), work_folder(spark, "test-counts")
    schema = "occurred_at timestamp, event_type string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    day = dt.timedelta(days=1)
    rows = []
    for n in range(12):
        here = [(START + n * day, "view"), (START + n * day, "click"), (None, "view")]
        here += [(START + (n // 3) * day, "view")] if n > 6 else []  # late
        rows += here
        write(spark, folder, f"p{n:02}", here, schema)
        if n % 4 == 3:
            got = run_daily_counts(stream, root)
    want = daily_counts(spark.createDataFrame(rows, schema).where("occurred_at is not null"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    opened = {(r.date, r.batches) for r in logs.open_batches(spark, f"{root}/counts", COUNTS).collect()}
    assert {d for d, _ in opened} <= {(START + n * day).date() for n in (9, 10, 11)}  # inside the watermark
    closed = os.listdir(f"{root}/counts/closed")
    assert all(len([u for u in os.listdir(f"{root}/counts/closed/{d}") if u.startswith("upto=")]) == 1 for d in closed if d.startswith("date="))
    assert len(os.listdir(f"{root}/counts/newest")) <= 4


def test_closing_survives_a_crash(spark, monkeypatch):
    """The folders that a closed one replaces may be left over, and the batch may run again."""
    root = work_folder(spark, "test-crash")
    schema = "occurred_at timestamp, event_type string"
    first = spark.createDataFrame([(START, "view")] * 3, schema)
    late = spark.createDataFrame([(START, "view"), (START + dt.timedelta(days=9), "view")], schema)
    store = store_counts(root)
    store(first, 0)
    plain = logs.drop_folders

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(logs, "drop_folders", crash)
    try:
        store(late, 1)
    except RuntimeError:
        pass
    monkeypatch.setattr(logs, "drop_folders", plain)

    def counts():
        rows = logs.stored(spark, root, COUNTS).groupBy("date").agg(F.sum("events").alias("n")).collect()
        return {r.date: r.n for r in rows}

    want = {START.date(): 4, (START + dt.timedelta(days=9)).date(): 1}
    assert counts() == want
    store(late, 1)
    assert counts() == want
