from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from tidefunnel.operators.merge import append_new, keyed_merge
from tidefunnel.operators.tables import read_table, replace_all, replace_days, staged
from tidefunnel.plans.commerce import customer_metrics_daily, product_performance_daily
from tidefunnel.plans.ingest import merge_customers, merge_profiles, record_replies, tag_vip_customers
from tidefunnel.plans.rollups import refresh_calendar, refresh_days
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse

D = dt.date


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_keyed_merge_updates_only_named_columns_and_stamps(spark):
    target = spark.createDataFrame(
        [("a", 1, "old", 0), ("b", 2, "old", 0), (None, 3, "old", 0)], "k string, x int, s string, at int"
    )
    batch = spark.createDataFrame(
        [("a", 9, "new", 1), ("a", 8, "newer", 2), ("c", 5, "first", 1), ("c", 6, "last", 2), (None, 7, "n", 1)],
        "k string, x int, s string, seq int",
    )
    got = keyed_merge(target, batch, ["k"], ["s"], ["seq"], stamp=("at", F.lit(99)))
    assert rows(got, "k", "x", "s", "at") == sorted(
        [
            ("a", 1, "newer", 99),  # x stays, s of the last repeat
            ("b", 2, "old", 0),  # untouched: no stamp
            ("c", 5, "last", 99),  # inserted by the first repeat, updated by the last
            (None, 3, "old", 0), (None, 7, "n", 99),  # NULL keys never match
        ],
        key=str,
    )
    again = keyed_merge(got.where("k is not null"), batch.where("k is not null"), ["k"], ["s"], ["seq"])
    assert rows(again, "k", "x", "s") == [("a", 1, "newer"), ("b", 2, "old"), ("c", 5, "last")]


def test_append_new_ignores_known_and_repeated_keys(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    batch = spark.createDataFrame([(1, "no"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(append_new(target, batch, ["k"], ["v"]), "k", "v") == [(1, "x"), (2, "a")]


def test_customer_and_profile_identity(spark):
    customers = spark.createDataFrame(
        [("1", "a@x", None, 3), ("2", "B@x", None, 0)],
        "id string, email string, klaviyo_profile_id string, total_orders int",
    )
    profiles = spark.createDataFrame(
        [("k1", "1", "a@x", "{}")],
        "klaviyo_profile_id string, customer_id string, email string, properties string",
    )
    synced = spark.createDataFrame(
        [("a@x", "k1", "{1}"), ("b@x", "k2", "{2}")],
        "email string, klaviyo_profile_id string, properties string",
    )
    merged = merge_customers(customers, synced, ["klaviyo_profile_id"])
    linked = merge_profiles(profiles, synced, merged, ["klaviyo_profile_id"])
    got = rows(merged, "email", "klaviyo_profile_id", "total_orders")
    # the e-mail is compared exactly, so B@x and b@x are two customers
    assert got == [("B@x", None, 0), ("a@x", "k1", 3), ("b@x", "k2", None)]
    new_id = merged.where("email = 'b@x'").first().id
    assert rows(linked, "klaviyo_profile_id", "customer_id", "properties") == [
        ("k1", "1", "{1}"), ("k2", new_id, "{2}"),
    ]


def test_record_replies_marks_mails_and_drops_zero_tokens(spark):
    replies = spark.createDataFrame([], "email_id int, model string, tokens_prompt int, tokens_completion int")
    emails = spark.createDataFrame(
        [(1, "new", None), (2, "new", None)], "id int, status string, reply_sent_at int"
    )
    batch = spark.createDataFrame(
        [(1, "m", 0, 5), (1, "m", 7, None)],
        "email_id int, model string, tokens_prompt int, tokens_completion int",
    )
    appended, marked = record_replies(replies, emails, batch, F.lit(42))
    assert rows(appended, "tokens_prompt", "tokens_completion") == [(7, None), (None, 5)]
    assert rows(marked, "id", "status", "reply_sent_at") == [(1, "processed", 42), (2, "new", None)]


def test_tag_vip_customers(spark):
    df = spark.createDataFrame(
        [(1, 2, 9.0, ["x"]), (2, 1, 8.0, None), (3, 1, 7.0, ["VIP"]), (4, 0, 99.0, ["x"]), (5, 1, 1.0, ["x"])],
        "id int, total_orders int, total_revenue double, tags array<string>",
    )
    got = {r.id: r.tags for r in tag_vip_customers(df, limit=3).collect()}
    assert got == {1: ["x", "VIP"], 2: None, 3: ["VIP"], 4: ["x"], 5: ["x"]}


def test_replace_days_is_idempotent_and_drops_emptied_days(spark):
    path = f"{work_folder(spark, 'test')}/t"
    first = spark.createDataFrame(
        [(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 3), 3)], "date date, n int"
    )
    replace_days(first, path)
    replace_days(first, path)
    assert rows(read_table(spark, path, first), "date", "n") == rows(first, "date", "n")
    second = spark.createDataFrame([(D(2024, 1, 2), 20)], "date date, n int")
    replace_days(second, path, [D(2024, 1, 2), D(2024, 1, 3)])
    assert rows(read_table(spark, path, first), "date", "n") == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 20)]
    assert not os.path.exists(f"{path}/date=2024-01-03")


def test_replace_all_and_staged(spark):
    path = f"{work_folder(spark, 'test')}/t"
    replace_all(spark.range(5), path)
    replace_all(spark.range(2), path)
    assert read_table(spark, path, spark.range(1)).count() == 2
    df = spark.range(3)
    out = staged(df, "test")
    assert out.columns == df.columns and out.count() == 3
    assert "Range" not in out._jdf.queryExecution().toString()  # the lineage is cut


def test_backfill_twice_is_once_and_leaves_other_days(spark):
    wh = Warehouse.from_fixture(spark, "/root/testdata/sf0.001")
    root = work_folder(spark, "backfill-test")
    table = "product_performance_daily"
    full = product_performance_daily(wh).where("date is not null")
    days = [r["date"] for r in full.select("date").distinct().orderBy("date").limit(6).collect()]
    odd = spark.createDataFrame([(d,) for d in days[::2]], "date date")
    first = sorted(map(tuple, refresh_calendar(wh, table, root, odd).collect()), key=str)
    assert first == sorted(map(tuple, full.join(odd, "date", "left_semi").select(*full.columns).collect()), key=str)
    assert sorted(map(tuple, refresh_calendar(wh, table, root, odd).collect()), key=str) == first
    both = refresh_days(wh, table, root, days[1], days[1])
    assert {r["date"] for r in both.select("date").distinct().collect()} == {*days[::2], days[1]}


def test_day_refresh_reads_the_days_only(spark):
    wh = Warehouse.from_fixture(spark, "/root/testdata/sf0.001")
    day = wh.as_of - dt.timedelta(days=3)
    for build in (customer_metrics_daily, product_performance_daily):
        whole = build(wh).where(F.col("date") == F.lit(day))
        assert sorted(map(str, build(wh, day, day).collect())) == sorted(map(str, whole.collect()))
        plan = build(wh, day, day)._jdf.queryExecution().optimizedPlan().toString()
        # orders and web events are both filtered below their grouping
        assert len(re.findall(rf"Filter .*{day}", plan)) >= 2
