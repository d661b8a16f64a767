from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import ratio, ratio0, rounded
from tidefunnel.operators import gaps
from tidefunnel.operators.calendar import (
    running_totals,
    sampled_history,
    session_days,
    source_range,
)
from tidefunnel.operators.combine import left_join_spread, stack_sum
from tidefunnel.operators.ordered import descending_rank, floor_to, running, total_order_sum
from tidefunnel.operators.quantile import exact_median
from tidefunnel.plans.catalogue import whole_months

D = dt.date


def test_rounding_is_half_up_and_zero_divisors_are_handled(spark):
    df = spark.createDataFrame([(1, 8, 0), (-1, 8, 0)], "a int, b int, z int")
    got = df.select(
        ratio("a", "b", 2).alias("r"), ratio("a", "z", 2).alias("n"), ratio0("a", "z", 2).alias("o"),
        rounded(F.lit(2.5), 0).alias("h"),
    ).collect()
    assert [r.r for r in got] == [0.13, -0.13]
    assert all(r.n is None and r.o == 0.0 and r.h == 3.0 for r in got)


@pytest.mark.parametrize("descending", [False, True])
def test_running_equals_one_window(spark, descending):
    r = random.Random(5)
    rows = [(r.choice("aab"), r.randrange(40), i, r.randrange(9)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t long, i long, x long")
    df = df.withColumns({"slot": floor_to(F.col("t"), 7), "lo": F.col("x"), "hi": F.col("x")})
    got = {
        (x.k, x.i): (x.x, x.lo, x.hi)
        for x in running(df, ["k"], "slot", ["t", "i"], ["x"], ["lo"], ["hi"], descending).collect()
    }
    for key in "ab":
        seen: list[int] = []
        for row in sorted((q for q in rows if q[0] == key), key=lambda q: q[1:3], reverse=descending):
            seen.append(row[3])
            assert got[(key, row[2])] == (sum(seen), min(seen), max(seen))


def test_descending_rank_equals_sql_rank(spark):
    r = random.Random(6)
    values = [r.choice([0, 0, 0, 5, r.randrange(1000)]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    for row in descending_rank(df, "v", "rank").collect():
        assert row["rank"] == 1 + sum(v > row.v for v in values)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
def test_exact_median(spark, n):
    r = random.Random(n)
    values = [r.choice([1.0, 2.0, r.random() * 100]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_median(df, "v", "m").first()["m"]
    assert got == (pytest.approx(statistics.median(values)) if values else None)


@pytest.fixture(scope="module")
def purchases(spark):
    r = random.Random(8)
    base = dt.datetime(2024, 1, 1)
    rows = [
        (r.choice([1, 1, 2, 3, None]), base + dt.timedelta(days=r.randrange(60), hours=r.choice([0, 0, 5])))
        for _ in range(80)
    ]
    rows += [(7, base), (7, base), (8, base)]  # tied moments are no gap
    df = spark.createDataFrame(rows, "customer_id long, order_date timestamp_ntz")
    pairs: dict[int, list[tuple[dt.date, int]]] = {}
    for c, a in rows:
        for e, b in rows:
            if c is not None and c == e and b > a:
                pairs.setdefault(c, []).append((a.date(), (b.date() - a.date()).days))
    return gaps.order_days(df), pairs


def test_shortest_gaps(purchases):
    days, pairs = purchases
    got: dict[int, int] = {}
    for row in gaps.shortest_gaps(days).collect():
        if row.gap is not None:
            got[row.customer_id] = min(row.gap, got.get(row.customer_id, 10**6))
    assert got == {c: min(g for _, g in p) for c, p in pairs.items()}


def test_mean_distinct_gap(purchases):
    days, pairs = purchases
    got = {r.customer_id: r.mean_gap for r in gaps.mean_distinct_gap(days).collect()}
    for c, p in pairs.items():
        assert got[c] == pytest.approx(statistics.mean({g for _, g in p}))
    assert got[7] is None and got[8] is None


def test_gap_first_seen(purchases):
    days, pairs = purchases
    want: dict[int, dt.date] = {}
    for p in pairs.values():
        for since, gap in p:
            want[gap] = min(since, want.get(gap, dt.date.max))
    assert {r.gap: r.since for r in gaps.gap_first_seen(days).collect()} == want


def test_gaps_of_dense_and_old_histories(spark):
    r = random.Random(3)
    base = dt.date(1965, 12, 30)  # days before 1970 have negative numbers
    held = {1: set(range(3000)), 2: {0, 2999}, 3: {64 * i for i in range(40)}, 4: {5}}
    held[5] = {r.randrange(700) for _ in range(60)}
    rows = [
        (c, base + dt.timedelta(days=d), dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1 + (c == 4)))
        for c, ds in held.items() for d in ds
    ]
    days = spark.createDataFrame(rows, "customer_id int, date date, first_at timestamp_ntz, last_at timestamp_ntz")
    means = {row.customer_id: row.mean_gap for row in gaps.mean_distinct_gap(days).collect()}
    since: dict[int, dt.date] = {0: base + dt.timedelta(days=5)}
    for c, ds in held.items():
        found = {b - a for a in ds for b in ds if b > a} | ({0} if c == 4 else set())
        assert means[c] == pytest.approx(statistics.mean(found))
        for a in ds:
            for b in ds:
                if b > a:
                    start = base + dt.timedelta(days=a)
                    since[b - a] = min(start, since.get(b - a, dt.date.max))
    assert {row.gap: row.since for row in gaps.gap_first_seen(days).collect()} == since


def test_running_totals_cover_calendar_days_without_changes(spark):
    calendar = spark.createDataFrame([(D(2024, 1, 2),), (D(2024, 1, 5),)], "date date")
    changes = spark.createDataFrame(
        [(D(2023, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 3), 4), (D(2024, 1, 6), 8), (None, 16)],
        "date date, n long",
    )
    got = running_totals(calendar, changes, ["n"]).orderBy("date").collect()
    assert [(r.date, r.n) for r in got] == [(D(2024, 1, 2), 3), (D(2024, 1, 5), 7)]


def test_calendars(spark):
    orders = spark.createDataFrame(
        [(dt.datetime(2023, 10, 20, 5),), (dt.datetime(2024, 1, 9),)], "order_date timestamp_ntz"
    )
    days = [r.date for r in sampled_history(orders, "order_date", D(2024, 1, 30)).collect()]
    # the first sample precedes the first order; 15 December is the last before 31 December
    assert days[:3] == [D(2023, 10, 15), D(2023, 11, 15), D(2023, 12, 15)]
    assert days[3:] == [D(2023, 12, 31) + dt.timedelta(days=i) for i in range(31)]
    assert source_range(orders, "order_date").count() == 82
    events = spark.createDataFrame(
        [("s", dt.datetime(2023, 1, 1) + dt.timedelta(days=i)) for i in range(120)]
        + [(None, dt.datetime(2022, 1, 1))],
        "session_id string, occurred_at timestamp_ntz",
    )
    got = [r.date for r in session_days(events, D(2024, 1, 30)).collect()]
    assert len(got) == 130 and got[0] == D(2023, 1, 21)


def test_stack_sum_keeps_null_groups(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, n long")
    b = spark.createDataFrame([(None, 5)], "k string, m long")
    got = {r.k: (r.n, r.m) for r in stack_sum(["k"], [a, b], ["n", "m"]).collect()}
    assert got == {None: (1, 5), "x": (2, None)}


def test_left_join_spread_equals_left_join_and_spreads_nulls(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("k"), F.col("id").alias("i")
    )
    right = spark.createDataFrame([(0, "a"), (1, "b"), (None, "never")], "k long, v string")
    joined = left_join_spread(left, right, ["k"], nullable="k", spread_by="i")
    want = left.join(right, "k", "left")
    assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [
        (D(2024, 1, 31), D(2024, 2, 29), 0),  # last days of two months are no whole month
        (D(2024, 1, 15), D(2024, 2, 15), 1),
        (D(2022, 11, 20), D(2024, 1, 25), 14),
        (D(2024, 3, 5), D(2024, 1, 20), -1),
        (D(2024, 3, 5), D(2024, 3, 1), 0),
    ],
)
def test_whole_months(spark, start, end, months):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    assert df.select(whole_months(F.col("s"), F.col("e")).alias("m")).first().m == months
