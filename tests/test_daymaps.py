"""Distinct counts from stored bitmaps against the rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tidefunnel.operators.daymaps import DayMaps
from tidefunnel.session import work_folder

FIRST = dt.date(2024, 1, 1)
KINDS = {"a": ("x",), "b": ("y",), "ab": ("x", "y")}


def day(i):
    return FIRST + dt.timedelta(days=i)


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, kind string, date date")


def check(maps, rows, spans):
    for lo, hi in spans:
        got = maps.counts(day(lo), day(hi), **KINDS).first().asDict()
        assert got == {
            name: len({k for k, kind, d in rows if k is not None and kind in names and d and day(lo) <= d <= day(hi)})
            for name, names in KINDS.items()
        }


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    some = [(f"s{r.randrange(300)}", r.choice("xyz"), day(r.randrange(6))) for _ in range(900)]
    hot = [("hot", "x", day(i)) for i in range(6) for _ in range(100)]
    return some + hot + [(None, "x", day(1)), ("s1", "x", None), ("", "y", day(2)), ("only", "y", day(5))]


def test_any_range_equals_the_rows(spark, rows):
    maps = DayMaps(spark, work_folder(spark, "maps"))
    maps.record(frame(spark, [x for x in rows if x[2] is None or x[2] < day(4)]))
    before = {r.key: r.number for r in maps.ids().collect()}
    late = [day(4), day(5)]
    for _ in range(2):  # a second run changes nothing
        maps.record(frame(spark, [x for x in rows if x[2] in late]), late)
    check(maps, rows, [(0, 5), (3, 4), (5, 5), (7, 9)])
    ids = {r.key: r.number for r in maps.ids().collect()}
    assert before.items() <= ids.items()
    assert sorted(ids.values()) == list(range(1, len(ids) + 1))
    read = maps.counts(day(3), day(4), **KINDS)
    assert {f.split("/date=")[1][:10] for f in read.inputFiles()} == {"2024-01-04", "2024-01-05"}
    # a day whose rows are gone
    maps.record(frame(spark, []), [day(5)])
    check(maps, [x for x in rows if x[2] != day(5)], [(0, 5), (5, 5)])


def test_keys_over_several_pieces(spark):
    many = spark.range(70000).selectExpr("concat('k', id) as key", "'x' as kind", "date'2024-01-01' as date")
    more = spark.range(30000, 90000).selectExpr("concat('k', id) as key", "'y' as kind", "date'2024-01-02' as date")
    maps = DayMaps(spark, work_folder(spark, "maps"))
    maps.record(many.union(more))
    got = maps.counts(day(0), day(1), **KINDS).first()
    assert (got.a, got.b, got.ab) == (70000, 60000, 90000)


def test_nothing_recorded(spark):
    maps = DayMaps(spark, work_folder(spark, "maps"))
    assert tuple(maps.counts(day(0), day(1), **KINDS).first()) == (0, 0, 0)
    maps.record(frame(spark, []))
    assert tuple(maps.counts(day(0), day(1), **KINDS).first()) == (0, 0, 0)
