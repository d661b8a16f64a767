"""Mails after a purchase: every pair counted, purchase days handed on twice, people merged by the ledger."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidefunnel.operators.ledger import DayLedger
from tidefunnel.plans.advocacy import post_purchase_mails
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse

DAY_ONE = dt.datetime(2024, 1, 1)


def shop(spark, people, orders, mails):
    frames = {
        "customers": spark.createDataFrame([(p,) for p in people], "id long"),
        "klaviyo_profiles": spark.createDataFrame([(p + 1000, p) for p in people], "id long, customer_id long"),
        "shopify_orders": spark.createDataFrame(
            orders, "customer_id long, order_date timestamp_ntz, financial_status string"
        ),
        "klaviyo_events": spark.createDataFrame(mails, "profile_id long, event_type string, occurred_at timestamp_ntz"),
    }
    return Warehouse.from_frames(spark, frames)


def shuffled_rows(df):
    """Rows that the exchanges of a query have written."""
    df.collect()
    left, rows = [df._jdf.queryExecution().executedPlan()], 0
    while left:
        node = left.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            left.append(node.plan())
        elif name == "Exchange":
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return rows


def test_a_purchase_day_is_handed_on_twice(spark):
    """Not once for each of the eight days on which it counts."""
    days = [DAY_ONE + dt.timedelta(days=10 * i, hours=9) for i in range(20)]
    orders = [(p, d, "paid") for p in range(50) for d in days]
    mails = [(p + 1000, "Sent Email", DAY_ONE + dt.timedelta(days=1)) for p in range(50)]
    found = post_purchase_mails(shop(spark, range(50), orders, mails))
    assert shuffled_rows(found) < 4 * len(orders)
    assert found.count() == 50


def test_purchase_days_are_those_of_all_pairs(spark):
    rng = random.Random(3)

    def moment():
        # whole days and half hours around them, so that windows end on orders
        return DAY_ONE + dt.timedelta(days=rng.randrange(-40, 30), minutes=rng.choice([0, 0, 30, 1439]))

    orders = [(rng.choice([0, 1, 2, None]), moment(), rng.choice(["paid", "paid", "refunded"])) for _ in range(150)]
    mails = [(rng.choice([1000, 1001, 1002, 7]), "Sent Email", moment()) for _ in range(300)]
    mails = [m for m in mails if m[2] >= DAY_ONE] + [(1000, "Opened Email", None)]
    for start, end in ((None, None), (dt.date(2024, 1, 10), dt.date(2024, 1, 20)), (None, dt.date(2024, 1, 12))):
        found = post_purchase_mails(shop(spark, range(3), orders, mails), start, end)
        want = []
        for profile, kind, t in mails:
            if t is None or (start and t.date() < start) or (end and t.date() > end):
                continue
            bought = {
                d.date() for who, d, status in orders
                if who is not None and who + 1000 == profile and status == "paid" and t - dt.timedelta(days=7) <= d < t
            }
            want += [(kind, t.date(), len(bought))] if bought else []
        assert want and sorted(map(tuple, found.collect())) == sorted(want)


def test_no_mails(spark):
    assert post_purchase_mails(shop(spark, [1], [(1, DAY_ONE, "paid")], [])).count() == 0


def test_the_ledger_merges_people(spark):
    first = dt.date(2024, 1, 1)
    facts = spark.createDataFrame([(first, 1)], "date date, n long")
    acts = spark.createDataFrame([(1, first, 2), (1, first, 3), (2, first, 4)], "id long, date date, spent long")
    days = DayLedger(spark, work_folder(spark, "ledger"), facts.schema, acts.schema, "id", {"spent": F.sum})
    days.begin(facts, acts, first - dt.timedelta(days=1))
    days.record(facts, acts, first, first)
    _, people = days.changes(first, first)
    stored = people.where(F.col("date") == F.lit(first)).select("id", "spent")
    assert sorted(map(tuple, stored.collect())) == [(1, 5), (2, 4)]
