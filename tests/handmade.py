"""Small entity tables full of edge cases, for Spark and DuckDB alike.

Few customers, sessions and moments, so that rows collide: ties, shared
sessions, moments at midnight, exactly 30 seconds or 7 days apart, missing
keys, unknown ids, and one customer with a third of all rows.
"""

from __future__ import annotations

import datetime as dt
import random
import tempfile
from decimal import Decimal

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidefunnel.sources.warehouse import Warehouse

SCHEMAS = {
    "customers": "id long, email string, source string, total_orders long,"
                 " total_revenue decimal(12,2), average_order_value double,"
                 " first_order_date date, last_order_date date, is_first_time_customer boolean,"
                 " tag string, created_at timestamp_ntz",
    "shopify_orders": "id long, shopify_order_id string, customer_id long, order_date timestamp_ntz,"
                      " source string, financial_status string, fulfillment_status string,"
                      " total_price decimal(12,2), refund_status string, cancelled_at timestamp_ntz",
    "shopify_products": "id long, title string, handle string, product_type string, vendor string,"
                        " status string",
    "shopify_product_variants": "id long, product_id long, sku string, price decimal(12,2),"
                                " cost decimal(12,2), inventory_quantity int",
    "shopify_order_line_items": "order_id long, line_number int, product_id long, variant_id long,"
                                " quantity int, line_total decimal(12,2)",
    "shopify_events": "id long, event_type string, customer_id long, product_id long,"
                      " session_id string, event_properties string, occurred_at timestamp_ntz",
    "klaviyo_profiles": "id long, customer_id long, email string",
    "klaviyo_events": "id long, event_type string, profile_id long, customer_id long,"
                      " campaign_id long, event_properties string, occurred_at timestamp_ntz",
    "klaviyo_campaigns": "id long, name string, type string, status string, send_date timestamp_ntz,"
                         " recipients_count int, delivered_count int, unique_opens_count int,"
                         " unique_clicks_count int, unsubscribes_count int, revenue decimal(12,2)",
    "klaviyo_flows": "id int, name string, trigger_type string, recipients_entered_count int,"
                     " conversion_count int",
    "klaviyo_flow_steps": "flow_id int, step_order int, recipients_count int",
    "klaviyo_lists": "id int, name string, profile_count int",
    "klaviyo_predictive_metrics": "profile_id long, predicted_next_order_date date,"
                                  " predicted_churn_probability decimal(5,4),"
                                  " predicted_lifetime_value decimal(12,2),"
                                  " email_engagement_probability decimal(5,4),"
                                  " calculated_at timestamp_ntz",
    "ad_events": "id long, platform string, campaign_id string, event_type string, customer_id long,"
                 " spend decimal(12,2), impressions int, clicks int, conversions int,"
                 " revenue decimal(12,2), date date",
    "referrals": "id long, referrer_customer_id long, referred_customer_id long,"
                 " referral_status string, created_at timestamp_ntz",
    "reviews": "id long, customer_id long, order_id long, rating int, created_at timestamp_ntz",
    "ugc_submissions": "id long, customer_id long, platform string, status string,"
                       " created_at timestamp_ntz",
    "loyalty_enrollments": "customer_id long, loyalty_tier string, points_balance int,"
                           " enrollment_date date",
    "nps_surveys": "id long, customer_id long, nps_score int, survey_date date",
    "emails": "id long, gmail_message_id string, subject string, body_text string, status string",
    "email_embeddings": "email_id long, embedding array<float>",
    "email_replies": "email_id long, model string, reply_text string, tokens_prompt int,"
                     " tokens_completion int",
}

ARROW = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
    "boolean": pa.bool_(), "date": pa.date32(), "timestamp_ntz": pa.timestamp("us"),
    "decimal(12,2)": pa.decimal128(12, 2), "decimal(5,4)": pa.decimal128(5, 4),
    "array<float>": pa.list_(pa.float32()),
}

TIMES = [
    dt.timedelta(0), dt.timedelta(microseconds=1), dt.timedelta(hours=12),
    dt.timedelta(hours=12, seconds=29, milliseconds=600), dt.timedelta(hours=12, seconds=30),
    dt.timedelta(hours=12, seconds=29, milliseconds=400), dt.timedelta(hours=12, microseconds=1),
    dt.timedelta(hours=23, minutes=59, seconds=59, microseconds=999_999),
]
FIRST = dt.datetime(2024, 1, 1)


def split(schema: str) -> list[tuple[str, str]]:
    out, depth, part = [], 0, ""
    for ch in schema + ",":
        if ch == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append((name, kind))
            part = ""
        else:
            depth += {"(": 1, ")": -1}.get(ch, 0)
            part += ch
    return out


def make_rows(seed: int) -> dict[str, list[tuple]]:
    r = random.Random(seed)
    n_customers = 9

    def person(unknown: bool = True, missing: bool = True):
        x = r.random()
        if x < 0.33:
            return 1  # the hot one
        if missing and x < 0.42:
            return None
        if unknown and x < 0.47:
            return 90 + r.randrange(2)
        return r.randrange(n_customers)

    def moment(days: int = 30, back: int = 0):
        return FIRST + dt.timedelta(days=r.randrange(-back, days)) + r.choice(TIMES)

    def cents(top: int = 200):
        return Decimal(r.randrange(top * 100)) / 100

    orders = []
    for i in range(70):
        when = moment(30, 75) if r.random() < 0.5 else moment(30)
        orders.append((
            i, f"order_{i}", person(unknown=False), when,
            r.choice(["online_store", "pos", "google", None]),
            r.choice(["paid", "paid", "paid", "refunded", "pending", "odd"]),
            r.choice(["fulfilled", "partial", None]), cents(),
            r.choice([None, "full", "partial"]),
            when + dt.timedelta(days=1) if r.random() < 0.2 else None,
        ))
    customers = []
    for c in range(n_customers + 2):  # two without any order
        paid = [o for o in orders if o[2] == c and o[5] == "paid"]
        total = sum((o[7] for o in paid), Decimal(0))
        days = [o[3].date() for o in paid]
        hidden = c == 4  # order counted, dates unknown
        customers.append((
            c, f"c{c}@example.com", r.choice(["shopify", "ad", "api"]), len(paid), total,
            float(round(total / len(paid), 2)) if paid else 0.0,
            min(days) if days and not hidden else None,
            max(days) if days and not hidden else None,
            len(paid) == 1 or c == 2, r.choice(["VIP", "vip", "repeat", None]),
            FIRST + dt.timedelta(days=c),
        ))
    sessions = [f"s{i}" for i in range(14)] + [None]
    web_types = [
        "page_viewed", "page_viewed", "product_viewed", "add_to_cart", "cart_added",
        "checkout_started", "checkout_completed", "add_to_wishlist",
    ]
    props = [
        '{"referrer": "google", "utm_source": null, "scroll_depth": 40}',
        '{"referrer": null, "utm_source": "email", "utm_medium": "cpc", "utm_campaign": "c1"}',
        '{"utm_source": "unknown", "utm_medium": null, "scroll_depth": null}',
        '{"referrer": "meta ads", "scroll_depth": 7.5}', "{}",
    ]
    web = [
        (i, r.choice(web_types), person(), r.randrange(6), r.choice(sessions), r.choice(props),
         moment(12) if r.random() < 0.7 else moment(30))
        for i in range(260)
    ]
    mail_types = [
        "Sent Email", "Opened Email", "Clicked Email", "Subscribed to List", "Viewed Page",
        "Unsubscribed",
    ]
    mails = []
    for i in range(220):
        at = moment()
        if r.random() < 0.4:  # around an order: same moment, 7 days later, 1 us beyond
            at = r.choice(orders)[3] + r.choice([
                dt.timedelta(0), dt.timedelta(days=7), dt.timedelta(days=7, microseconds=1),
                dt.timedelta(microseconds=1), dt.timedelta(days=-7),
                dt.timedelta(days=-7, microseconds=-1), dt.timedelta(days=-3), dt.timedelta(days=3),
            ])
        who = person()
        mails.append((
            i, r.choice(mail_types), r.choice([who, who, person()]), who,
            r.choice([0, 1, 2, 3, None]), r.choice(['{"source": "popup"}', '{"source": "checkout"}']),
            at,
        ))
    campaigns = [
        (i, name, kind, status, FIRST + dt.timedelta(days=i, hours=9), 100 * i, delivered, 7 * i, 3 * i,
         i, Decimal(50 * i))
        for i, (name, kind, status, delivered) in enumerate([
            ("WinBack one", "email", "sent", 90), ("News", "sms", "sent", 0),
            ("Please Re-Engage", "email", "draft", 30), ("We REACTIVATE you", "email", "sent", 77),
        ])
    ]
    ad_rows = [
        (i, r.choice(["meta", "google", "tiktok"]), r.choice(["a", "b", None]),
         r.choice(["impression", "click", "conversion", "purchase", None]), person(), cents(20)
         if r.random() < 0.8 else Decimal(0), r.randrange(50) if r.random() < 0.8 else 0,
         r.randrange(9) if r.random() < 0.8 else 0, r.randrange(3), cents(50),
         (FIRST + dt.timedelta(days=r.randrange(10))).date())
        for i in range(150)
    ]
    profiles = [(p, p if p != 6 else None, f"c{p}@example.com") for p in range(n_customers)]
    predictions = []
    for p in range(n_customers):
        for at in sorted(r.sample(range(28), r.randrange(4))):
            # several snapshots on one day differ by the hour
            for hour in ([6, 18] if r.random() < 0.3 else [6]):
                predictions.append((
                    p, (FIRST + dt.timedelta(days=r.randrange(45))).date() if r.random() < 0.8 else None,
                    Decimal(r.randrange(10000)) / 10000 if r.random() < 0.9 else None,
                    cents() if r.random() < 0.9 else None,
                    Decimal(r.randrange(10000)) / 10000 if r.random() < 0.7 else None,
                    FIRST + dt.timedelta(days=at, hours=hour),
                ))
    dims = 4
    vectors = [(i, [float(r.randrange(-3, 4)) + 0.5 for _ in range(dims)]) for i in range(40)]
    return {
        "customers": customers,
        "shopify_orders": orders,
        "shopify_products": [(i, f"t{i}", f"h{i}", "type", "v", "active") for i in range(7)],
        "shopify_product_variants": [
            (i, i, f"SKU-{i}", cents(), cents(50), 10 * (i % 3)) for i in range(7)
        ],
        "shopify_order_line_items": [
            (o, n, r.randrange(6), r.randrange(6), 1 + r.randrange(4), cents())
            for o in range(60) for n in range(r.randrange(4))
        ],
        "shopify_events": web,
        "klaviyo_profiles": profiles,
        "klaviyo_events": mails,
        "klaviyo_campaigns": campaigns,
        "klaviyo_flows": [(i, f"f{i}", "welcome_series", 10 * i, i) for i in range(3)],
        "klaviyo_flow_steps": [(f, s, (f * 37 + s * 11) % 4 * 10) for f in range(3) for s in range(1, 5)],
        "klaviyo_lists": [(0, "l", 5)],
        "klaviyo_predictive_metrics": predictions,
        "ad_events": ad_rows,
        "referrals": [
            (i, person(missing=False), r.choice([person(), None]),
             r.choice(["pending", "completed", "converted"]), moment()) for i in range(25)
        ],
        "reviews": [
            (i, person(missing=False), r.randrange(70), 1 + r.randrange(5), moment(30, 20))
            for i in range(30)
        ],
        "ugc_submissions": [
            (i, person(missing=False), r.choice(["instagram", "website", "twitter", "email"]),
             r.choice(["approved", "pending"]), moment()) for i in range(20)
        ],
        "loyalty_enrollments": [
            (c, r.choice(["vip", "gold", "member"]), r.randrange(900), (FIRST + dt.timedelta(days=c)).date())
            for c in range(0, n_customers, 2)
        ],
        "nps_surveys": [
            (i, person(missing=False), r.choice([0, 6, 7, 8, 9, 10, None]),
             (FIRST + dt.timedelta(days=r.randrange(-20, 30))).date()) for i in range(40)
        ],
        "emails": [
            (i, f"msg_{i}", r.choice([None, "", f"Subject {i}"]), r.choice([None, "", f"body {i} é"]),
             r.choice(["new", "processed", "failed"])) for i in range(30)
        ],
        "email_embeddings": vectors,
        "email_replies": [(i % 9, r.choice(["m1", "m2"]), "text", r.randrange(3), 1 + i % 4) for i in range(20)],
    }


def arrow_table(name: str, rows: list[tuple]) -> pa.Table:
    columns = split(SCHEMAS[name])
    arrays = [
        pa.array([row[i] for row in rows], ARROW[kind]) for i, (_, kind) in enumerate(columns)
    ]
    return pa.Table.from_arrays(arrays, names=[c for c, _ in columns])


def build(spark: SparkSession, rows: dict[str, list[tuple]]):
    """The same tables as a warehouse and as a DuckDB connection."""
    con = duckdb.connect()
    folder = tempfile.mkdtemp(prefix="handmade-")
    frames = {}
    for name, schema in SCHEMAS.items():
        path = f"{folder}/{name}.parquet"
        pq.write_table(arrow_table(name, rows[name]), path)
        con.execute(f"create table {name} as select * from '{path}'")
        frames[name] = spark.read.schema(schema).parquet(path)
    tags = F.when(F.col("tag").isNotNull(), F.array("tag"))
    frames["customers"] = frames["customers"].withColumn("tags", tags).drop("tag")
    return Warehouse.from_frames(spark, frames), con
