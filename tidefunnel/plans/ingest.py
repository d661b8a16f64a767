"""Keyed upserts of the shop, mail and ad data, and small table edits.

Each operator takes the current table and a batch and returns the new table.
The registered queries build their batches from the given tables with Spark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import json_text, midnight
from tidefunnel.operators.keyed import KeyedTable
from tidefunnel.operators.merge import append_new, keyed_merge
from tidefunnel.operators.tables import folder_exists
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse


def now(wh: Warehouse) -> Column:
    """The moment of the run: midnight after ``as_of``."""
    return midnight(wh.as_of + dt.timedelta(days=1))


# --- operators ------------------------------------------------------------------------


def upsert_orders(orders: DataFrame, batch: DataFrame, at: Column, order_by: list[str]) -> DataFrame:
    """On a known shopify_order_id only the two states and updated_at change."""
    return keyed_merge(
        orders,
        batch,
        ["shopify_order_id"],
        ["financial_status", "fulfillment_status"],
        order_by,
        stamp=("updated_at", at) if "updated_at" in orders.columns else None,
    )


def merge_customers(customers: DataFrame, synced: DataFrame, order_by: list[str]) -> DataFrame:
    """Upsert customers by exact e-mail, setting their profile id.

    New customers get an id derived from the e-mail, so that a recomputed
    partition or a repeated run yields the same one.
    """
    batch = synced.withColumn("id", F.md5("email").cast(customers.schema["id"].dataType))
    return keyed_merge(customers, batch, ["email"], ["klaviyo_profile_id"], order_by)


def merge_profiles(
    profiles: DataFrame, synced: DataFrame, customers: DataFrame, order_by: list[str]
) -> DataFrame:
    """Upsert profiles by klaviyo_profile_id, linked to the customer by e-mail."""
    linked = synced.join(
        customers.select("email", F.col("id").alias("customer_id")), "email", "left"
    )
    return keyed_merge(profiles, linked, ["klaviyo_profile_id"], ["properties"], order_by)


def append_ad_events(events: DataFrame, batch: DataFrame) -> DataFrame:
    return append_new(events, batch, ["id"], ["date"])


def upsert_emails(emails: DataFrame, batch: DataFrame, order_by: list[str]) -> DataFrame:
    """On a known gmail_message_id only the subject is replaced."""
    return keyed_merge(emails, batch, ["gmail_message_id"], ["subject"], order_by)


def upsert_embeddings(vectors: DataFrame, batch: DataFrame, order_by: list[str]) -> DataFrame:
    return keyed_merge(vectors, batch, ["email_id"], ["embedding"], order_by)


def record_replies(
    replies: DataFrame, emails: DataFrame, batch: DataFrame, at: Column
) -> tuple[DataFrame, DataFrame]:
    """Append replies and mark their mails; a token count of 0 is stored as NULL."""
    tokens = ["tokens_prompt", "tokens_completion"]
    clean = batch.withColumns({t: F.nullif(F.col(t), F.lit(0)) for t in tokens})
    appended = replies.unionByName(clean.select(*replies.columns))
    answered = batch.select(F.col("email_id").alias("id")).distinct().withColumn("hit", F.lit(True))
    hit = F.coalesce("hit", F.lit(False))
    marked = (
        emails.join(answered, "id", "left")
        .withColumns(
            {
                "reply_sent_at": F.when(hit, at).otherwise(F.col("reply_sent_at")),
                "status": F.when(hit, "processed").otherwise(F.col("status")),
            }
        )
        .select(*emails.columns)
    )
    return appended, marked


def append_profile_list_members(members: DataFrame, batch: DataFrame) -> DataFrame:
    return append_new(members, batch, ["profile_id", "list_id"], ["added_at"])


def upsert_loyalty(enrolled: DataFrame, batch: DataFrame, order_by: list[str]) -> DataFrame:
    """Tier and balance are replaced; points earned and enrollment date stay."""
    return keyed_merge(enrolled, batch, ["customer_id"], ["loyalty_tier", "points_balance"], order_by)


def tag_vip_customers(customers: DataFrame, limit: int = 5) -> DataFrame:
    """Append the tag 'VIP' to the top buyers by revenue.

    Customers without a tag list are left as they are: a missing list neither
    contains nor lacks the tag.
    """
    top = (
        customers.where("total_orders > 0")
        .orderBy(F.desc("total_revenue"), "id")
        .limit(limit)
        .select("id", F.lit(True).alias("top"))
    )
    lacks = ~F.array_contains("tags", "VIP")
    tags = F.when(F.col("top") & lacks, F.array_append("tags", F.lit("VIP"))).otherwise(F.col("tags"))
    # at most ``limit`` rows
    return (
        customers.join(F.broadcast(top), "id", "left").withColumn("tags", tags).select(*customers.columns)
    )


# --- the same on stored tables: only the buckets of a batch are read and rewritten ------

# table: its key and the columns that a batch replaces
UPSERTS = {
    "orders": (["shopify_order_id"], ["financial_status", "fulfillment_status"]),
    "customers": (["email"], ["klaviyo_profile_id"]),
    "emails": (["gmail_message_id"], ["subject"]),
    "embeddings": (["email_id"], ["embedding"]),
}
BUCKETS = 64  # of a stored table; one bucket should fit a few tasks


def stored_table(name: str, content: DataFrame, root: str, buckets: int = BUCKETS) -> KeyedTable:
    """The stored table below ``root``: opened if it is there, else written from ``content``."""
    if folder_exists(content.sparkSession, f"{root}/meta"):
        return KeyedTable.open(content.sparkSession, root)
    return KeyedTable.create(content, root, UPSERTS[name][0], buckets)


def store_batch(
    table: KeyedTable, name: str, batch: DataFrame, order_by: list[str], at: Column | None = None
) -> list[int]:
    """Merge a batch into a stored table; ``at`` stamps updated orders.  Returns the rewritten buckets."""
    if name == "customers":
        batch = batch.withColumn("id", F.md5("email").cast(table.schema["id"].dataType))
    stamp = ("updated_at", at) if at is not None and "updated_at" in table.schema.names else None
    return table.merge(batch, UPSERTS[name][1], order_by, stamp)


# --- registered queries: batches derived from the given tables ---------------------


def _order_target(wh: Warehouse) -> DataFrame:
    return wh.table("shopify_orders").withColumn("updated_at", F.col("order_date"))


def _order_batch(wh: Warehouse) -> DataFrame:
    """Two states for every unpaid order, and a new order for every cancelled one."""
    orders = _order_target(wh)
    unpaid = orders.where("financial_status <> 'paid'").withColumn("fulfillment_status", F.lit("fulfilled"))
    first = unpaid.withColumns({"financial_status": F.lit("voided"), "seq": F.lit(1)})
    second = unpaid.withColumns(
        {"financial_status": F.lit("paid"), "total_price": F.lit(0).cast("decimal(12,2)"), "seq": F.lit(2)}
    )
    fresh = orders.where("cancelled_at is not null").withColumns(
        {"shopify_order_id": F.concat("shopify_order_id", F.lit("_again")), "seq": F.lit(1)}
    )
    return first.unionByName(second).unionByName(fresh)


def _merged_orders(wh: Warehouse) -> DataFrame:
    return upsert_orders(_order_target(wh), _order_batch(wh), now(wh), ["seq"])


def _stored_orders(wh: Warehouse) -> KeyedTable:
    """All orders, then the batch of the unpaid ones, then that of the repeated ones."""
    table = stored_table("orders", _order_target(wh), work_folder(wh.spark, "orders"))
    batch = _order_batch(wh)
    fresh = F.col("shopify_order_id").endswith("_again")
    for part in (batch.where(~fresh), batch.where(fresh)):
        store_batch(table, "orders", part, ["seq"], now(wh))
    return table


def _q_upsert_orders_stored(wh: Warehouse) -> DataFrame:
    return _order_columns(_stored_orders(wh).read())


def _q_orders_change_feed(wh: Warehouse) -> DataFrame:
    return _stored_orders(wh).changes(0).select("version", "change", "shopify_order_id", "financial_status")


def _q_upsert_emails_stored(wh: Warehouse) -> DataFrame:
    emails, batch = _email_batch(wh)
    table = stored_table("emails", emails, work_folder(wh.spark, "emails"))
    store_batch(table, "emails", batch, ["subject"])
    return table.read()


def _q_upsert_embeddings_stored(wh: Warehouse) -> DataFrame:
    vectors, batch = _vector_batch(wh)
    table = stored_table("embeddings", vectors, work_folder(wh.spark, "embeddings"))
    store_batch(table, "embeddings", batch, ["embedding"])
    return _vector_columns(table.read())


def _q_merge_customers_stored(wh: Warehouse) -> DataFrame:
    customers = _customer_target(wh)
    table = stored_table("customers", customers, work_folder(wh.spark, "customers"))
    store_batch(table, "customers", _synced_profiles(wh), ["klaviyo_profile_id"])
    return table.read()


def _order_columns(orders: DataFrame) -> DataFrame:
    return orders.select(
        "shopify_order_id",
        "customer_id",
        "financial_status",
        "fulfillment_status",
        F.col("total_price").cast("double").alias("total_price"),
    )


def _q_upsert_orders(wh: Warehouse) -> DataFrame:
    return _order_columns(_merged_orders(wh))


def _q_stamp_updated_at(wh: Warehouse) -> DataFrame:
    return _merged_orders(wh).select("shopify_order_id", "updated_at")


def _synced_profiles(wh: Warehouse) -> DataFrame:
    """Every known profile under its e-mail, and one new person per referral."""
    known = wh.table("klaviyo_profiles").select("email", F.col("id").cast("string").alias("p"))
    fresh = wh.table("referrals").select(
        F.concat(F.lit("friend"), F.col("id").cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("p"),
    )
    return known.union(fresh).select(
        "email",
        F.concat(F.lit("kp_"), "p").alias("klaviyo_profile_id"),
        F.concat(F.lit('{"k": "'), "p", F.lit('"}')).alias("properties"),
    )


def _customer_target(wh: Warehouse) -> DataFrame:
    return wh.table("customers").select(
        F.col("id").cast("string").alias("id"),
        "email",
        F.lit(None).cast("string").alias("klaviyo_profile_id"),
        F.col("total_orders").cast("long").alias("total_orders"),
    )


def _q_merge_customer_identity(wh: Warehouse) -> DataFrame:
    customers = _customer_target(wh)
    # profiles of customers with orders are already known, without properties
    profiles = customers.where("total_orders > 0").select(
        F.concat(F.lit("kp_"), "id").alias("klaviyo_profile_id"),
        F.col("id").alias("customer_id"),
        "email",
        F.lit(None).cast("string").alias("properties"),
    )
    synced = _synced_profiles(wh)
    order_by = ["klaviyo_profile_id"]
    merged = merge_customers(customers, synced, order_by)
    linked = merge_profiles(profiles, synced, merged, order_by)
    return merged.select("id", "email", "klaviyo_profile_id", "total_orders").join(
        linked.select("klaviyo_profile_id", "customer_id", "properties"), "klaviyo_profile_id", "full_outer"
    )


def _q_append_ad_events(wh: Warehouse) -> DataFrame:
    events = wh.table("ad_events")
    again = events.where("platform = 'meta'").withColumn("spend", F.lit(0).cast("decimal(12,2)"))
    fresh = events.where("platform = 'google'").withColumn("id", -F.col("id") - 1)
    return append_ad_events(events, again.unionByName(fresh).unionByName(fresh)).select(
        "id", "platform", F.col("spend").cast("double").alias("spend"), "date"
    )


def _email_batch(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    emails = wh.table("emails").drop("id")
    resent = emails.where("status = 'new'").withColumns(
        {"subject": F.concat(F.lit("Again: "), F.coalesce("subject", F.lit(""))), "body_text": F.lit("x")}
    )
    fresh = emails.where("status = 'failed'").withColumn(
        "gmail_message_id", F.concat("gmail_message_id", F.lit("_b"))
    )
    return emails, resent.unionByName(fresh)


def _q_upsert_emails(wh: Warehouse) -> DataFrame:
    emails, batch = _email_batch(wh)
    return upsert_emails(emails, batch, ["subject"])


def _vector_batch(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    vectors = wh.table("email_embeddings")
    flipped = F.transform("embedding", lambda x: -x)
    again = vectors.where("embedding[0] > 0").withColumn("embedding", flipped)
    fresh = vectors.withColumn("email_id", -F.col("email_id") - 1)
    return vectors, again.unionByName(fresh)


def _vector_columns(vectors: DataFrame) -> DataFrame:
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return vectors.select(
        "email_id", F.size("embedding").alias("dims"), F.round(total, 4).alias("component_sum")
    )


def _q_upsert_embeddings(wh: Warehouse) -> DataFrame:
    vectors, batch = _vector_batch(wh)
    return _vector_columns(upsert_embeddings(vectors, batch, ["embedding"]))


def _replies_and_mails(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    replies = wh.table("email_replies")
    emails = wh.table("emails").withColumn("reply_sent_at", F.lit(None).cast("timestamp_ntz"))
    batch = replies.withColumns(
        {"model": F.lit("model-c"), "tokens_completion": F.col("tokens_completion") - 2}
    )
    return record_replies(replies, emails, batch, now(wh))


def _q_record_replies(wh: Warehouse) -> DataFrame:
    return _replies_and_mails(wh)[0].select("email_id", "model", "tokens_prompt", "tokens_completion")


def _q_mark_replied(wh: Warehouse) -> DataFrame:
    return _replies_and_mails(wh)[1].select("id", "status", "reply_sent_at")


def _members(wh: Warehouse, event_type: str) -> DataFrame:
    return (
        wh.table("klaviyo_events")
        .where((F.col("event_type") == event_type) & F.col("profile_id").isNotNull())
        .select(
            "profile_id",
            json_text("event_properties", "source").alias("list_id"),
            F.col("occurred_at").alias("added_at"),
        )
    )


def _q_append_profile_list_members(wh: Warehouse) -> DataFrame:
    members = _members(wh, "Subscribed to List").groupBy("profile_id", "list_id").agg(
        F.min("added_at").alias("added_at")
    )
    return append_profile_list_members(members, _members(wh, "Viewed Page"))


def _q_upsert_loyalty(wh: Warehouse) -> DataFrame:
    enrolled = wh.table("loyalty_enrollments").withColumn("total_points_earned", F.col("points_balance"))
    batch = (
        wh.table("customers")
        .where("total_orders > 0")
        .select(
            F.col("id").alias("customer_id"),
            F.when(F.col("total_orders") > 10, "gold").otherwise("silver").alias("loyalty_tier"),
            (F.col("total_orders") * 100).cast("int").alias("points_balance"),
            (F.col("total_orders") * 100).cast("int").alias("total_points_earned"),
            F.lit(wh.as_of).alias("enrollment_date"),
        )
    )
    return upsert_loyalty(enrolled, batch, ["points_balance"])


def _q_tag_vip_customers(wh: Warehouse) -> DataFrame:
    tagged = tag_vip_customers(wh.table("customers"))
    return tagged.select("id", F.array_join("tags", ",").alias("tags"))


for _key, _plan in {
    "upsert_orders": _q_upsert_orders,
    "upsert_orders_stored": _q_upsert_orders_stored,
    "orders_change_feed": _q_orders_change_feed,
    "upsert_emails_stored": _q_upsert_emails_stored,
    "upsert_embeddings_stored": _q_upsert_embeddings_stored,
    "merge_customers_stored": _q_merge_customers_stored,
    "stamp_updated_at": _q_stamp_updated_at,
    "merge_customer_identity": _q_merge_customer_identity,
    "append_ad_events": _q_append_ad_events,
    "upsert_emails": _q_upsert_emails,
    "upsert_embeddings": _q_upsert_embeddings,
    "record_replies": _q_record_replies,
    "mark_replied": _q_mark_replied,
    "append_profile_list_members": _q_append_profile_list_members,
    "upsert_loyalty": _q_upsert_loyalty,
    "tag_vip_customers": _q_tag_vip_customers,
}.items():
    register(_key, _plan)
