"""How every business entity is derived from the raw parquet tables.

Fixed values: the expressions are the shared fixture mapping of FIXTURES.md.
They are written in the SQL subset that Spark and DuckDB read alike, so the
loader (Spark) and the check queries (DuckDB) use one and the same text.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Entity:
    base: str
    columns: tuple[tuple[str, str], ...]
    where: str | None = None
    key: tuple[str, ...] = ("id",)
    needs: tuple[str, ...] = field(default=())


EVENT_PROPERTIES = (
    "'{\"referrer\": ' || case event_id % 4 when 0 then '\"google\"' when 1 then '\"meta\"'"
    " when 2 then '\"email\"' else 'null' end"
    " || ', \"utm_source\": ' || case event_id % 3 when 0 then '\"email\"' when 1 then '\"social\"'"
    " else 'null' end"
    " || ', \"utm_medium\": ' || case event_id % 2 when 0 then '\"cpc\"' else 'null' end"
    " || ', \"utm_campaign\": \"c' || cast(event_id % 5 as varchar(4)) || '\"'"
    " || ', \"scroll_depth\": ' || cast(event_id % 101 as varchar(4)) || '}'"
)

ENTITIES: dict[str, Entity] = {
    "shopify_orders": Entity(
        base="orders",
        columns=(
            ("id", "o_orderkey"),
            ("shopify_order_id", "'order_' || cast(o_orderkey as varchar(20))"),
            ("customer_id", "o_custkey"),
            ("order_date", "o_orderdate + interval '8217' day"),
            ("source",
             "case o_orderpriority when '1-URGENT' then 'online_store' when '2-HIGH' then 'pos'"
             " when '3-MEDIUM' then 'api' when '4-NOT SPECIFIED' then 'draft_order' end"),
            ("financial_status",
             "case when o_orderstatus in ('F','O') then 'paid'"
             " when o_orderkey % 2 = 0 then 'refunded' else 'pending' end"),
            ("fulfillment_status",
             "case o_orderstatus when 'F' then 'fulfilled' when 'O' then 'partial'"
             " else 'unfulfilled' end"),
            ("total_price", "cast(o_totalprice as decimal(12,2))"),
            ("refund_status",
             "case when o_orderstatus = 'P' and o_orderkey % 4 = 0 then 'full'"
             " when o_orderstatus = 'P' and o_orderkey % 4 = 2 then 'partial' end"),
            ("cancelled_at",
             "case when o_orderkey % 25 = 0 then o_orderdate + interval '8218' day end"),
        ),
    ),
    "customers": Entity(
        base="customer c left join (select customer_id, count(*) as n, sum(total_price) as rev,"
             " min(cast(order_date as date)) as f, max(cast(order_date as date)) as l"
             " from shopify_orders where financial_status = 'paid' group by customer_id) o"
             " on o.customer_id = c.c_custkey",
        columns=(
            ("id", "c.c_custkey"),
            ("email", "lower(c.c_name) || '@example.com'"),
            ("source",
             "case c.c_custkey % 4 when 0 then 'shopify' when 1 then 'klaviyo'"
             " when 2 then 'api' else 'ad' end"),
            ("total_orders", "coalesce(o.n, 0)"),
            ("total_revenue", "cast(coalesce(o.rev, 0) as decimal(12,2))"),
            ("average_order_value",
             "case when o.n > 0 then round(cast(o.rev as double) / o.n + 1e-9, 2) else 0 end"),
            ("first_order_date", "o.f"),
            ("last_order_date", "o.l"),
            ("is_first_time_customer", "coalesce(o.n, 0) = 1"),
            ("tag",
             "case when c.c_custkey % 20 = 0 then 'VIP' when c.c_custkey % 20 = 1 then 'vip'"
             " when c.c_custkey % 20 < 15 then 'repeat' end"),
            ("created_at",
             "timestamp '2023-01-01 00:00:00' + interval '1' day * cast(c.c_custkey % 365 as int)"),
        ),
        needs=("shopify_orders",),
    ),
    "shopify_products": Entity(
        base="part",
        columns=(
            ("id", "p_partkey"),
            ("title", "p_name"),
            ("handle", "replace(lower(p_name), ' ', '-')"),
            ("product_type", "p_type"),
            ("vendor", "p_brand"),
            ("status", "case when p_partkey % 10 = 9 then 'draft' else 'active' end"),
        ),
    ),
    "shopify_product_variants": Entity(
        base="part",
        columns=(
            ("id", "p_partkey"),
            ("product_id", "p_partkey"),
            ("sku", "'SKU-' || cast(p_partkey as varchar(20))"),
            ("price", "cast(p_retailprice as decimal(12,2))"),
            ("cost", "cast(10 + p_partkey % 500 as decimal(12,2))"),
            ("inventory_quantity", "p_size * 10"),
        ),
    ),
    "shopify_order_line_items": Entity(
        base="lineitem",
        columns=(
            ("order_id", "l_orderkey"),
            ("line_number", "l_linenumber"),
            ("product_id", "l_partkey"),
            ("variant_id", "l_partkey"),
            ("quantity", "cast(l_quantity as int)"),
            ("line_total", "cast(l_extendedprice as decimal(12,2))"),
        ),
        key=("order_id", "line_number"),
    ),
    "shopify_events": Entity(
        base="events",
        where="event_type <> 'signup'",
        columns=(
            ("id", "event_id"),
            ("event_type",
             "case event_type when 'view' then 'page_viewed'"
             " when 'click' then case when event_id % 3 < 2 then 'product_viewed'"
             " when event_id % 2 = 0 then 'add_to_cart' else 'cart_added' end"
             " when 'error' then case when event_id % 2 = 0 then 'checkout_started'"
             " else 'add_to_wishlist' end else 'checkout_completed' end"),
            ("customer_id", "case when event_id % 10 = 9 then null else user_id end"),
            ("product_id", "event_id % 200"),
            ("session_id",
             "case when event_id % 50 = 49 then null else 's' || cast(user_id as varchar(20))"
             " || '-' || cast(cast(ts as date) as varchar(10)) end"),
            ("event_properties", EVENT_PROPERTIES),
            ("occurred_at", "ts"),
        ),
    ),
    "klaviyo_profiles": Entity(
        base="customer",
        columns=(
            ("id", "c_custkey"),
            ("customer_id", "c_custkey"),
            ("email", "lower(c_name) || '@example.com'"),
        ),
    ),
    "klaviyo_events": Entity(
        base="events",
        where="event_type in ('signup', 'view')",
        columns=(
            ("id", "event_id"),
            ("event_type",
             "case event_id % 5 when 0 then 'Subscribed to List' when 1 then 'Opened Email'"
             " when 2 then 'Clicked Email' when 3 then 'Sent Email'"
             " else case when event_id % 2 = 0 then 'Sent Email' else 'Viewed Page' end end"),
            ("profile_id", "user_id"),
            ("customer_id", "user_id"),
            ("campaign_id", "event_id % 10"),
            ("event_properties",
             "'{\"source\": \"' || case event_id % 3 when 0 then 'popup'"
             " when 1 then 'embedded_form' else 'checkout' end || '\"}'"),
            ("occurred_at", "ts"),
        ),
    ),
    "klaviyo_campaigns": Entity(
        base="supplier",
        columns=(
            ("id", "s_suppkey"),
            ("name",
             "case s_suppkey % 5 when 0 then 'Winback ' when 1 then 'Re-Engage '"
             " when 2 then 'Reactivate ' when 3 then 'New Arrivals ' else 'Flash Sale ' end"
             " || cast(s_suppkey as varchar(20))"),
            ("type", "case when s_suppkey % 4 = 3 then 'sms' else 'email' end"),
            ("status", "case when s_suppkey % 6 = 5 then 'draft' else 'sent' end"),
            ("send_date",
             "timestamp '2024-01-01 09:00:00' + interval '1' day * cast(s_suppkey % 30 as int)"),
            ("recipients_count", "cast(500 + (s_suppkey * 37) % 4500 as int)"),
            ("delivered_count",
             "cast(case when s_suppkey % 10 = 9 then 0 else 475 + (s_suppkey * 37) % 4000 end"
             " as int)"),
            ("unique_opens_count", "cast((s_suppkey * 53) % 400 as int)"),
            ("unique_clicks_count", "cast((s_suppkey * 31) % 90 as int)"),
            ("unsubscribes_count", "cast(s_suppkey % 11 as int)"),
            ("revenue", "cast((s_suppkey * 97) % 5000 as decimal(12,2))"),
        ),
    ),
    "klaviyo_flows": Entity(
        base="nation",
        columns=(
            ("id", "n_nationkey"),
            ("name", "'Flow ' || n_name"),
            ("trigger_type",
             "case n_nationkey % 4 when 0 then 'welcome_series' when 1 then 'abandoned_cart'"
             " when 2 then 'browse_abandonment' else 'post_purchase' end"),
            ("recipients_entered_count", "200 + n_nationkey * 70"),
            ("conversion_count", "10 + n_nationkey * 3"),
        ),
    ),
    "klaviyo_flow_steps": Entity(
        base="nation cross join region",
        columns=(
            ("flow_id", "n_nationkey"),
            ("step_order", "r_regionkey + 1"),
            ("recipients_count",
             "case when n_nationkey = 7 and r_regionkey = 1 then 0"
             " else 200 + n_nationkey * 70 - r_regionkey * 40 end"),
        ),
        key=("flow_id", "step_order"),
    ),
    "klaviyo_lists": Entity(
        base="region",
        columns=(
            ("id", "r_regionkey"),
            ("name", "r_name"),
            ("profile_count", "50 + r_regionkey * 90"),
        ),
    ),
    "klaviyo_predictive_metrics": Entity(
        base="customer cross join (select 0 as k union all select 10 as k) s",
        columns=(
            ("profile_id", "c_custkey"),
            ("predicted_next_order_date",
             "case when c_custkey % 13 = 0 then null"
             " else date '2024-01-10' + cast((c_custkey * 7 + s.k * 3) % 40 as int) end"),
            ("predicted_churn_probability",
             "cast(cast((c_custkey * 37 + s.k * 411) % 10000 as double) / 10000"
             " as decimal(5,4))"),
            ("predicted_lifetime_value",
             "cast((c_custkey * 71 + s.k) % 2000 as decimal(12,2))"),
            ("email_engagement_probability",
             "case when c_custkey % 17 = 0 then null"
             " else cast(cast((c_custkey * 59 + s.k * 100) % 10000 as double) / 10000"
             " as decimal(5,4)) end"),
            ("calculated_at",
             "timestamp '2024-01-10 06:00:00' + interval '1' day * s.k"),
        ),
        key=("profile_id", "calculated_at"),
    ),
    "ad_events": Entity(
        base="events",
        columns=(
            ("id", "event_id"),
            ("platform",
             "case event_id % 3 when 0 then 'meta' when 1 then 'google' else 'tiktok' end"),
            ("campaign_id",
             "case when event_id % 11 = 0 then null"
             " else 'ad_campaign_' || cast(event_id % 10 as varchar(4)) end"),
            ("event_type",
             "case event_type when 'view' then 'impression' when 'click' then 'click'"
             " when 'signup' then 'conversion' when 'purchase' then 'purchase' end"),
            ("customer_id", "case when event_id % 7 = 0 then null else user_id end"),
            ("spend", "cast(value as decimal(12,2))"),
            ("impressions", "cast(event_id % 4900 as int)"),
            ("clicks", "cast(event_id % 90 as int)"),
            ("conversions", "cast(event_id % 5 as int)"),
            ("revenue",
             "cast(cast(value as decimal(12,2)) * (event_id % 7) as decimal(12,2))"),
            ("date", "cast(ts as date)"),
        ),
    ),
    "referrals": Entity(
        base="customer",
        where="c_custkey % 3 = 0",
        columns=(
            ("id", "c_custkey"),
            ("referrer_customer_id", "c_custkey % 100"),
            ("referred_customer_id", "c_custkey"),
            ("referral_status",
             "case c_custkey % 4 when 0 then 'pending' when 1 then 'completed'"
             " else 'converted' end"),
            ("created_at",
             "timestamp '2023-12-01 00:00:00' + interval '1' day * cast(c_custkey % 60 as int)"),
        ),
    ),
    "reviews": Entity(
        base="orders",
        where="o_orderkey % 5 = 0",
        columns=(
            ("id", "o_orderkey"),
            ("customer_id", "o_custkey"),
            ("order_id", "o_orderkey"),
            ("rating", "cast(1 + o_orderkey % 5 as int)"),
            ("created_at", "o_orderdate + interval '8220' day"),
        ),
    ),
    "ugc_submissions": Entity(
        base="customer",
        where="c_custkey % 4 = 1",
        columns=(
            ("id", "c_custkey"),
            ("customer_id", "c_custkey"),
            ("platform",
             "case c_custkey % 5 when 0 then 'instagram' when 1 then 'facebook'"
             " when 2 then 'tiktok' when 3 then 'website' else 'email' end"),
            ("status",
             "case c_custkey % 3 when 0 then 'approved' when 1 then 'pending'"
             " else 'rejected' end"),
            ("created_at",
             "timestamp '2023-12-15 00:00:00' + interval '1' day * cast(c_custkey % 45 as int)"),
        ),
    ),
    "loyalty_enrollments": Entity(
        base="customer",
        where="c_custkey % 2 = 0",
        columns=(
            ("customer_id", "c_custkey"),
            ("loyalty_tier",
             "case c_custkey % 10 when 0 then 'vip' when 2 then 'platinum' when 4 then 'gold'"
             " when 6 then 'silver' else 'member' end"),
            ("points_balance", "cast((c_custkey * 13) % 15000 as int)"),
            ("enrollment_date", "date '2023-01-01' + cast(c_custkey % 365 as int)"),
        ),
        key=("customer_id",),
    ),
    "nps_surveys": Entity(
        base="orders",
        where="o_orderkey % 3 = 0",
        columns=(
            ("id", "o_orderkey"),
            ("customer_id", "o_custkey"),
            ("nps_score",
             "case when o_orderkey % 29 = 0 then null else cast(o_orderkey % 11 as int) end"),
            ("survey_date", "cast(o_orderdate + interval '8219' day as date)"),
        ),
    ),
    "emails": Entity(
        base="documents",
        columns=(
            ("id", "doc_id"),
            ("gmail_message_id", "'msg_' || cast(doc_id as varchar(20))"),
            ("subject", "case when doc_id % 9 = 0 then null else 'Subject ' || source end"),
            ("body_text", "text"),
            ("status",
             "case doc_id % 3 when 0 then 'new' when 1 then 'processed' else 'failed' end"),
        ),
    ),
    "email_embeddings": Entity(
        base="embeddings",
        columns=(("email_id", "vec_id"), ("embedding", "embedding")),
        key=("email_id",),
    ),
    "email_replies": Entity(
        base="conversations",
        where="role = 'assistant'",
        columns=(
            ("email_id", "conv_id"),
            ("model", "case when turn % 2 = 0 then 'model-a' else 'model-b' end"),
            ("reply_text", "text"),
            ("tokens_prompt", "cast(length(text) as int)"),
            ("tokens_completion", "cast(turn + 1 as int)"),
        ),
        key=("email_id", "tokens_completion"),
    ),
}
