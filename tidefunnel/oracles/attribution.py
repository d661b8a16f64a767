"""Check queries for attribution: every (order, touch) pair, listed."""

from tidefunnel.oracles.sqltext import rnd

TOUCHED = """
    pairs AS (
      SELECT o.id AS order_id, o.order_date, CAST(o.total_price AS DOUBLE) AS value, m.id,
             m.event_type, m.campaign_id, m.occurred_at,
             CAST(date_diff('microsecond', m.occurred_at, o.order_date) AS DOUBLE)
               / (7 * 86400 * 1e6) AS weeks,
             count(*) OVER (PARTITION BY o.id) AS n,
             row_number() OVER (PARTITION BY o.id ORDER BY m.occurred_at, m.id) AS i
      FROM shopify_orders o JOIN klaviyo_events m ON m.customer_id = o.customer_id
      WHERE m.event_type IN ('Opened Email', 'Clicked Email') AND m.occurred_at < o.order_date
        AND m.occurred_at >= o.order_date - INTERVAL '7' DAY)"""


def credited(weight: str) -> str:
    return f"""
        WITH {TOUCHED}, weighted AS (SELECT *, {weight} AS w FROM pairs)
        SELECT campaign_id, event_type, {rnd('sum(w)', 4)} AS credited_orders,
               {rnd('sum(w * value)', 4)} AS credited_revenue
        FROM weighted GROUP BY campaign_id, event_type"""


SQL = {
    "last_touch_attribution": f"""
        WITH {TOUCHED}
        SELECT order_id, event_type AS last_touch, campaign_id, occurred_at
        FROM pairs WHERE i = n""",
    "first_touch_attribution": """
        SELECT o.id AS order_id, m.event_type AS first_touch,
               min(m.occurred_at) AS first_touch_date
        FROM shopify_orders o JOIN klaviyo_events m ON m.customer_id = o.customer_id
        WHERE m.occurred_at <= o.order_date GROUP BY o.id, m.event_type""",
    "multi_touch_linear": credited("CAST(1 AS DOUBLE) / n"),
    "multi_touch_time_decay": credited(
        "pow(2, -weeks) / sum(pow(2, -weeks)) OVER (PARTITION BY order_id)"),
    "multi_touch_position": credited(
        "CASE WHEN n <= 2 THEN CAST(1 AS DOUBLE) / n WHEN i IN (1, n) THEN CAST(0.4 AS DOUBLE)"
        " ELSE CAST(0.2 AS DOUBLE) / (n - 2) END"),
}
