"""Check queries for data quality and the verification samples."""

from tidefunnel.oracles.commerce import SQL as COMMERCE
from tidefunnel.oracles.sqltext import money, rnd
from tidefunnel.plans.quality import FOREIGN_KEYS, ORDER_STATES
from tidefunnel.sources.mapping import ENTITIES


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def profile(name: str) -> str:
    cells = " + ".join(f"count({c})" for c, _ in ENTITIES[name].columns)
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, {cells} AS filled_cells,"
            f" {len(ENTITIES[name].columns)} AS column_count FROM {name}")


STATES = ", ".join(f"'{s}'" for s in ORDER_STATES)
LATE = "count(*) FILTER (WHERE occurred_at > :as_of + 1)"

SQL = {
    "load_sources": union(profile(n) for n in ENTITIES),
    "table_row_counts": union(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ENTITIES),
    "empty_tables": "SELECT table_name FROM (" + union(
        f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ENTITIES) + ") WHERE n = 0",
    "table_column_counts": union(
        f"SELECT '{n}' AS table_name, {len(e.columns)} AS column_count"
        f" FROM (SELECT count(*) FROM {n})" for n, e in ENTITIES.items()),
    "dq_unique_email": """
        SELECT email, count(*) AS copies FROM customers GROUP BY email HAVING count(*) > 1""",
    "dq_order_status_enum": f"""
        SELECT financial_status, count(*) AS orders FROM shopify_orders
        WHERE financial_status NOT IN ({STATES}) GROUP BY 1""",
    "dq_revenue_consistency": f"""
        WITH t AS (SELECT o.id, o.total_price, sum(l.line_total) AS s FROM shopify_orders o
                   LEFT JOIN shopify_order_line_items l ON l.order_id = o.id GROUP BY 1, 2)
        SELECT id AS order_id, {money('total_price')} AS total_price, {money('s')} AS lines_total
        FROM t WHERE total_price <> coalesce(s, 0)""",
    "dq_event_timestamps": union(
        f"SELECT '{n}' AS table_name, count(*) AS events, {LATE} AS too_late FROM {n}"
        for n in ("shopify_events", "klaviyo_events")),
    "dq_value_ranges": union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS checked,"
        f" count(*) FILTER (WHERE NOT {c} BETWEEN {lo} AND {hi}) AS out_of_range FROM {t}"
        for t, c, lo, hi in (("reviews", "rating", 1, 5), ("nps_surveys", "nps_score", 0, 10))),
    "dq_foreign_keys": union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS parent, count(*) AS orphans"
        f" FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT id FROM {p})"
        for t, c, p in FOREIGN_KEYS),
    "top_customers_sample": f"""
        SELECT * FROM ({COMMERCE['customer_lifetime_metrics']})
        ORDER BY total_revenue DESC, customer_id LIMIT 5""",
    "campaign_sample": f"""
        SELECT name, type, recipients_count, {rnd('open_rate * 100', 2)} AS open_rate_pct,
               {rnd('click_rate * 100', 2)} AS click_rate_pct, revenue
        FROM ({COMMERCE['campaign_performance_summary']}) ORDER BY campaign_id LIMIT 5""",
    "top_products_sample": f"""
        SELECT title, total_units_sold, total_revenue,
               {rnd('conversion_rate * 100', 2)} AS conversion_rate_pct
        FROM ({COMMERCE['product_performance_summary']})
        ORDER BY total_revenue DESC NULLS FIRST, product_id LIMIT 5""",
}
