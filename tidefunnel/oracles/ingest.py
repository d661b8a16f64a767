"""Check queries for the upserts: the expected table after each batch."""

RUN = "CAST(:as_of + 1 AS TIMESTAMP)"

ORDERS = f"""
    after_merge AS (
      SELECT shopify_order_id, customer_id,
             CASE WHEN financial_status <> 'paid' THEN 'paid' ELSE financial_status END AS fs,
             CASE WHEN financial_status <> 'paid' THEN 'fulfilled' ELSE fulfillment_status END AS ff,
             CAST(total_price AS DOUBLE) AS total_price,
             CASE WHEN financial_status <> 'paid' THEN {RUN} ELSE order_date END AS updated_at
      FROM shopify_orders
      UNION ALL
      SELECT shopify_order_id || '_again', customer_id, financial_status, fulfillment_status,
             CAST(total_price AS DOUBLE), order_date
      FROM shopify_orders WHERE cancelled_at IS NOT NULL)"""

SOURCE = "event_properties->>'source'"

SQL = {
    "upsert_orders": f"""
        WITH {ORDERS} SELECT shopify_order_id, customer_id, fs AS financial_status,
               ff AS fulfillment_status, total_price FROM after_merge""",
    "stamp_updated_at": f"""
        WITH {ORDERS} SELECT shopify_order_id, updated_at FROM after_merge""",
    "merge_customer_identity": """
        SELECT 'kp_' || CAST(id AS VARCHAR) AS klaviyo_profile_id, CAST(id AS VARCHAR) AS id, email,
               CAST(total_orders AS BIGINT) AS total_orders, CAST(id AS VARCHAR) AS customer_id,
               '{"k": "' || CAST(id AS VARCHAR) || '"}' AS properties
        FROM customers
        UNION ALL
        SELECT 'kp_r' || CAST(id AS VARCHAR), md5('friend' || CAST(id AS VARCHAR) || '@example.com'),
               'friend' || CAST(id AS VARCHAR) || '@example.com', NULL,
               md5('friend' || CAST(id AS VARCHAR) || '@example.com'),
               '{"k": "r' || CAST(id AS VARCHAR) || '"}'
        FROM referrals""",
    "append_ad_events": """
        SELECT id, platform, CAST(spend AS DOUBLE) AS spend, date FROM ad_events
        UNION ALL SELECT -id - 1, platform, CAST(spend AS DOUBLE), date FROM ad_events
        WHERE platform = 'google'""",
    "upsert_emails": """
        SELECT gmail_message_id, CASE WHEN status = 'new' THEN 'Again: ' || coalesce(subject, '')
                                      ELSE subject END AS subject, body_text, status
        FROM emails
        UNION ALL SELECT gmail_message_id || '_b', subject, body_text, status
        FROM emails WHERE status = 'failed'""",
    "upsert_embeddings": """
        SELECT email_id, CAST(len(embedding) AS INTEGER) AS dims,
               round(CASE WHEN embedding[1] > 0 THEN -1 ELSE 1 END
                     * list_sum(CAST(embedding AS DOUBLE[])), 4) + 0.0 AS component_sum
        FROM email_embeddings
        UNION ALL SELECT -email_id - 1, CAST(len(embedding) AS INTEGER),
               round(list_sum(CAST(embedding AS DOUBLE[])), 4) FROM email_embeddings""",
    "record_replies": """
        SELECT email_id, model, tokens_prompt, tokens_completion FROM email_replies
        UNION ALL SELECT email_id, 'model-c', nullif(tokens_prompt, 0),
               nullif(tokens_completion - 2, 0) FROM email_replies""",
    "mark_replied": f"""
        SELECT id, CASE WHEN r.e IS NOT NULL THEN 'processed' ELSE status END AS status,
               CASE WHEN r.e IS NOT NULL THEN {RUN} END AS reply_sent_at
        FROM emails LEFT JOIN (SELECT DISTINCT email_id AS e FROM email_replies) r ON r.e = id""",
    "append_profile_list_members": f"""
        WITH j AS (SELECT profile_id, {SOURCE} AS list_id, event_type, occurred_at
                   FROM klaviyo_events WHERE event_type IN ('Subscribed to List', 'Viewed Page')
                     AND profile_id IS NOT NULL)
        SELECT profile_id, list_id,
               coalesce(min(occurred_at) FILTER (WHERE event_type = 'Subscribed to List'),
                        min(occurred_at)) AS added_at
        FROM j GROUP BY profile_id, list_id""",
    "upsert_loyalty": """
        SELECT coalesce(l.customer_id, c.id) AS customer_id,
               CASE WHEN c.id IS NULL THEN l.loyalty_tier WHEN c.total_orders > 10 THEN 'gold'
                    ELSE 'silver' END AS loyalty_tier,
               CASE WHEN c.id IS NULL THEN l.points_balance
                    ELSE CAST(c.total_orders * 100 AS INTEGER) END AS points_balance,
               coalesce(l.enrollment_date, :as_of) AS enrollment_date,
               CASE WHEN l.customer_id IS NULL THEN CAST(c.total_orders * 100 AS INTEGER)
                    ELSE l.points_balance END AS total_points_earned
        FROM loyalty_enrollments l
        FULL JOIN (SELECT * FROM customers WHERE total_orders > 0) c ON c.id = l.customer_id""",
    "tag_vip_customers": """
        WITH top AS (SELECT id FROM customers WHERE total_orders > 0
                     ORDER BY total_revenue DESC, id LIMIT 5)
        SELECT c.id, CASE WHEN t.id IS NOT NULL AND c.tag <> 'VIP' THEN c.tag || ',VIP'
                          ELSE c.tag END AS tags
        FROM customers c LEFT JOIN top t ON t.id = c.id""",
}

SQL |= {
    "upsert_orders_stored": SQL["upsert_orders"],
    "upsert_emails_stored": SQL["upsert_emails"],
    "upsert_embeddings_stored": SQL["upsert_embeddings"],
    "merge_customers_stored": """
        WITH synced AS (
          SELECT email, 'kp_' || CAST(id AS VARCHAR) AS kp FROM klaviyo_profiles
          UNION ALL SELECT 'friend' || CAST(id AS VARCHAR) || '@example.com', 'kp_r' || CAST(id AS VARCHAR)
          FROM referrals),
        latest AS (SELECT email, max(kp) AS kp FROM synced WHERE email IS NOT NULL GROUP BY email)
        SELECT CAST(c.id AS VARCHAR) AS id, c.email, l.kp AS klaviyo_profile_id,
               CAST(c.total_orders AS BIGINT) AS total_orders
        FROM customers c LEFT JOIN latest l ON l.email = c.email
        UNION ALL SELECT md5(email), email, kp, NULL FROM latest
        WHERE email NOT IN (SELECT email FROM customers WHERE email IS NOT NULL)
        UNION ALL SELECT NULL, NULL, kp, NULL FROM synced WHERE email IS NULL""",
    "orders_change_feed": """
        SELECT 1 AS version, 'update' AS change, shopify_order_id, 'paid' AS financial_status
        FROM shopify_orders WHERE financial_status <> 'paid'
        UNION ALL SELECT 2, 'insert', shopify_order_id || '_again', financial_status
        FROM shopify_orders WHERE cancelled_at IS NOT NULL""",
}
