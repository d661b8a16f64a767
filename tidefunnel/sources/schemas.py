"""Declared schemas: raw parquet tables and the typed business entities.

Nothing is inferred at read time.  Money is decimal(12,2), rates are
decimal(5,4); JSON columns are strings; ids are strings unless the table comes
from the fixture mapping, whose natural keys are longs.
"""

from __future__ import annotations

RAW_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
                " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
            " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
              " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

_STAMPS = "created_at timestamp, updated_at timestamp"

ENTITY_SCHEMAS: dict[str, str] = {
    "customers": "id string, shopify_customer_id string, klaviyo_profile_id string, email string,"
                 " phone string, first_name string, last_name string, location_country string,"
                 " location_region string, location_city string, timezone string,"
                 f" {_STAMPS}, is_first_time_customer boolean, total_orders int,"
                 " total_revenue decimal(12,2), average_order_value decimal(12,2),"
                 " first_order_date date, last_order_date date, tags array<string>,"
                 " marketing_consent_email boolean, marketing_consent_sms boolean, source string",
    "customer_addresses": "id string, customer_id string, shopify_address_id string, type string,"
                          " is_default boolean, address_line1 string, address_line2 string,"
                          f" city string, province string, postal_code string, country string, {_STAMPS}",
    "shopify_orders": "id string, shopify_order_id string, customer_id string, order_number string,"
                      " order_date timestamp, source string, financial_status string,"
                      " fulfillment_status string, subtotal_price decimal(12,2),"
                      " total_tax decimal(12,2), total_discounts decimal(12,2),"
                      " total_price decimal(12,2), currency_code string, payment_gateway string,"
                      " payment_method string, discount_codes array<string>, tags array<string>,"
                      f" refund_status string, cancelled_at timestamp, {_STAMPS}",
    "shopify_products": "id string, shopify_product_id string, title string, handle string,"
                        " product_type string, vendor string, collection_ids array<string>,"
                        f" tags array<string>, published_at timestamp, status string, {_STAMPS}",
    "shopify_product_variants": "id string, product_id string, shopify_variant_id string,"
                                " sku string, title string, price decimal(12,2),"
                                " cost decimal(12,2), compare_at_price decimal(12,2),"
                                " inventory_quantity int, inventory_policy string, option1 string,"
                                f" option2 string, option3 string, {_STAMPS}",
    "shopify_order_line_items": "id string, order_id string, shopify_line_item_id string,"
                                " product_id string, variant_id string, sku string, title string,"
                                " quantity int, price decimal(12,2), total_discount decimal(12,2),"
                                " total_tax decimal(12,2), line_total decimal(12,2),"
                                " fulfillment_status string, created_at timestamp",
    "klaviyo_profiles": "id string, klaviyo_profile_id string, customer_id string, email string,"
                        " phone string, first_name string, last_name string,"
                        f" location_properties string, properties string, {_STAMPS}",
    "klaviyo_campaigns": "id string, klaviyo_campaign_id string, name string, type string,"
                         " send_date timestamp, status string, recipients_count int,"
                         " delivered_count int, opens_count int, unique_opens_count int,"
                         " clicks_count int, unique_clicks_count int, unsubscribes_count int,"
                         f" bounces_count int, spam_reports_count int, revenue decimal(12,2), {_STAMPS}",
    "klaviyo_flows": "id string, klaviyo_flow_id string, name string, trigger_type string,"
                     " status string, recipients_entered_count int, conversion_count int,"
                     f" revenue decimal(12,2), {_STAMPS}",
    "klaviyo_flow_steps": "id string, flow_id string, klaviyo_step_id string, step_name string,"
                          " step_order int, step_type string, recipients_count int, opens_count int,"
                          f" clicks_count int, conversions_count int, {_STAMPS}",
    "klaviyo_lists": f"id string, klaviyo_list_id string, name string, profile_count int, {_STAMPS}",
    "klaviyo_segments": "id string, klaviyo_segment_id string, name string, rule_logic string,"
                        f" profile_count int, {_STAMPS}",
    "klaviyo_profile_lists": "profile_id string, list_id string, added_at timestamp",
    "klaviyo_predictive_metrics": "id string, profile_id string, predicted_next_order_date date,"
                                  " predicted_churn_probability decimal(5,4),"
                                  " predicted_lifetime_value decimal(12,2), predicted_gender string,"
                                  " email_engagement_probability decimal(5,4),"
                                  f" calculated_at timestamp, {_STAMPS}",
    "shopify_events": "id string, event_type string, customer_id string, order_id string,"
                      " product_id string, session_id string, event_properties string,"
                      " occurred_at timestamp, created_at timestamp",
    "klaviyo_events": "id string, klaviyo_event_id string, event_type string, profile_id string,"
                      " customer_id string, campaign_id string, flow_id string,"
                      " event_properties string, occurred_at timestamp, created_at timestamp",
    "ad_events": "id string, platform string, campaign_id string, ad_set_id string, ad_id string,"
                 " event_type string, customer_id string, order_id string, spend decimal(12,2),"
                 " impressions int, clicks int, conversions int, revenue decimal(12,2), date date,"
                 f" {_STAMPS}",
    "referrals": "id string, referrer_customer_id string, referred_customer_id string,"
                 " referral_code string, referral_status string, referred_email string,"
                 f" conversion_date date, reward_granted boolean, {_STAMPS}",
    "reviews": "id string, customer_id string, order_id string, product_id string, rating int,"
               " review_text string, is_verified_purchase boolean, helpful_count int,"
               f" status string, {_STAMPS}",
    "ugc_submissions": "id string, customer_id string, submission_type string, content_url string,"
                       f" platform string, campaign_id string, status string, {_STAMPS}",
    "loyalty_enrollments": "id string, customer_id string, loyalty_tier string, points_balance int,"
                           " total_points_earned int, enrollment_date date, last_activity_date date,"
                           f" {_STAMPS}",
    "nps_surveys": "id string, customer_id string, order_id string, nps_score int,"
                   " feedback_text string, survey_type string, survey_date date,"
                   " created_at timestamp",
    "emails": "id string, gmail_message_id string, gmail_thread_id string, from_address string,"
              " to_address string, subject string, snippet string, body_text string,"
              " received_at timestamp, reply_sent_at timestamp, status string",
    "email_embeddings": "email_id string, embedding array<float>",
    "email_replies": "id string, email_id string, model string, reply_text string,"
                     " tokens_prompt int, tokens_completion int, created_at timestamp",
}

# The mailbox as delivered: the message jobs read it as a table or as a stream of files.
MAILBOX_SCHEMAS = {"messages": "id string, received_at timestamp, message string"}
