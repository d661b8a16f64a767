"""Check queries for the retention metrics (literal join shapes)."""

from tidefunnel.oracles.sqltext import avg, div, div0, money, rnd

FUNNEL = "event_type IN ('Sent Email', 'Opened Email', 'Clicked Email')"
OPENED = "count(*) FILTER (WHERE event_type = 'Opened Email')"
SENT = "count(*) FILTER (WHERE event_type = 'Sent Email')"
TRAILING = "occurred_at >= {t} - 30 AND occurred_at <= {t}"
BOUGHT = "count(*) FILTER (WHERE total_orders > 0)"

PAIRS = """
    paid AS (SELECT * FROM shopify_orders WHERE financial_status = 'paid'),
    pairs AS (
      SELECT a.customer_id, CAST(a.order_date AS DATE) AS d1,
             CAST(b.order_date AS DATE) - CAST(a.order_date AS DATE) AS gap
      FROM paid a JOIN paid b ON b.customer_id = a.customer_id AND b.order_date > a.order_date)"""

CALENDAR = """
    span AS (SELECT CAST(min(order_date) AS DATE) AS lo, :as_of - 30 AS lim FROM shopify_orders),
    months AS (
      SELECT lo, lim, CAST(unnest(generate_series(date_trunc('month', lo), lim,
                                                  INTERVAL '1' MONTH)) AS DATE) AS m
      FROM span WHERE lo < lim),
    cal AS (
      SELECT CAST(unnest(generate_series(:as_of - 30, :as_of, INTERVAL '1' DAY)) AS DATE) AS date
      UNION
      SELECT m + 14 FROM months WHERE m + 14 < lim OR m = date_trunc('month', lo))"""


def decay(where: str, group: str = "") -> str:
    """First and last week's engaged share, per group."""
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""
      SELECT {g}coalesce({rnd('(arg_max(r, w) - arg_min(r, w)) / greatest(date_diff($$day$$, min(w), max(w)), 1)', 4)}, 0) AS v
      FROM (SELECT {g}date_trunc('week', occurred_at) AS w,
                   coalesce(count(DISTINCT profile_id) FILTER (
                     WHERE event_type IN ('Opened Email', 'Clicked Email')) / nullif(
                       CAST(count(DISTINCT profile_id) AS DOUBLE), 0), 0) AS r
            FROM {where} GROUP BY {g}w) {by}"""


def scd(column: str, name: str, scale: int) -> str:
    """Mean of each profile's latest non-null value as of each calendar day."""
    return f"""
    {name} AS (
      SELECT date, {div(f'sum(v)', 'count(v)', scale)} AS v FROM (
        SELECT cal.date, profile_id, arg_max({column}, calculated_at) AS v
        FROM cal JOIN klaviyo_predictive_metrics
          ON CAST(calculated_at AS DATE) <= cal.date AND {column} IS NOT NULL
        GROUP BY cal.date, profile_id) GROUP BY date)"""


REPLENISH = f"""
    predicted AS (
      SELECT c.id, arg_max(m.predicted_next_order_date, m.calculated_at) AS due,
             max(CAST(m.calculated_at AS DATE)) AS made_on
      FROM customers c JOIN klaviyo_profiles p ON p.customer_id = c.id
      JOIN klaviyo_predictive_metrics m ON m.profile_id = p.id
      WHERE m.predicted_next_order_date IS NOT NULL AND c.total_orders > 0 GROUP BY c.id),
    actual AS (
      SELECT p.id, p.due, (SELECT min(CAST(o.order_date AS DATE)) FROM shopify_orders o
                           WHERE o.customer_id = p.id AND o.financial_status = 'paid'
                             AND CAST(o.order_date AS DATE) > p.made_on) AS came
      FROM predicted p),
    replenish AS (
      SELECT {div0('sum(abs(due - came))', 'count(came)', 2)} AS v FROM actual)"""

LTV_CAC = f"""
    costs AS (
      SELECT c.id, c.total_revenue,
             CAST(sum(a.spend) AS DOUBLE) / nullif(count(DISTINCT a.id), 0) AS cac
      FROM customers c LEFT JOIN ad_events a
        ON a.customer_id = c.id AND a.event_type IN ('conversion', 'purchase')
      WHERE c.total_orders > 0 GROUP BY c.id, c.total_revenue),
    ltv_cac AS (
      SELECT coalesce({rnd('avg(CAST(total_revenue AS DOUBLE) / cac)', 2)}, 0) AS v
      FROM costs WHERE cac > 0)"""

DAILY = f"""
    {CALENDAR}, {PAIRS}, {REPLENISH}, {LTV_CAC},
    people AS (
      SELECT cal.date, {BOUGHT} AS n,
             count(*) FILTER (WHERE last_order_date >= cal.date - 30 AND total_orders > 0) AS a30,
             count(*) FILTER (WHERE last_order_date >= cal.date - 60 AND total_orders > 0) AS a60,
             count(*) FILTER (WHERE last_order_date >= cal.date - 90 AND total_orders > 0) AS a90,
             count(*) FILTER (WHERE total_orders > 1) AS rep,
             {div0("sum(total_revenue) FILTER (WHERE total_orders > 0 AND first_order_date <= cal.date)",
                   "count(*) FILTER (WHERE total_orders > 0 AND first_order_date <= cal.date)", 2)} AS ltv,
             {rnd("quantile_cont(CAST(total_revenue AS DOUBLE), 0.5) FILTER (WHERE total_orders > 0)", 2)} AS ltv_med,
             {money("sum(total_revenue) FILTER (WHERE total_orders > 0)")} AS ltv_sum,
             {div0('''count(*) FILTER (WHERE total_orders > 1 AND first_order_date <= cal.date
                        AND last_order_date >= :as_of - 90)''',
                   "count(*) FILTER (WHERE total_orders > 1 AND first_order_date <= cal.date)", 4)} AS sub
      FROM cal, customers GROUP BY cal.date),
    shortest AS (
      SELECT date, coalesce({rnd('avg(g)', 2)}, 0) AS v FROM (
        SELECT cal.date, customer_id, min(gap) AS g FROM cal JOIN pairs ON d1 <= cal.date
        GROUP BY cal.date, customer_id) GROUP BY date),
    gap_since AS (SELECT gap, min(d1) AS since FROM pairs GROUP BY gap),
    med AS (
      SELECT date, {rnd('quantile_cont(CAST(gap AS DOUBLE), 0.5)', 2)} AS v
      FROM cal JOIN gap_since ON since <= date GROUP BY date),
    reorder AS (
      SELECT date, {rnd('''avg(CAST(CASE WHEN due >= date THEN 0.8 WHEN due < date THEN 0.3
                                     ELSE 0.5 END AS DOUBLE))''', 4)} AS v FROM (
        SELECT cal.date, profile_id,
               max(struct_pack(c := calculated_at, d := predicted_next_order_date)).d AS due
        FROM cal JOIN klaviyo_predictive_metrics ON CAST(calculated_at AS DATE) <= cal.date
        GROUP BY cal.date, profile_id) GROUP BY date),
    {scd('predicted_churn_probability', 'churn', 4)},
    {scd('predicted_lifetime_value', 'pltv', 2)},
    {scd('email_engagement_probability', 'engage', 4)},
    decay AS ({decay(f'''(SELECT cal.date, m.* FROM cal JOIN klaviyo_events m
                        ON {TRAILING.format(t='cal.date')} WHERE {FUNNEL})''', 'date')}),
    winback AS (
      SELECT cal.date, {div0(OPENED, SENT, 4)} AS v
      FROM cal JOIN klaviyo_events m ON {TRAILING.format(t='cal.date')}
      JOIN klaviyo_campaigns k ON k.id = m.campaign_id
      WHERE lower(k.name) LIKE '%winback%' OR lower(k.name) LIKE '%re-engage%'
         OR lower(k.name) LIKE '%reactivate%'
      GROUP BY cal.date),
    retention AS (
      SELECT p.date, n AS total_customers, a30 AS active_customers_30d,
             a60 AS active_customers_60d, a90 AS active_customers_90d, rep AS repeat_customers,
             {div('rep', 'n', 4)} AS repeat_purchase_rate,
             {div('a30', 'n', 4)} AS active_customer_rate_30d,
             {div('a60', 'n', 4)} AS active_customer_rate_60d,
             {div('a90', 'n', 4)} AS active_customer_rate_90d,
             {div('n - a30', 'n', 4)} AS churn_rate_30d, {div('n - a60', 'n', 4)} AS churn_rate_60d,
             {div('n - a90', 'n', 4)} AS churn_rate_90d,
             coalesce(s.v, 0) AS avg_days_between_purchases, med.v AS median_days_between_purchases,
             ltv AS avg_ltv, ltv_med AS median_ltv, ltv_sum AS total_ltv,
             reorder.v AS avg_reorder_probability, churn.v AS avg_churn_probability,
             pltv.v AS avg_predicted_ltv, engage.v AS avg_email_engagement_probability,
             coalesce(decay.v, 0) AS engagement_decay_rate,
             coalesce(winback.v, 0) AS winback_email_open_rate,
             sub AS subscription_retention_rate,
             (SELECT v FROM replenish) AS avg_replenishment_accuracy_days,
             (SELECT v FROM ltv_cac) AS avg_ltv_cac_ratio
      FROM people p LEFT JOIN shortest s USING (date) LEFT JOIN med USING (date)
      LEFT JOIN reorder USING (date) LEFT JOIN churn USING (date) LEFT JOIN pltv USING (date)
      LEFT JOIN engage USING (date) LEFT JOIN decay USING (date) LEFT JOIN winback USING (date))"""

PCT = [
    "repeat_purchase_rate", "active_customer_rate_30d", "active_customer_rate_60d",
    "active_customer_rate_90d", "churn_rate_30d", "churn_rate_60d", "churn_rate_90d",
    "avg_reorder_probability", "avg_churn_probability", "winback_email_open_rate",
    "subscription_retention_rate",
]
TRENDS = f"""
    trends AS (
      SELECT date, total_customers, {', '.join(f"{rnd(f'{c} * 100', 2)} AS {c}_pct" for c in PCT)},
             avg_days_between_purchases, avg_ltv, engagement_decay_rate,
             avg_replenishment_accuracy_days, avg_ltv_cac_ratio
      FROM retention)"""

MEANS = [
    "repeat_purchase_rate", "active_customer_rate_30d", "active_customer_rate_60d",
    "active_customer_rate_90d", "churn_rate_30d", "churn_rate_60d", "churn_rate_90d",
    "median_days_between_purchases", "median_ltv", "engagement_decay_rate",
    "winback_email_open_rate", "subscription_retention_rate",
]
PLAIN_MEANS = [
    "avg_days_between_purchases", "avg_ltv", "avg_reorder_probability", "avg_churn_probability",
    "avg_predicted_ltv", "avg_email_engagement_probability", "avg_replenishment_accuracy_days",
    "avg_ltv_cac_ratio",
]

COHORTS = f"""
    {PAIRS},
    spacing AS (
      SELECT customer_id, {rnd('avg(DISTINCT gap)', 2)} AS g FROM pairs GROUP BY customer_id),
    latest AS (
      SELECT p.customer_id, m.*, row_number() OVER (
               PARTITION BY p.customer_id ORDER BY m.calculated_at DESC, p.id DESC) AS rn
      FROM klaviyo_profiles p JOIN klaviyo_predictive_metrics m ON m.profile_id = p.id),
    cohorts AS (
      SELECT c.id AS customer_id, CAST(date_trunc('month', c.first_order_date) AS DATE) AS cohort_date,
             c.first_order_date, c.last_order_date, CAST(c.total_orders AS BIGINT) AS total_orders,
             {money('c.total_revenue')} AS total_revenue,
             CAST(:as_of - c.first_order_date AS INTEGER) AS days_since_first_order,
             CAST(:as_of - c.last_order_date AS INTEGER) AS days_since_last_order,
             s.g AS avg_days_between_orders,
             {', '.join(f'''c.last_order_date >= :as_of - {n} AND c.total_orders > 0
                            AS is_active_{n}d''' for n in (30, 60, 90))},
             {', '.join(f'''c.last_order_date IS NULL OR c.last_order_date < :as_of - {n}
                            AS is_churned_{n}d''' for n in (30, 60, 90))},
             c.total_orders > 1 AS is_repeat_customer, l.predicted_next_order_date,
             CAST(l.predicted_churn_probability AS DOUBLE) AS predicted_churn_probability,
             {money('l.predicted_lifetime_value')} AS predicted_ltv,
             CAST(l.email_engagement_probability AS DOUBLE) AS email_engagement_probability
      FROM customers c LEFT JOIN spacing s ON s.customer_id = c.id
      LEFT JOIN latest l ON l.customer_id = c.id AND l.rn = 1
      WHERE c.total_orders > 0)"""

COHORT_SUMMARY = f"""
    cohort_summary AS (
      SELECT cohort_date, count(*) AS cohort_size,
             count(*) FILTER (WHERE is_repeat_customer) AS repeat_customers,
             {', '.join(f'count(*) FILTER (WHERE is_active_{n}d) AS active_{n}d' for n in (30, 60, 90))},
             {', '.join(f'count(*) FILTER (WHERE is_churned_{n}d) AS churned_{n}d' for n in (30, 60, 90))},
             {rnd('avg(total_orders)', 6)} AS avg_orders_per_customer,
             {rnd('avg(total_revenue)', 6)} AS avg_revenue_per_customer,
             {rnd('avg(avg_days_between_orders)', 6)} AS avg_days_between_orders,
             {rnd('avg(predicted_churn_probability)', 6)} AS avg_churn_probability
      FROM cohorts GROUP BY cohort_date)"""


def churned(n: int) -> str:
    return (f"count(*) FILTER (WHERE total_orders > 0 AND (last_order_date IS NULL"
            f" OR last_order_date < :as_of - {n}))")


SQL = {
    "repeat_purchase_rate": f"""
        SELECT {div0('count(*) FILTER (WHERE total_orders > 1)', BOUGHT, 4)}
                 AS repeat_purchase_rate FROM customers""",
    "avg_days_between_purchases": f"""
        WITH {PAIRS} SELECT coalesce({rnd('avg(g)', 2)}, 0) AS avg_days_between_purchases
        FROM (SELECT customer_id, min(gap) AS g FROM pairs GROUP BY customer_id)""",
    "active_customer_rate": f"""
        SELECT {div0('count(*) FILTER (WHERE last_order_date >= :as_of - 30)', BOUGHT, 4)}
                 AS active_customer_rate FROM customers""",
    "churn_rate": f"SELECT {div0(churned(30), BOUGHT, 4)} AS churn_rate FROM customers",
    "churn_rates": f"""
        SELECT {', '.join(f'{div0(churned(n), BOUGHT, 4)} AS churn_{n}d' for n in (30, 60, 90))}
        FROM customers""",
    "avg_ltv": f"""
        SELECT coalesce({rnd(avg('total_revenue'), 2)}, 0) AS avg_ltv
        FROM customers WHERE total_orders > 0""",
    "avg_reorder_probability": f"""
        WITH latest AS (
          SELECT profile_id, predicted_next_order_date AS due, row_number() OVER (
                   PARTITION BY profile_id ORDER BY calculated_at DESC) AS rn
          FROM klaviyo_predictive_metrics)
        SELECT coalesce({rnd('''avg(CAST(CASE WHEN due >= :as_of THEN 0.8 WHEN due < :as_of THEN 0.3
                                     ELSE 0.5 END AS DOUBLE))''', 4)}, 0)
                 AS avg_reorder_probability FROM latest WHERE rn = 1""",
    "subscription_retention_rate": f"""
        SELECT {div0('count(*) FILTER (WHERE last_order_date >= :as_of - 90)', 'count(*)', 4)}
                 AS subscription_retention_rate FROM customers WHERE total_orders > 1""",
    "engagement_decay_rate": f"""
        SELECT v AS engagement_decay_rate FROM ({decay(
            f"klaviyo_events WHERE {FUNNEL} AND {TRAILING.format(t=':as_of')}")})""",
    "winback_email_open_rate": f"""
        SELECT {div0(OPENED, SENT, 4)} AS winback_email_open_rate
        FROM klaviyo_events m JOIN klaviyo_campaigns k ON k.id = m.campaign_id
        WHERE (lower(k.name) LIKE '%winback%' OR lower(k.name) LIKE '%re-engage%'
               OR lower(k.name) LIKE '%reactivate%') AND {TRAILING.format(t=':as_of')}""",
    "replenishment_accuracy": f"""
        WITH {REPLENISH} SELECT v AS replenishment_accuracy FROM replenish""",
    "avg_ltv_cac_ratio": f"WITH {LTV_CAC} SELECT v AS avg_ltv_cac_ratio FROM ltv_cac",
    "retention_metrics_daily": f"WITH {DAILY} SELECT * FROM retention",
    "retention_metrics_trends": f"WITH {DAILY}, {TRENDS} SELECT * FROM trends",
    "retention_last_7_days": f"""
        WITH {DAILY}, {TRENDS} SELECT * FROM trends WHERE date >= :as_of - 7
        ORDER BY date DESC LIMIT 7""",
    "retention_metrics_summary": f"""
        WITH {DAILY} SELECT CAST(sum(total_customers) AS BIGINT) AS total_customers_all_time,
               {rnd('sum(total_ltv)', 2)} AS total_ltv_all_time,
               {', '.join(f'{rnd(f"avg({c})", 6)} AS avg_{c}' for c in MEANS)},
               {', '.join(f'{rnd(f"avg({c})", 6)} AS {c}' for c in PLAIN_MEANS)}
        FROM retention""",
    "customer_retention_cohorts": f"WITH {COHORTS} SELECT * FROM cohorts",
    "customer_retention_cohorts_summary": f"""
        WITH {COHORTS}, {COHORT_SUMMARY} SELECT * FROM cohort_summary""",
    "recent_cohorts": f"""
        WITH {COHORTS}, {COHORT_SUMMARY}
        SELECT *, {div('active_30d', 'cohort_size', 1, '100')} AS active_30d_pct,
               {div('active_90d', 'cohort_size', 1, '100')} AS active_90d_pct
        FROM cohort_summary ORDER BY cohort_date DESC LIMIT 5""",
    "cohort_retention_pct": f"""
        WITH {COHORTS}, {COHORT_SUMMARY}
        SELECT cohort_date, cohort_size, active_30d, active_90d,
               {div('active_90d', 'cohort_size', 6, '100')} AS retention_90d_pct
        FROM cohort_summary""",
    "high_churn_risk": f"""
        WITH {COHORTS}
        SELECT c.email, h.total_orders, h.total_revenue, h.predicted_churn_probability,
               h.is_churned_30d
        FROM cohorts h JOIN customers c ON c.id = h.customer_id
        WHERE h.predicted_churn_probability > 0.5""",
    "churn_risk_top5": f"""
        SELECT p.email, CAST(m.predicted_churn_probability AS DOUBLE) AS predicted_churn_probability,
               {money('m.predicted_lifetime_value')} AS predicted_lifetime_value,
               m.predicted_next_order_date
        FROM klaviyo_predictive_metrics m JOIN klaviyo_profiles p ON p.id = m.profile_id
        WHERE m.predicted_churn_probability > 0.7
        ORDER BY m.predicted_churn_probability DESC, p.email, m.calculated_at LIMIT 5""",
    "replenishment_priority": f"""
        WITH {COHORTS}
        SELECT c.email, h.predicted_next_order_date, h.avg_days_between_orders,
               CASE WHEN h.predicted_next_order_date <= :as_of + 7 THEN 'IMMEDIATE'
                    WHEN h.predicted_next_order_date <= :as_of + 30 THEN 'SOON'
                    ELSE 'LATER' END AS replenishment_priority
        FROM cohorts h JOIN customers c ON c.id = h.customer_id
        WHERE h.predicted_next_order_date IS NOT NULL AND h.is_active_30d = false""",
}
