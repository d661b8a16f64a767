"""Check queries for the consideration metrics (literal join shapes)."""

from tidefunnel.oracles.sqltext import div, div0, rnd

LAST_30 = "CAST(occurred_at AS DATE) BETWEEN :as_of - 30 AND :as_of"
SPAN = "CAST(date_diff('microsecond', min(occurred_at), max(occurred_at)) AS DOUBLE) / 1e6"
DEPTH = "CAST(event_properties->>'scroll_depth' AS DECIMAL(12,4))"


def sessions(kind: str) -> str:
    return f"count(DISTINCT session_id) FILTER (WHERE event_type IN ({kind}))"


def events(kind: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{kind}')"


def web(select: str) -> str:
    return f"SELECT {select} FROM shopify_events WHERE {LAST_30}"


def mail(select: str) -> str:
    return f"SELECT {select} FROM klaviyo_events WHERE {LAST_30}"


SENT, OPENED, CLICKED = events("Sent Email"), events("Opened Email"), events("Clicked Email")

REPEATED = """EXISTS (
    SELECT 1 FROM shopify_events b
    WHERE b.customer_id = a.customer_id AND b.session_id <> a.session_id
      AND CAST(b.occurred_at AS DATE) BETWEEN {day} AND {day} + 7)"""

DAILY = f"""
    web AS (SELECT *, CAST(occurred_at AS DATE) AS d FROM shopify_events),
    all_days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL '1' DAY)) AS DATE) AS d
                 FROM web),
    day_web AS (
      SELECT d, {events('product_viewed')} AS pv, {events('add_to_cart')} AS ac,
             {events('add_to_wishlist')} AS wl, {events('checkout_started')} AS cs,
             {events('checkout_completed')} AS cc, count(DISTINCT session_id) AS ses,
             {events('page_viewed')} AS pg, {sessions("'add_to_cart'")} AS ac_s,
             {sessions("'product_viewed'")} AS pv_s, {sessions("'add_to_wishlist'")} AS wl_s,
             {sessions("'product_viewed', 'add_to_cart'")} AS eng,
             count(DISTINCT session_id) FILTER (WHERE customer_id IS NOT NULL) AS known
      FROM web GROUP BY d),
    day_mail AS (
      SELECT CAST(occurred_at AS DATE) AS d, {SENT} AS sent, {OPENED} AS opened,
             {CLICKED} AS clicked FROM klaviyo_events GROUP BY 1),
    view_ses AS (
      SELECT d, session_id, count(*) AS n, CAST({rnd(SPAN, 0)} AS INTEGER) AS secs FROM web
      WHERE event_type = 'product_viewed' AND session_id IS NOT NULL GROUP BY d, session_id),
    bounce AS (
      SELECT d, {div('count(*) FILTER (WHERE n = 1 OR secs < 30)', 'count(*)', 4)} AS r
      FROM view_ses GROUP BY d),
    pages AS (
      SELECT d, {rnd('avg(n)', 2)} AS r FROM (
        SELECT d, session_id, count(*) AS n FROM web
        WHERE event_type = 'page_viewed' AND session_id IS NOT NULL GROUP BY d, session_id)
      GROUP BY d),
    dwell AS (
      SELECT d, avg(secs) AS secs FROM (
        SELECT d, session_id, {SPAN} AS secs FROM web WHERE session_id IS NOT NULL
        GROUP BY d, session_id) GROUP BY d),
    scroll AS (
      SELECT d, {div(f'sum({DEPTH})', f'count({DEPTH})', 2)} AS r FROM web
      WHERE event_type = 'page_viewed' GROUP BY d),
    rep AS (
      SELECT d, count(DISTINCT a.session_id) AS n FROM web a
      WHERE a.customer_id IS NOT NULL AND {REPEATED.format(day='a.d')} GROUP BY d),
    joined AS (
      SELECT a.d, {', '.join(f'coalesce(w.{c}, 0) AS {c}' for c in (
                 'pv', 'ac', 'wl', 'cs', 'cc', 'ses', 'pg', 'ac_s', 'pv_s', 'wl_s', 'eng',
                 'known'))},
             m.sent, m.opened, m.clicked, b.r AS bounce, p.r AS pages, dw.secs,
             s.r AS scroll, r.n AS rep
      FROM all_days a LEFT JOIN day_web w USING (d) LEFT JOIN day_mail m USING (d) LEFT JOIN bounce b USING (d)
      LEFT JOIN pages p USING (d) LEFT JOIN dwell dw USING (d) LEFT JOIN scroll s USING (d)
      LEFT JOIN rep r USING (d)),
    consideration AS (
      SELECT d AS date, pv AS total_product_views, ac AS total_add_to_cart,
             wl AS total_wishlist_adds, cs AS total_checkout_starts,
             cc AS total_checkout_completions, {div('ac_s', 'pv_s', 4)} AS add_to_cart_rate,
             {div('ac', 'pv', 4)} AS view_to_add_to_cart_ratio,
             {div('wl_s', 'ses', 4)} AS wishlist_add_rate,
             {div('ac - cs', 'ac', 4)} AS cart_abandonment_rate,
             bounce AS product_page_bounce_rate, ses AS total_sessions, pg AS total_page_views,
             pages AS avg_pages_per_session,
             CAST({rnd('secs', 0)} AS INTEGER) AS avg_session_duration_seconds,
             scroll AS avg_scroll_depth_percent,
             coalesce(rep, 0) AS sessions_with_repeat_visits_7d,
             CASE WHEN rep > 0 THEN {div('rep', 'known', 4)} END AS repeat_visit_rate_7d,
             coalesce(sent, 0) AS total_emails_sent, coalesce(opened, 0) AS total_emails_opened,
             coalesce(clicked, 0) AS total_emails_clicked,
             {div('opened', 'sent', 4)} AS email_open_rate,
             {div('clicked', 'opened', 4)} AS email_ctr,
             {rnd('''(eng * 0.3::DOUBLE + coalesce(secs, 0) * 0.2::DOUBLE + ac * 0.2::DOUBLE)
                     * 0.7::DOUBLE
                     + (opened / nullif(sent, 0)::DOUBLE * 0.2::DOUBLE
                        + clicked / nullif(opened, 0)::DOUBLE * 0.1::DOUBLE) * 0.3::DOUBLE''', 4)}
               AS engagement_score
      FROM joined)"""


def pct(c: str, name: str = "") -> str:
    return f"{rnd(f'{c} * 100', 2)} AS {name or c + '_pct'}"


TRENDS = f"""
    trends AS (
      SELECT date, total_product_views, total_add_to_cart, {pct('add_to_cart_rate')},
             {pct('view_to_add_to_cart_ratio')}, avg_pages_per_session,
             avg_session_duration_seconds, {pct('cart_abandonment_rate')},
             {pct('product_page_bounce_rate')}, {pct('email_open_rate')}, {pct('email_ctr')},
             engagement_score
      FROM consideration)"""

SUMMED = [
    "total_product_views", "total_add_to_cart", "total_wishlist_adds", "total_checkout_starts",
    "total_checkout_completions", "total_sessions", "total_page_views", "total_emails_sent",
    "total_emails_opened", "total_emails_clicked",
]
AVERAGED = [
    "add_to_cart_rate", "view_to_add_to_cart_ratio", "wishlist_add_rate", "cart_abandonment_rate",
    "product_page_bounce_rate", "repeat_visit_rate_7d", "email_open_rate", "email_ctr",
    "engagement_score",
]
ALREADY_MEAN = ["avg_pages_per_session", "avg_session_duration_seconds", "avg_scroll_depth_percent"]



def session_rates(days: int) -> str:
    """Session rates of the last days, from the events themselves."""
    rows = f"(SELECT * FROM shopify_events WHERE CAST(occurred_at AS DATE) BETWEEN :as_of - {days - 1} AND :as_of)"
    looks = sessions("'product_viewed', 'page_viewed'")
    carts, outs = sessions("'add_to_cart'"), sessions("'checkout_started'")
    either = sessions("'add_to_cart', 'checkout_started'")
    return f"""
        SELECT CAST(:as_of - {days - 1} AS DATE) AS from_date, CAST(:as_of AS DATE) AS to_date, {looks} AS sessions,
               {div0(carts, sessions("'product_viewed'"), 4)} AS add_to_cart_rate,
               {div0(f"({either} - {outs})", carts, 4)} AS cart_abandonment_rate,
               {div0(sessions("'add_to_wishlist'"), looks, 4)} AS wishlist_add_rate
        FROM {rows}"""


SQL = {
    "session_rates_from_maps": " UNION ALL ".join(session_rates(n) for n in (7, 30, 90)),
    "add_to_cart_rate": web(
        f"{div0(sessions(chr(39) + 'add_to_cart' + chr(39)), sessions(chr(39) + 'product_viewed' + chr(39)), 4)}"
        " AS add_to_cart_rate"),
    "view_to_add_to_cart_ratio": web(
        f"{div0(events('add_to_cart'), events('product_viewed'), 4)} AS view_to_add_to_cart_ratio"),
    "product_view_depth": f"""
        SELECT coalesce({rnd('avg(n)', 2)}, 0) AS product_view_depth FROM (
          SELECT session_id, count(*) AS n FROM shopify_events
          WHERE event_type = 'page_viewed' AND session_id IS NOT NULL AND {LAST_30}
          GROUP BY session_id)""",
    "avg_session_duration": f"""
        SELECT CAST(coalesce({rnd('avg(s)', 0)}, 0) AS INTEGER) AS avg_session_duration FROM (
          SELECT session_id, {SPAN} AS s FROM shopify_events
          WHERE session_id IS NOT NULL AND {LAST_30} GROUP BY session_id)""",
    "avg_scroll_depth": f"""
        SELECT {div0(f'sum({DEPTH})', f'count({DEPTH})', 2)} AS avg_scroll_depth
        FROM shopify_events WHERE event_type = 'page_viewed' AND {LAST_30}""",
    "wishlist_add_rate": web(
        div0("count(DISTINCT session_id) FILTER (WHERE event_type = 'add_to_wishlist')",
             sessions("'product_viewed', 'page_viewed'"), 4) + " AS wishlist_add_rate"),
    "cart_abandonment_rate": f"""
        WITH t AS (
          SELECT count(DISTINCT a.session_id) AS carts, count(DISTINCT b.session_id) AS outs
          FROM (SELECT * FROM shopify_events WHERE event_type = 'add_to_cart' AND {LAST_30}) a
          LEFT JOIN (SELECT * FROM shopify_events
                     WHERE event_type = 'checkout_started' AND {LAST_30}) b
            ON b.session_id = a.session_id)
        SELECT {div0('carts - outs', 'carts', 4)} AS cart_abandonment_rate FROM t""",
    "product_page_bounce_rate": f"""
        SELECT {div0('count(*) FILTER (WHERE n = 1 OR s < 30)', 'count(*)', 4)}
                 AS product_page_bounce_rate FROM (
          SELECT session_id, count(*) AS n, {SPAN} AS s FROM shopify_events
          WHERE event_type = 'product_viewed' AND session_id IS NOT NULL AND {LAST_30}
          GROUP BY session_id)""",
    "email_open_rate": mail(f"{div0(OPENED, SENT, 4)} AS email_open_rate"),
    "email_ctr": mail(f"{div0(CLICKED, OPENED, 4)} AS email_ctr"),
    "repeat_visit_rate_7d": f"""
        WITH firsts AS (
          SELECT session_id, customer_id, CAST(min(occurred_at) AS DATE) AS d
          FROM shopify_events
          WHERE customer_id IS NOT NULL AND session_id IS NOT NULL AND {LAST_30}
          GROUP BY session_id, customer_id),
        again AS (SELECT DISTINCT a.session_id FROM firsts a WHERE {REPEATED.format(day='a.d')})
        SELECT {div0('(SELECT count(*) FROM again)', '(SELECT count(*) FROM firsts)', 4)}
                 AS repeat_visit_rate_7d""",
    "engagement_score": f"""
        WITH site AS (
          SELECT count(DISTINCT session_id) FILTER (
                   WHERE event_type IN ('product_viewed', 'add_to_cart')) AS eng, avg(s) AS secs
          FROM (SELECT session_id, event_type, {SPAN} AS s FROM shopify_events
                WHERE session_id IS NOT NULL AND {LAST_30} GROUP BY session_id, event_type)),
        m AS ({mail(f'{SENT} AS sent, {OPENED} AS opened, {CLICKED} AS clicked')}),
        c AS ({web(f"{events('add_to_cart')} AS carts")})
        SELECT {rnd('''(eng * 0.3::DOUBLE + coalesce(secs, 0) * 0.2::DOUBLE
                        + carts * 0.2::DOUBLE) * 0.7::DOUBLE
                       + (coalesce(opened / nullif(sent, 0)::DOUBLE, 0) * 0.2::DOUBLE
                          + coalesce(clicked / nullif(opened, 0)::DOUBLE, 0) * 0.1::DOUBLE)
                         * 0.3::DOUBLE''', 4)} AS engagement_score
        FROM site, m, c""",
    "consideration_metrics_daily": f"WITH {DAILY} SELECT * FROM consideration",
    "session_engagement_daily": f"""
        WITH a AS (
          SELECT CAST(occurred_at AS DATE) AS date, session_id, customer_id,
                 {events('page_viewed')} AS pg, {events('product_viewed')} AS pv,
                 {events('add_to_cart')} AS ac, {events('add_to_wishlist')} AS wl,
                 {events('checkout_started')} AS cs, {events('checkout_completed')} AS cc,
                 {SPAN} AS secs, {div(f'sum({DEPTH})', f'count({DEPTH})', 2)} AS depth
          FROM shopify_events WHERE session_id IS NOT NULL GROUP BY 1, 2, 3)
        SELECT date, session_id, customer_id, pg AS page_views_count, pv AS product_views_count,
               ac AS add_to_cart_count, wl AS wishlist_add_count, cs > 0 AS checkout_started,
               cc > 0 AS checkout_completed,
               CAST({rnd('secs', 0)} AS INTEGER) AS session_duration_seconds,
               depth AS avg_scroll_depth_percent, pg = 1 OR secs < 30 AS bounce,
               pv > 0 AND pg = 1 AND secs < 30 AS is_product_page_bounce,
               customer_id IS NOT NULL AND {REPEATED.format(day='a.date')} AS has_repeat_visit_7d
        FROM a""",
    "consideration_metrics_summary": f"""
        WITH {DAILY} SELECT
        {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in SUMMED)},
        {', '.join(f'{rnd(f"avg({c})", 6)} AS avg_{c}' for c in AVERAGED)},
        {', '.join(f'{rnd(f"avg({c})", 6)} AS {c}' for c in ALREADY_MEAN)}
        FROM consideration""",
    "consideration_metrics_trends": f"WITH {DAILY}, {TRENDS} SELECT * FROM trends",
    "consideration_last_7_days": f"""
        WITH {DAILY}, {TRENDS} SELECT * FROM trends WHERE date >= :as_of - 7
        ORDER BY date DESC LIMIT 7""",
    "cart_abandonment_last_7_days": f"""
        WITH {DAILY}, {TRENDS} SELECT date, cart_abandonment_rate_pct AS abandonment_pct
        FROM trends WHERE date >= :as_of - 7""",
    "engagement_score_trend": f"""
        WITH {DAILY} SELECT date, engagement_score FROM consideration
        WHERE date >= :as_of - 30""",
    "mail_rates_trend": f"""
        WITH {DAILY} SELECT date, {pct('email_open_rate', 'open_rate_pct')},
               {pct('email_ctr', 'ctr_pct')}
        FROM consideration WHERE date >= :as_of - 30""",
}
