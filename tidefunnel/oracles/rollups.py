"""Check queries for the written rollups and their calendars."""

from tidefunnel.oracles import advocacy, consideration, retention
from tidefunnel.oracles.acquisition import ACQ_DAILY, TRAFFIC_DAILY
from tidefunnel.oracles.consideration import DAILY
from tidefunnel.oracles.retention import CALENDAR, COHORTS

SESSION_DATES = """
        SELECT CAST(unnest(generate_series(:as_of - 29, :as_of, INTERVAL '1' DAY)) AS DATE) AS date
        UNION
        (SELECT DISTINCT CAST(occurred_at AS DATE) AS d FROM shopify_events
         WHERE session_id IS NOT NULL ORDER BY d DESC LIMIT 100)"""
LAST_WEEK = "date BETWEEN :as_of - 7 AND :as_of - 1"

SQL = {
    "replace_day": f"WITH {ACQ_DAILY} SELECT * FROM acq_daily",
    "refresh_advocacy_days": f"WITH {advocacy.DAILY} SELECT * FROM advocacy WHERE date >= :as_of - 2",
    "replace_all_cohorts": f"WITH {COHORTS} SELECT * FROM cohorts",
    "backfill_range": f"WITH {DAILY} SELECT * FROM consideration",
    "backfill_acquisition": f"WITH {ACQ_DAILY} SELECT * FROM acq_daily WHERE date IS NOT NULL",
    "backfill_traffic": f"""
        WITH {TRAFFIC_DAILY} SELECT * FROM traffic_daily
        WHERE date >= (SELECT min(date) FROM ad_events) AND date <= (SELECT max(date) FROM ad_events)""",
    "backfill_retention": f"WITH {retention.DAILY} SELECT * FROM retention",
    "backfill_advocacy": f"WITH {advocacy.DAILY} SELECT * FROM advocacy",
    "backfill_sessions": f"""
        SELECT * FROM ({consideration.SQL['session_engagement_daily']})
        WHERE date IN (SELECT date FROM ({SESSION_DATES}))""",
    "backfill_last_7_days": f"WITH {TRAFFIC_DAILY} SELECT * FROM traffic_daily WHERE {LAST_WEEK}",
    "backfill_last_7_days_ads": f"WITH {ACQ_DAILY} SELECT * FROM acq_daily WHERE {LAST_WEEK}",
    "backfill_sampled_dates": f"WITH {CALENDAR} SELECT date FROM cal",
    "backfill_session_dates": SESSION_DATES,
}
