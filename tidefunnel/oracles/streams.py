"""Check queries for the streams: the batch result."""

from tidefunnel.oracles.mail import NORMAL

SQL = {
    "stream_ingest_messages": f"WITH {NORMAL} SELECT * EXCLUDE (address) FROM normal",
    "stream_daily_event_counts": """
        SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS events
        FROM events GROUP BY 1, 2""",
}
