"""Check queries for the laid-out tables, from the plain ones."""

from tidefunnel.oracles import commerce, consideration
from tidefunnel.sources.layout import LAYOUTS


def _table(name: str) -> str:
    how = LAYOUTS[name]
    days = f"count(DISTINCT CAST({how.moment} AS DATE))" if how.moment else "CAST(0 AS BIGINT)"
    return f"""
        SELECT '{name}' AS table_name, count(*) AS row_count, {days} AS days, count(DISTINCT {how.key}) AS keys
        FROM {name}"""


def _rates(days: int) -> str:
    rows = f"({consideration.session_rates(days)})"
    return " UNION ALL ".join(
        f"SELECT {days} AS days, '{metric}' AS metric, {metric}_rate AS rate FROM {rows}"
        for metric in ("add_to_cart", "cart_abandonment")
    )


SQL = {
    "laid_out_tables": " UNION ALL ".join(_table(name) for name in LAYOUTS),
    "customer_lifetime_laid_out": commerce.SQL["customer_lifetime_metrics"],
    "cart_rates_laid_out": " UNION ALL ".join(_rates(days) for days in (7, 30)),
}
