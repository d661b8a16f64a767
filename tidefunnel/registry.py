"""The list of named queries: key -> function of a Warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidefunnel.sources.warehouse import Warehouse

Plan = Callable[[Warehouse], DataFrame]
PLANS: dict[str, Plan] = {}


def register(key: str, plan: Plan) -> None:
    if key in PLANS:
        raise ValueError(f"query {key!r} is registered twice")
    PLANS[key] = plan


def load_all() -> dict[str, Plan]:
    """Import every plan module (each registers its keys) and return the list."""
    from tidefunnel import plans, streaming

    plans.load()
    streaming.load()
    return PLANS
