"""DuckDB check queries by key."""

from __future__ import annotations

import importlib

from tidefunnel.oracles.sqltext import check_query

AREAS = ("commerce", "acquisition", "consideration", "retention", "advocacy", "attribution", "catalogue", "journey", "quality", "ingest", "rollups", "mail", "laid_out", "streams")


def all_checks() -> dict[str, str]:
    checks: dict[str, str] = {}
    for area in AREAS:
        module = importlib.import_module(f"tidefunnel.oracles.{area}")
        for key, body in module.SQL.items():
            if key in checks:
                raise ValueError(f"check {key!r} is defined twice")
            checks[key] = check_query(body)
    return checks
