"""Metric plans by area.  Importing a module registers its queries."""

from __future__ import annotations

import importlib

AREAS = (
    "commerce",
    "acquisition",
    "consideration",
    "retention",
    "advocacy",
    "attribution",
    "catalogue",
    "journey",
    "quality",
    "ingest",
    "rollups",
    "mail",
    "laid_out",
)


def load() -> None:
    for area in AREAS:
        importlib.import_module(f"tidefunnel.plans.{area}")
