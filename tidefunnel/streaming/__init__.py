"""Structured Streaming jobs.  Importing a module registers its queries."""

from __future__ import annotations

import importlib

JOBS = ("ingest", "daily_counts")


def load() -> None:
    for job in JOBS:
        importlib.import_module(f"tidefunnel.streaming.{job}")
