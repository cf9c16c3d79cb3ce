"""Named queries over the input tables, grouped by topic."""

from __future__ import annotations

import importlib

TOPICS = ["scalar", "metrics", "history", "decisions", "models", "neighbours", "logsync", "storage"]


def load_all() -> None:
    for topic in TOPICS:
        importlib.import_module(f"riskloom.plans.{topic}")
