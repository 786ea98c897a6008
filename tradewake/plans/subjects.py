"""Imports every subject so that its queries are registered."""

from __future__ import annotations

from importlib import import_module

SUBJECTS = ["logs", "trade", "shop", "items", "products", "diagnosis", "journeys", "storage", "streams", "scalars"]


def load_all() -> None:
    for name in SUBJECTS:
        import_module(f"tradewake.plans.{name}")
