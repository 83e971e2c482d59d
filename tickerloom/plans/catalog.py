"""All registered queries, by area."""

from __future__ import annotations

import importlib

from tickerloom.plans import registry

AREAS = ("market", "corpus", "labels", "web", "runs", "reports")


def _load() -> None:
    for area in AREAS:
        importlib.import_module(f"tickerloom.plans.{area}")


def queries():
    _load()
    return dict(registry.QUERIES)


def checks():
    _load()
    return dict(registry.CHECKS)
