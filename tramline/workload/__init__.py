"""The operators run over the driver's tables, each with an equivalent SQL text.

The driver's tables are not transit data; ``standins`` says which of their
columns plays which part. Every query reads whole tables.
"""

from __future__ import annotations

import importlib

from tramline.workload.registry import REGISTRY

MODULES = ("scalars", "scans", "joins", "aggregations", "windows", "changes", "validation", "jobs", "exports")


def load() -> dict:
    for name in MODULES:
        importlib.import_module(f"tramline.workload.{name}")
    return REGISTRY
