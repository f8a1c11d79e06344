"""Query registry: every module below registers its queries on import."""

from __future__ import annotations

import importlib

MODULES = (
    "scans",
    "pixels",
    "aggregates",
    "stencils",
    "components",
    "vectors",
    "objects",
    "sampling",
    "scoring",
    "search",
    "datasets",
)


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"acreage.plans.{name}")
