"""Every registered query with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

from orderloom.catalogue.registry import REGISTRY, Query

MODULES = ("medallion", "batch", "scalars", "quality", "streams", "tables")


def registered() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"orderloom.catalogue.{name}")
    return dict(REGISTRY)
