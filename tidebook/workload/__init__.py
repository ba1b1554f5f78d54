"""The registered queries and the SQL each one is compared with."""

from __future__ import annotations

from importlib import import_module

#: Modules whose import registers their queries.
MODULES = ("positions", "maintenance", "eventlog", "documents")


def load():
    """The registry with every query module imported."""
    for module in MODULES:
        import_module(f"{__name__}.{module}")
    return import_module(f"{__name__}.registry")
