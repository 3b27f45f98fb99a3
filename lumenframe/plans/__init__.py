"""Bindings of the operators to the driver tables, each with its check SQL where SQL can state it."""
from __future__ import annotations

from importlib import import_module

MODULES = ("relational", "text", "textvec", "vectors", "statistics", "graphs", "models", "files", "laws")


def registry() -> dict:
    """All registered queries: name -> Query."""
    out = {}
    for module in MODULES:
        out.update(import_module(f"lumenframe.plans.{module}").BOOK.entries)
    return out
