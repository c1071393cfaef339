"""Every operator run over the given tables, each next to the SQL that must agree with it."""

from __future__ import annotations

from importlib import import_module

PARTS = ["cleaning", "profiling", "exploring", "splitting", "featuring", "gating", "modelling", "evaluating", "staging"]


def load_all() -> None:
    """Import every part, which registers its queries."""
    for part in PARTS:
        import_module(f"gritmill.workload.{part}")
