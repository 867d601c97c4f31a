"""Every query of the archive engine by name, and its SQL."""

from __future__ import annotations

from . import archives, bindings, checks, pictures, runs, streams  # noqa: F401  (all add their queries to those of bindings)


def queries():
    return dict(bindings.QUERIES)


def oracle_sql():
    return dict(bindings.ORACLE)
