"""All registered queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from . import choices, landed, planning, relational, services, snapshots, timeseries, vendors

MODULES = (snapshots, relational, timeseries, planning, landed, vendors, choices, services)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in getattr(m, "ORACLE_SQL", {}).items()}
