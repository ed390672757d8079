"""Registered queries: each operator over the warehouse tables, with its SQL definition."""

from __future__ import annotations

from worklens.queries import audits, cleaning, flow, landing, measures, quality, reports, schedule
from worklens.queries.registry import REGISTRY

__all__ = [
    "REGISTRY", "audits", "cleaning", "flow", "landing", "measures", "quality", "reports",
    "schedule",
]
