"""All registered queries in one place."""

from __future__ import annotations

from trailmark.queries import causal, cohort, engagement, experiment, funnel, profile, revenue
from trailmark.queries.base import Query

AREAS = (funnel, cohort, revenue, engagement, profile, experiment, causal)


def all_queries() -> dict[str, Query]:
    return {name: q for area in AREAS for name, q in area.registry.queries.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.registry.oracles.items()}
