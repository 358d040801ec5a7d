"""All registered queries."""

from __future__ import annotations

from tripflow.plans import files, learning, medallion, projections, relations, streams  # noqa: F401
from tripflow.plans.base import ORACLES, QUERIES, QueryFn


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
