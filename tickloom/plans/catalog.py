"""All registered queries and their SQL."""

from __future__ import annotations

from tickloom.plans import file_queries, market_queries, metric_queries, model_queries, rule_queries, shape_queries, sql_queries, store_queries, stream_queries, upkeep_queries  # noqa: F401  (importing registers)
from tickloom.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
