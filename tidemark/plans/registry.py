"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from tidemark.plans import lake_queries, market_queries, model_queries, news_queries, record_queries, sequence_queries, serving_queries, stream_queries

MODULES = [market_queries, news_queries, model_queries, lake_queries, serving_queries, record_queries, sequence_queries, stream_queries]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.ORACLES.items()}
