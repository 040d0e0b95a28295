"""All registered queries."""

from __future__ import annotations

from . import base_queries, model_queries, report_queries, stream_queries
from .data import prepare
from .spec import Query

_PARTS = [base_queries, report_queries, model_queries, stream_queries]


def _all() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for part in _PARTS:
        for name, query in part.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found


def _runner(query: Query):
    def run(spark, sf_dir):
        prepare(spark)
        return query.frame(spark, sf_dir)
    return run


def queries():
    return {name: _runner(query) for name, query in _all().items()}


def oracle_sql():
    return {name: query.oracle() for name, query in _all().items() if query.sql is not None}
