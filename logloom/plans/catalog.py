"""All registered queries."""

from __future__ import annotations

from logloom.plans import dataset_queries, doc_queries, log_queries, metric_queries, run_queries, text_queries  # noqa: F401
from logloom.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
