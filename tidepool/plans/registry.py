"""All registered queries and their DuckDB oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import eval_plans, graph_plans, learn_plans, log_plans, run_plans, sample_plans

_MODULES = [graph_plans, eval_plans, run_plans, log_plans, sample_plans, learn_plans]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
