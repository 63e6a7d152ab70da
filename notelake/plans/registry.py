"""All registered queries of the warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import analysis_queries, document_queries, export_queries, global_queries, mart_queries, more_queries, refresh_queries, stream_queries
from .warehouse import Warehouse

PLANS = mart_queries.PLANS | analysis_queries.PLANS | global_queries.PLANS | export_queries.PLANS | more_queries.PLANS | stream_queries.PLANS | document_queries.PLANS | refresh_queries.PLANS


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, plan=plan: plan(Warehouse(spark, sf_dir))) for name, (plan, _) in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in PLANS.items() if sql}
