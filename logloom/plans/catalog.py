"""All registered queries and their oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.session import ensure_checkpoint_dir

_MODULES = [
    "logloom.plans.weblog_queries",
    "logloom.plans.pages_queries",
    "logloom.plans.text_queries",
    "logloom.plans.table_queries",
    "logloom.plans.som_queries",
    "logloom.plans.autoencoder_queries",
    "logloom.plans.model_queries",
    "logloom.plans.log_model_queries",
    "logloom.plans.training_queries",
]


def _utc(fn: Callable[[SparkSession, str], DataFrame]):
    """Log time features are defined in UTC; pin the session zone."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    return run


def _load():
    import importlib
    queries, sql = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        for k, fn in mod.QUERIES.items():
            queries[k] = _utc(fn)
        sql.update(getattr(mod, "SQL", {}))
    return queries, sql


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _load()[0]


def all_oracle_sql() -> dict[str, str]:
    return _load()[1]
