"""Registered queries: one Spark plan per operator of SURVEY §2, each with its DuckDB oracle.

Each query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full; the oracle computes the same result in SQL over the same
tables. Column names are aliased identically on both sides. Importing the
modules below registers their queries.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

# registration order: the flagship feed job first, then reads, lookups, changes and the rest
from cellar.plans.queries import feed  # noqa: F401  (isort: skip)
from cellar.plans.queries import reads  # noqa: F401
from cellar.plans.queries import lookups  # noqa: F401
from cellar.plans.queries import changes  # noqa: F401
from cellar.plans.queries import aggregates  # noqa: F401
from cellar.plans.queries import scalars  # noqa: F401
from cellar.plans.queries import user_code  # noqa: F401
from cellar.plans.queries import streams  # noqa: F401
from cellar.plans.queries import delimited  # noqa: F401
from cellar.plans.queries import hot_keys  # noqa: F401
from cellar.plans.queries import ranged  # noqa: F401
from cellar.plans.queries._common import ORACLES, QUERIES, QueryFn
from cellar.session import ship_code


def _with_code(fn: QueryFn) -> QueryFn:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_code(spark)
        return fn(spark, sf)
    return run


def queries() -> dict[str, QueryFn]:
    return {name: _with_code(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
