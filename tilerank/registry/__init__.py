"""Registry of runnable queries: key -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Each area module registers its queries with :func:`register`; the oracle text is plain SQL
over the driver's views (fixture CTEs prepended with ``with_fixtures``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import ensure_checkpoint_dir, ship_package, tune

            tune(spark)
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir.rstrip("/"))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def load_all() -> None:
    from . import scans, filters, joins, clusters, raster, aggregates, windows, scalars, models, composites  # noqa: F401
