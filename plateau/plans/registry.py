"""Registry of the queries exposed through ``__spark_entry__``.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the DuckDB
text that computes the same result on the driver's tables (``None`` when the operator
is not expressible in SQL; the driver then checks rows only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plateau.plans.canonical import canon
from plateau.session import checkpoint_dir, ensure_utc, release

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            checkpoint_dir(spark)
            release()  # nothing held for an earlier query outlives it
            return canon(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Import side effects register the queries.
    from plateau.plans import queries  # noqa: F401
