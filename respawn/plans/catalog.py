"""Registry of the engine's queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the benchmark tables in ``sf_dir`` (through the adapter) and
runs over whole tables; nothing is sampled or capped except where a limit *is*
the feature (the top-k action list).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from respawn.plans.lakehouse import Lakehouse
from respawn.session import ensure_semantics

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[Lakehouse], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        _REGISTRY[key] = fn
        return fn
    return deco


def _bind(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_semantics(spark)
        return fn(Lakehouse(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    from respawn.plans import queries as _q  # noqa: F401  (populates the registry)
    return {k: _bind(v) for k, v in _REGISTRY.items()}
