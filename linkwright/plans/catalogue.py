"""Every query of the linkage engine with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import blocking, evaluation, exchange, pairs

_PARTS = (blocking, pairs, evaluation, exchange)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for p in _PARTS for k, (v, _) in p.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for p in _PARTS for k, (_, s) in p.QUERIES.items() if s is not None}
