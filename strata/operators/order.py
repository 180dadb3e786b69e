"""Ordering, top-k and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.functions.columns import order_spec


def ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Global sort, NULLs last in both directions (range-partitioned sort)."""
    return df.orderBy(*order_spec(order))


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows under ``order``. Planned as TakeOrderedAndProject:
    each task keeps its own top k, only k rows per task are merged. Add a
    unique tie-break to ``order`` for a repeatable result."""
    if k <= 0:
        raise ValueError("k must be positive")
    return df.orderBy(*order_spec(order)).limit(k)
