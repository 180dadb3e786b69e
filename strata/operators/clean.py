"""Row-level cleaning: critical-field filter, stamping, deterministic dedup."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import order_spec


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL or NaN."""
    if not cols:
        return df
    return df.na.drop(how="any", subset=list(cols))


def stamp(df: DataFrame, **cols: Any) -> DataFrame:
    """Add literal or expression columns; the string ``"now"`` means the
    query's ``current_timestamp()`` (one value for the whole query)."""
    exprs: dict[str, Column] = {}
    for name, value in cols.items():
        if isinstance(value, Column):
            exprs[name] = value
        elif value == "now":
            exprs[name] = F.current_timestamp()
        else:
            exprs[name] = F.lit(value)
    return df.withColumns(exprs)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows per key under ``order`` (e.g. ``["ts desc", "id"]``).

    ``order`` must be a total order inside a key for a repeatable survivor.
    NULL keys form one group, as with ``dropDuplicates``. The filter on
    ``row_number`` makes Spark cut every map partition down to ``n`` rows per
    key before the shuffle (partial WindowGroupLimit), so a key holding a large
    share of the rows does not pile up in one task.
    """
    if not keys:
        raise ValueError("dedup_latest needs keys")
    w = Window.partitionBy(*keys).orderBy(*order_spec(order))
    rn = "__strata_rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n).drop(rn)
