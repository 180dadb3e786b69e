"""Grouped and global aggregates.

All aggregates here are algebraic (count / sum / avg / min / max) or a
single COUNT(DISTINCT), so Spark combines them map-side before the shuffle:
a hot key costs one partial row per map task, not a third of the data in
one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_profile(
    df: DataFrame,
    keys: Sequence[str | Column],
    aggs: Mapping[str, Column],
    digits: int | None = None,
    round_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``GROUP BY keys`` (none = global) with named aggregates.

    NULL keys are kept as their own group. Rounding (half-up) is applied after
    aggregation to ``round_cols`` (default: all aggregates) when ``digits`` is
    given; rounded columns come out as double (also from DECIMAL averages).
    """
    if not aggs:
        raise ValueError("group_profile needs at least one aggregate")
    named = [expr.alias(name) for name, expr in aggs.items()]
    grouped = df.groupBy(*keys).agg(*named) if keys else df.agg(*named)
    if digits is None:
        return grouped
    targets = list(aggs) if round_cols is None else list(round_cols)
    return grouped.withColumns({c: F.round(F.col(c), digits).cast("double") for c in targets})


def decomposed_avg(sum_col: str, count_col: str) -> Column:
    """Average rebuilt from pre-aggregated sums and counts (exact regrouping)."""
    return F.sum(sum_col) / F.sum(count_col)
