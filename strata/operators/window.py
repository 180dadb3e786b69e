"""Latest row per key and the current-versus-previous trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import order_spec
from strata.operators.clean import dedup_latest


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first under ``order`` (``["ts desc", "tie desc"]``)."""
    return dedup_latest(df, keys, order, n=1)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value_cols: Sequence[str],
    prefix: str = "previous_",
    delta_prefix: str = "delta_",
) -> DataFrame:
    """Latest row per key plus the previous row's values and the change.

    Only the two newest rows of each key are needed, so the window is cut to
    two rows per key before the shuffle; the ``lead`` then runs over the same
    partitioning and sort (no second exchange). A key with one row gets NULL
    previous values.
    """
    w = Window.partitionBy(*keys).orderBy(*order_spec(order))
    rn = "__strata_rn"
    top2 = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= 2)
    prev = {f"{prefix}{c}": F.lead(F.col(c)).over(w) for c in value_cols}
    out = top2.withColumns(prev).where(F.col(rn) == 1).drop(rn)
    deltas = {f"{delta_prefix}{c}": F.col(c) - F.col(f"{prefix}{c}") for c in value_cols}
    return out.withColumns(deltas)
