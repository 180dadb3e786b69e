"""Flatten nested documents into typed columns (bronze -> silver projection)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from strata.functions.columns import path_col


def flatten(df: DataFrame, spec: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Project ``[(path, type, alias), ...]`` with ``try_cast``.

    A value that does not fit its type (an id above int range, a bad
    timestamp text) becomes NULL instead of failing the job; a field missing
    from the (explicit) schema reads as NULL. Only the referenced leaves are
    read from columnar sources (nested schema pruning).
    """
    cols = [path_col(path).try_cast(dtype).alias(alias) for path, dtype, alias in spec]
    if not cols:
        raise ValueError("empty flatten spec")
    return df.select(*cols)
