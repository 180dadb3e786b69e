"""Set operations over layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_counts(layers: Mapping[str, DataFrame], name_col: str = "layer",
                 count_col: str = "record_count") -> DataFrame:
    """``SELECT 'name' AS layer, COUNT(*) ... UNION ALL ...`` - one row per layer.

    Each count is a global aggregate with map-side partial counts; the union
    only concatenates the one-row results.
    """
    if not layers:
        raise ValueError("no layers")
    parts = [
        df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(name).alias(name_col), count_col)
        for name, df in layers.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
