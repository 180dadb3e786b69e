"""Map-shaped documents: stock metadata projection and series explode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_value(map_col: str | Column, key: str) -> Column:
    """Value of a map entry; NULL when the key is absent (never throws).
    Works for keys with dots and spaces, which a struct path cannot address."""
    m = F.col(f"`{map_col}`") if isinstance(map_col, str) else map_col
    return F.try_element_at(m, F.lit(key))


def explode_series(
    df: DataFrame,
    map_col: str,
    keep: Sequence[str],
    key_alias: str,
    key_type: str | None = None,
    fields: Sequence[tuple[str, str, str]] = (),
    value_alias: str = "value",
) -> DataFrame:
    """One row per map entry: ``keep`` columns, the entry key, and either the
    typed fields of a nested bar map (``fields = [(key, type, alias)]``) or
    the raw value. Rows with a NULL or empty map produce no rows."""
    m = F.col(f"`{map_col}`")
    exploded = df.select(*[F.col(f"`{c}`") for c in keep], F.explode(m).alias("__k", "__v"))
    key = F.col("__k").try_cast(key_type) if key_type else F.col("__k")
    if fields:
        values = [F.try_element_at(F.col("__v"), F.lit(k)).try_cast(t).alias(a) for k, t, a in fields]
    else:
        values = [F.col("__v").alias(value_alias)]
    return exploded.select(*[F.col(f"`{c}`") for c in keep], key.alias(key_alias), *values)
