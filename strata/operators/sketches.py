"""Column profiles that are stored per partition and merged without a second look at the rows.

Per partition and column: rows, NULLs, extremes, an exact sum, a HyperLogLog sketch of the values (for the number of distinct
ones) and, for numbers, a KLL sketch (for quantiles). A new day's profile is one scan of that
day; the profile of everything is an aggregate over the small stored rows. ``distinct_values`` is the
exact mode: the partition's distinct values themselves, which merge by another distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import pct
from strata.operators.quality import numeric_columns

HLL_BITS = 14  # 16,384 registers: a standard error of about 0.8 %


def _q(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def profile_parts(df: DataFrame, part: str, cols: Sequence[str] | None = None, numeric: Sequence[str] | None = None) -> DataFrame:
    """One row per value of ``part`` and column, from one aggregate over ``df``."""
    cols = [c for c in (cols or df.columns) if c != part]
    numeric = [c for c in (numeric if numeric is not None else numeric_columns(df)) if c in cols]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(_q(c).isNull()).alias(f"n{i}"), F.hll_sketch_agg(_q(c).cast("string"), F.lit(HLL_BITS)).alias(f"h{i}")]
        if c in numeric:
            x = F.nanvl(_q(c).cast("double"), F.lit(None))
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.sum(x.try_cast("decimal(38,9)")).alias(f"s{i}"),
                     F.count(x).alias(f"c{i}"), F.kll_sketch_agg_double(x).alias(f"q{i}")]
    one = df.groupBy(_q(part).cast("string").alias("part")).agg(*aggs)
    none = lambda kind: F.lit(None).cast(kind)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"), F.col(f"h{i}").alias("distinct_sketch"),
                     *[(F.col(f"{p}{i}") if c in numeric else none(kind)).alias(a) for p, a, kind in (
                         ("lo", "min_value", "double"), ("hi", "max_value", "double"), ("s", "total", "decimal(38,9)"),
                         ("c", "numbers", "bigint"), ("q", "quantile_sketch", "binary"))])
            for i, c in enumerate(cols)]
    return one.select("part", "rows", F.inline(F.array(*rows)))


def distinct_values(df: DataFrame, part: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The distinct values (as text, NULLs left out) per value of ``part`` and column: the exact mode's partials."""
    cols = [c for c in (cols or df.columns) if c != part]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value")) for c in cols])
    long = df.select(_q(part).cast("string").alias("part"), F.inline(pairs))
    return long.where(F.col("value").isNotNull()).distinct()


def merge_profiles(parts: DataFrame, quantiles: Sequence[float] = (0.5,), digits: int = 2) -> DataFrame:
    """Profiles of any partitions as one: column_name, rows, null_rate, distinct_estimate, min, max, mean and quantiles."""
    merged = parts.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("distinct_sketch").alias("h"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.sum("total").alias("total"),
        F.sum("numbers").alias("numbers"),
        F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("quantile_sketch"))).alias("q"))
    mean = F.when(F.col("numbers") > 0, F.col("total").cast("double") / F.col("numbers"))
    cut = lambda p: F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("q", F.lit(float(p))))
    return merged.select("column_name", "rows", "nulls", pct(F.col("nulls"), F.col("rows"), digits).alias("null_rate"),
                         F.hll_sketch_estimate("h").alias("distinct_estimate"), "min_value", "max_value", mean.alias("mean_value"),
                         *[cut(p).alias(f"q{round(p * 100):02d}") for p in quantiles])


def merge_distinct(values: DataFrame) -> DataFrame:
    """Exact number of distinct values per column, from stored ``distinct_values``."""
    return values.select("column_name", "value").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
