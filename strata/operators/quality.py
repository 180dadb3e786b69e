"""Data-quality profiling: null rates, duplicates, value ranges, schema.

Each profile is ONE aggregate over the data (all columns at once), turned
into a long table (one row per column or metric) with ``inline``. The
one-row aggregate is the only thing that moves after the partial
aggregation, so the cost is a single scan regardless of column count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import distinct_count, pct
from strata.schemas import PROFILED_TYPES


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, types: Sequence[str] = PROFILED_TYPES) -> list[str]:
    """Columns whose simple type name is in ``types`` (default: int, bigint,
    double, float - decimals and small ints are left out, as in the
    reference profile)."""
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in types]


def null_rates(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Long table ``(column_name, total_rows, null_count, null_rate)``.

    ``null_rate`` is a percentage rounded half-up; 0 for an empty input.
    NaN is not NULL here (``isNull`` semantics).
    """
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__total")] + [
        F.count_if(_q(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)
    ]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ])
    return one.select(F.col("__total").alias("total_rows"), F.inline(rows)).select(
        "column_name", "total_rows", "null_count",
        pct(F.col("null_count"), F.col("total_rows"), digits).alias("null_rate"),
    )


def duplicate_stats(df: DataFrame, keys: Sequence[str], digits: int = 2, max_error: float | None = None) -> DataFrame:
    """One row ``(total_rows, distinct_rows, duplicate_count, duplicate_rate)``.

    Distinct rows count key tuples; a tuple with NULL members counts as a
    value (as ``SELECT DISTINCT``), which ``COUNT(DISTINCT a, b)`` would skip.
    Partial aggregation collapses repeated keys map-side, so a key holding a
    third of the rows costs one row per map task. With ``max_error`` the distinct
    tuples are estimated (at most the number of rows), which shuffles no keys at all.
    """
    if not keys:
        raise ValueError("duplicate_stats needs key columns")
    one = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct_count(F.xxhash64(*[x for k in keys for x in (_q(k).isNull(), _q(k))]) if max_error else F.struct(*[_q(k) for k in keys]),
                       max_error).alias("distinct_rows"),
    )
    if max_error:
        one = one.withColumn("distinct_rows", F.least("distinct_rows", "total_rows"))
    dup = F.col("total_rows") - F.col("distinct_rows")
    return one.select(
        "total_rows", "distinct_rows", dup.alias("duplicate_count"),
        pct(dup, F.col("total_rows"), digits).alias("duplicate_rate"),
    )


def range_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long table ``(column_name, min_value, max_value, avg_value, stddev_value,
    value_count)`` for numeric columns; stddev is the sample deviation."""
    cols = list(cols if cols is not None else numeric_columns(df))
    if not cols:
        raise ValueError("no numeric columns to profile")
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.min(x).alias(f"__mn{i}"), F.max(x).alias(f"__mx{i}"), F.avg(x).alias(f"__av{i}"),
                 F.stddev_samp(x).alias(f"__sd{i}"), F.count(x).alias(f"__ct{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"__mn{i}").alias("min_value"),
            F.col(f"__mx{i}").alias("max_value"), F.col(f"__av{i}").alias("avg_value"),
            F.col(f"__sd{i}").alias("stddev_value"), F.col(f"__ct{i}").alias("value_count"),
        )
        for i, c in enumerate(cols)
    ])
    return one.select(F.inline(rows))


def profile(df: DataFrame, dataset: str, keys: Sequence[str] | None = None,
            numeric: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """The full quality report as ONE aggregate job, in long form:
    ``(dataset, column_name, metric, value)``.

    Metrics: ``row_count`` and ``column_count`` (column ``*``), ``null_rate``
    per column, ``duplicate_count`` / ``duplicate_rate`` for the key tuple
    (column = the keys joined by ``,``), and min/max/avg/stddev/count per
    numeric column.
    """
    cols = df.columns
    numeric = list(numeric if numeric is not None else numeric_columns(df))
    total = F.count(F.lit(1))
    aggs = [total.alias("__total")]
    aggs += [F.count_if(_q(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)]
    if keys:
        aggs.append(F.count_distinct(F.struct(*[_q(k) for k in keys])).alias("__distinct"))
    for i, c in enumerate(numeric):
        x = _q(c).cast("double")
        aggs += [F.min(x).alias(f"__mn{i}"), F.max(x).alias(f"__mx{i}"), F.avg(x).alias(f"__av{i}"),
                 F.stddev_samp(x).alias(f"__sd{i}"), F.count(x).cast("double").alias(f"__ct{i}")]
    one = df.agg(*aggs)

    def row(column: str, metric: str, value: Column) -> Column:
        return F.struct(F.lit(column).alias("column_name"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))

    tot = F.col("__total")
    rows = [row("*", "row_count", tot), row("*", "column_count", F.lit(len(cols)))]
    rows += [row(c, "null_rate", pct(F.col(f"__n{i}"), tot, digits)) for i, c in enumerate(cols)]
    if keys:
        dup = tot - F.col("__distinct")
        label = ",".join(keys)
        rows += [row(label, "duplicate_count", dup), row(label, "duplicate_rate", pct(dup, tot, digits))]
    for i, c in enumerate(numeric):
        rows += [row(c, "min", F.col(f"__mn{i}")), row(c, "max", F.col(f"__mx{i}")),
                 row(c, "avg", F.col(f"__av{i}")), row(c, "stddev", F.col(f"__sd{i}")),
                 row(c, "count", F.col(f"__ct{i}"))]
    return one.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*rows)))


class SchemaFinding(NamedTuple):
    """One column of a table or of its expected schema; status ok / missing / extra / mismatch."""

    column_name: str
    expected: str | None
    actual: str | None
    status: str


def check_schema(df: DataFrame, expected: Mapping[str, str]) -> list[SchemaFinding]:
    """Every column, by name, held against ``expected`` ({name: simpleString}).
    Reads only the schema - no Spark job."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def status(want: str | None, have: str | None) -> str:
        if want is None:
            return "extra"
        return "missing" if have is None else "ok" if have == want else "mismatch"

    return [SchemaFinding(c, expected.get(c), actual.get(c), status(expected.get(c), actual.get(c)))
            for c in sorted({*expected, *actual})]


def schema_holds(findings: Sequence[SchemaFinding]) -> bool:
    """Whether every expected column is there with its type (extra ones are allowed)."""
    return all(f.status in ("ok", "extra") for f in findings)


def missing_required(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from ``df`` (a subset check: extra and optional
    columns are fine). Reads only the schema."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def schema_report(spark: SparkSession, df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``check_schema`` as rows (for the report files)."""
    return spark.createDataFrame(check_schema(df, expected), "column_name string, expected string, actual string, status string")
