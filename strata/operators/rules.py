"""Rule checks between layers: thresholds, value constraints, routing to
quarantine, the pipeline gate, freshness and sparse groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import hours_between


class QualityGateError(RuntimeError):
    """Raised by ``gate`` when a rule fails."""


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def violations(ranges: Sequence[tuple[str, float, float]] = (),
               not_null: Sequence[str] = (), extra: Sequence[tuple[str, Column]] = ()) -> Column:
    """Array of reason strings for one row (empty = valid).

    A NULL value passes a range rule and fails a not-null rule. ``extra``
    holds named boolean conditions that must be true.
    """
    reasons = [F.when(_q(c).isNull(), F.lit(f"{c} is null")) for c in not_null]
    reasons += [
        F.when(~_q(c).between(lo, hi), F.lit(f"{c} not in [{lo:g}, {hi:g}]")) for c, lo, hi in ranges
    ]
    reasons += [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in extra]
    if not reasons:
        return F.array().cast("array<string>")
    return F.filter(F.array(*reasons), lambda r: r.isNotNull())


def route(df: DataFrame, ranges=(), not_null=(), extra=(), status_col: str = "dq_status",
          reasons_col: str = "dq_reasons") -> DataFrame:
    """Tag every row valid / quarantine with its reasons, in one pass.

    Writing the result partitioned by ``status_col`` splits valid and
    quarantined rows with a single scan of the source.
    """
    tagged = df.withColumn(reasons_col, violations(ranges, not_null, extra))
    return tagged.withColumn(
        status_col, F.when(F.size(reasons_col) == 0, F.lit("valid")).otherwise(F.lit("quarantine"))
    )


def split(df: DataFrame, ranges=(), not_null=(), extra=()) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``dq_reasons``)."""
    tagged = route(df, ranges, not_null, extra)
    valid = tagged.where(F.col("dq_status") == "valid").drop("dq_status", "dq_reasons")
    bad = tagged.where(F.col("dq_status") == "quarantine").drop("dq_status")
    return valid, bad


def violation_counts(df: DataFrame, ranges=(), not_null=()) -> DataFrame:
    """Long table ``(rule, column_name, checked_rows, violations)`` from one aggregate."""
    specs: list[tuple[str, str, Column]] = []
    for c in not_null:
        specs.append(("not_null", c, _q(c).isNull()))
    for c, lo, hi in ranges:
        specs.append((f"range[{lo:g},{hi:g}]", c, ~_q(c).between(lo, hi)))
    if not specs:
        raise ValueError("no rules")
    one = df.agg(F.count(F.lit(1)).alias("checked_rows"),
                 *[F.count_if(cond).alias(f"__v{i}") for i, (_, _, cond) in enumerate(specs)])
    rows = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col(f"__v{i}").alias("violations"))
        for i, (rule, c, _) in enumerate(specs)
    ])
    return one.select("checked_rows", F.inline(rows)).select("rule", "column_name", "checked_rows", "violations")


THRESHOLDS = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("max_null_rate", T.DoubleType()),
])


def null_threshold_check(spark: SparkSession, rates: DataFrame, thresholds, layer: str) -> DataFrame:
    """Join per-column null rates with the layer's maximum rates.

    ``thresholds`` = [(layer, column, max_pct)] with ``*`` for every column.
    A column-specific rule wins over ``*``; columns without a rule pass.
    Output: ``(column_name, null_rate, max_null_rate, passed)``. The rule
    table is a handful of rows, so the planner broadcasts it.
    """
    rules = spark.createDataFrame([t for t in thresholds if t[0] == layer], THRESHOLDS)
    specific = rules.where(F.col("column_name") != "*").select("column_name", F.col("max_null_rate").alias("__s"))
    wildcard = rules.where(F.col("column_name") == "*").agg(F.min("max_null_rate").alias("__w"))
    out = rates.join(specific, "column_name", "left").withColumn("__w", wildcard.scalar())
    limit = F.coalesce(F.col("__s"), F.col("__w"))
    return out.select(
        "column_name", "null_rate", limit.alias("max_null_rate"),
        (limit.isNull() | (F.col("null_rate") <= limit)).alias("passed"),
    )


def gate(checks: DataFrame, passed_col: str = "passed", label: str = "quality gate") -> None:
    """Fail the run if any check row did not pass. Runs one small job and
    brings at most five failing rows to the driver for the message."""
    failed = checks.where(~F.coalesce(F.col(passed_col), F.lit(False))).limit(5).collect()
    if failed:
        raise QualityGateError(f"{label} failed: {[r.asDict() for r in failed]}")


def freshness(df: DataFrame, ts_col: str, as_of: Column | None = None,
              last_alias: str = "last_data_update", hours_alias: str = "hours_since_update") -> DataFrame:
    """Latest timestamp and the whole hours from it to ``as_of`` (default now)."""
    now = as_of if as_of is not None else F.current_timestamp()
    one = df.agg(F.max(ts_col).alias(last_alias))
    return one.select(last_alias, hours_between(F.col(last_alias), now).alias(hours_alias))


def sparse_groups(df: DataFrame, count_col: str, below: int) -> DataFrame:
    """Groups with fewer than ``below`` measurements."""
    return df.where(F.col(count_col) < below)
