"""Fact-to-dimension joins, insert-if-absent and insert defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.clean import dedup_latest


class FanOutError(ValueError):
    """The right side of an enrichment join is not unique on the join key."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key value occurs twice. One distributed aggregate; only
    a single offending row (if any) reaches the driver."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if dup:
        raise FanOutError(f"key {list(keys)} not unique, e.g. {dup[0].asDict()}")


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (the limit is pushed into
    the scan); beyond the bound the frame is returned unchanged and the
    planner picks a shuffle join (or AQE converts it at run time).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Column,
    how: str = "inner",
    guard: bool | str = "lazy",
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Join a fact to a dimension.

    A join meant to be N:1 must not multiply fact rows, so ``on`` has to be
    unique on the dimension: ``guard="lazy"`` checks that inside the plan
    (``one_per_key``; the query fails when it runs), ``guard=True`` by a job of
    its own before the join, ``False`` not at all. Without ``broadcast_rows``
    the join strategy is Spark's: a broadcast when the
    estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (also
    re-decided by AQE from real shuffle sizes), a sort-merge join otherwise.
    """
    if guard and not isinstance(on, Column):
        if guard == "lazy":
            dim = one_per_key(dim, list(on))
        else:
            assert_unique(dim, list(on))
    right = bounded_broadcast(dim, broadcast_rows) if broadcast_rows else dim
    return fact.join(right, on, how)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose plan raises when a key occurs twice (NULL keys, which match
    nothing, may). One aggregate on the join key, whose shuffle the join reuses."""
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in rest])
    matched = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    say = F.concat(F.lit(f"key {list(keys)} not unique, e.g. "), F.to_json(F.struct(*keys)))
    checked = counted.where(F.when((F.col("__n") > 1) & matched, F.raise_error(say).cast("boolean")).otherwise(True))
    return checked.select(*df.columns)


class ConstraintError(ValueError):
    """Rows offered to a table break one of its constraints."""


def constraint_violations(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Long table ``(rule, columns, violations)``: NULLs per NOT NULL column, and
    per UNIQUE column set the rows beyond the first of a value (a set with a
    NULL member is never a repeat, as in SQL)."""
    parts = []
    if not_null:
        one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(not_null)])
        parts.append(one.select(F.inline(F.array(*[
            F.struct(F.lit("not_null").alias("rule"), F.lit(c).alias("columns"), F.col(f"__{i}").alias("violations"))
            for i, c in enumerate(not_null)]))))
    for cols in unique:
        groups = df.dropna(subset=list(cols)).groupBy(*cols).agg((F.count(F.lit(1)) - 1).alias("n"))
        parts.append(groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit("unique").alias("rule"), F.lit(",".join(cols)).alias("columns"), "violations"))
    if not parts:
        raise ValueError("no constraints")
    return reduce(DataFrame.unionByName, parts)


def insert_absent(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str],
                  not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``: the table after the insert.

    Within the batch the first row per key under ``order`` is offered; rows
    whose key already exists are dropped (anti join), the rest appended. With
    ``not_null`` columns or ``unique`` column sets the table after the insert
    is checked first and a violation raises ``ConstraintError``.
    """
    batch = dedup_latest(new, list(key), list(order))
    fresh = batch.join(existing.select(*key), list(key), "left_anti")
    after = existing.unionByName(fresh.select(*existing.columns))
    if not_null or unique:
        broken = constraint_violations(after, not_null, unique).where("violations > 0").collect()  # a row per rule
        if broken:
            raise ConstraintError(f"constraints broken: {[r.asDict() for r in broken]}")
    return after


def apply_defaults(df: DataFrame, defaults: Mapping[str, Any], now: Column | None = None) -> DataFrame:
    """Fill NULLs with column defaults; ``"now"`` is the insert time
    (``now`` if given, else ``current_timestamp()``)."""
    stamp = now if now is not None else F.current_timestamp()
    exprs = {}
    for name, value in defaults.items():
        fill = stamp if value == "now" else F.lit(value)
        exprs[name] = F.coalesce(F.col(name), fill.cast(df.schema[name].dataType))
    return df.withColumns(exprs)
