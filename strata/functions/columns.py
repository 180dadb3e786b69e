"""Column-expression helpers. All of them return built-in Spark expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INDEXED = re.compile(r"^(?P<name>[^\[]+)\[(?P<idx>\d+)\]$")


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def path_col(path: str) -> Column:
    """Resolve a dotted path; ``arr[i]`` segments take the i-th element.

    Array access goes through ``get``, which yields NULL for an out-of-range
    index instead of failing under ANSI mode.
    """
    column: Column | None = None
    for segment in path.split("."):
        match = _INDEXED.match(segment)
        name = match.group("name") if match else segment
        column = F.col(_quote(name)) if column is None else column.getField(name)
        if match:
            column = F.get(column, F.lit(int(match.group("idx"))))
    assert column is not None
    return column


def first_of(array: Column | str, field: str | None = None) -> Column:
    """First element of an array (or one of its fields); NULL if empty or NULL."""
    arr = F.col(array) if isinstance(array, str) else array
    head = F.get(arr, F.lit(0))
    return head.getField(field) if field else head


def exact_avg(col: Column | str, scale: int = 12, limit: float = 1e15) -> Column:
    """Average that does not depend on the order of the sum (a double sum does,
    which makes a half-up rounding of the mean flip between runs and engines).

    Values are summed as DECIMAL with ``scale`` digits, so the mean is off by
    at most 10^-scale. Groups holding NaN or a value of ``limit`` or more
    take the plain double average, which keeps NaN and infinities."""
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    plain = F.isnan(c) | (F.abs(c) >= limit)
    exact = F.avg(F.when(~plain, c).cast(f"decimal({16 + scale},{scale})")).cast("double")
    return F.when(F.count_if(plain) > 0, F.avg(c)).otherwise(exact)


def distinct_count(col: Column | str, max_error: float | None = None) -> Column:
    """COUNT(DISTINCT col): exact, or with ``max_error`` (relative standard deviation) estimated by HyperLogLog++,
    which keeps a fixed number of registers per group where the exact count shuffles every value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.count_distinct(c) if max_error is None else F.approx_count_distinct(c, max_error)


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    """Percentage rounded half-up, 0 when the total is 0."""
    return F.when(total > 0, F.round(F.lit(100.0) * part / total, digits)).otherwise(F.lit(0.0))


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours elapsed from ``start`` to ``end`` (truncated, not boundaries)."""
    return F.timestamp_diff("HOUR", start, end)


def order_spec(spec: list[str] | tuple[str, ...]) -> list[Column]:
    """Turn ``["ts desc", "id"]`` into sort expressions with NULLs last."""
    out = []
    for item in spec:
        parts = item.split()
        name = parts[0]
        direction = parts[1].lower() if len(parts) > 1 else "asc"
        col = F.col(name)
        out.append(col.desc_nulls_last() if direction == "desc" else col.asc_nulls_last())
    return out
