"""Runs in time: spells of unchanged attributes, and gaps in a calendar.

Both are gaps-and-islands problems: rows of a key in time order, a running
number that grows where a run begins, one aggregate per run. Inputs are reduced
before the window sees them: readings to spells of a day, days to distinct days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST, LAST = "first_seen", "last_seen"


def _runs(df: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Neighbouring spells of a key with equal attributes (NULLs equal) become one."""
    in_time = Window.partitionBy(*keys).orderBy(FIRST, LAST)
    row = F.struct(*[F.col(f"`{a}`") for a in attrs])
    before = F.lag(row).over(in_time)
    begins = F.when(before.isNull() | ~row.eqNullSafe(before), 1).otherwise(0)
    numbered = df.withColumn("__begins", begins).withColumn("__run", F.sum("__begins").over(in_time))
    return numbered.groupBy(*keys, "__run", *attrs).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST)).drop("__run")


def spells(readings: DataFrame, keys: Sequence[str], ts_col: str, attrs: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """Readings (one per key and time) as spells: keys, attrs, first_seen, last_seen and ``values`` of the last reading.

    The rows are in time order already, so a spell is its last reading with the time of its first
    (NULL times sort first and do not count as one); no aggregate per spell follows the window.
    """
    in_time = Window.partitionBy(*keys).orderBy(LAST)
    row = F.struct(*[F.col(f"`{a}`") for a in attrs])
    rows = readings.select(*keys, *attrs, *values, F.col(ts_col).alias(LAST))
    before, after = F.lag(row).over(in_time), F.lead(row).over(in_time)
    begins = before.isNull() | ~row.eqNullSafe(before) | F.lag(LAST).over(in_time).isNull()
    marked = rows.withColumns({"__begins": begins, "__ends": after.isNull() | ~row.eqNullSafe(after)})
    start = F.last(F.when(F.col("__begins"), F.col(LAST)), ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn(FIRST, start).where("__ends").select(*keys, *attrs, FIRST, LAST, *values)


def merge_spells(parts: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Spells of separate stretches of time (days) merged into spells over all of them."""
    return _runs(parts.select(*keys, *attrs, FIRST, LAST), keys, attrs)


def validity(merged: DataFrame, keys: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Spells with the time they hold: from their first reading to that of the next spell (NULL: still)."""
    in_time = Window.partitionBy(*keys).orderBy(FIRST, LAST)
    return merged.withColumn(start, F.col(FIRST)).withColumn(end, F.lead(FIRST).over(in_time))


def missing_days(seen: DataFrame, keys: Sequence[str], day_col: str, first_day: Column | None = None,
                 last_day: Column | None = None) -> DataFrame:
    """Stretches of days without any row, per key: ``gap_start``, ``gap_end`` (inclusive) and ``gap_days``.

    The calendar runs from ``first_day`` to ``last_day`` (by default the first and last day of all
    keys), so days missing at a key's beginning and end are found as well. Rows are reduced
    to distinct (key, day) first; nothing is expanded to one row per calendar day. Days
    outside the calendar and NULL days do not count; a key without any day inside it is missing throughout.
    """
    days = seen.select(*keys, F.to_date(F.col(day_col)).alias("__day")).distinct()
    if first_day is None or last_day is None:
        ends = days.agg(F.min("__day").alias("lo"), F.max("__day").alias("hi")).first()
        first_day = F.lit(ends["lo"]).cast("date") if first_day is None else first_day
        last_day = F.lit(ends["hi"]).cast("date") if last_day is None else last_day
    inside = days.where(F.col("__day").between(first_day, last_day))
    # A mark before and after the calendar per key bounds the first and the last gap.
    known = days.select(*keys).distinct()
    marks = known.select(*keys, F.explode(F.array(F.date_sub(first_day, 1), F.date_add(last_day, 1))).alias("__day"))
    in_time = Window.partitionBy(*keys).orderBy("__day")
    gaps = inside.unionByName(marks).withColumn("__next", F.lead("__day").over(in_time))
    length = F.date_diff("__next", "__day") - 1
    return gaps.where(length > 0).select(*keys, F.date_add("__day", 1).alias("gap_start"), F.date_sub("__next", 1).alias("gap_end"),
                                         length.alias("gap_days"))


def same_key(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of two lists of columns in which NULLs are equal."""
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])
