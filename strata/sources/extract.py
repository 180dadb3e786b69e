"""Incremental extracts whose high-water mark is stored with the rows they brought."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.spells import same_key
from strata.sinks.snapshots import Lake


def extract_increment(lake: Lake, source: DataFrame, ts_col: str, table: str, key: Sequence[str]) -> int:
    """Append what ``source`` has beyond the stored mark to ``table``; returns the rows appended.

    The mark (the greatest ``ts_col`` brought so far) moves in the commit that adds the rows: a run that dies
    before has changed nothing and is simply repeated, one that dies after is not repeated. Rows at exactly the mark
    are compared with the stored ones by ``key``, so rows that share the last
    time but come later are not lost, and none comes twice. Without a mark all rows are read; later runs leave out
    rows whose time is NULL, as a strict ``ts > mark`` does. The predicate reaches the source.
    """
    change = lake.begin()
    mark = change.base.marks.get(table)
    new = source
    if mark is not None:
        kind = source.schema[ts_col].dataType
        at = F.lit(mark).cast(kind)
        stored = change.base.table(table).where(F.col(ts_col) == at).select(*[F.col(f"`{k}`").alias(f"__{k}") for k in key])
        later = source.where(F.col(ts_col) > at)
        tied = source.where(F.col(ts_col) == at).join(stored, same_key(key, [f"__{k}" for k in key]), "left_anti")
        new = later.unionByName(tied)
    change.append(table, new)
    top = change.staged(table, own=True).agg(F.max(ts_col).cast("string")).first()[0]
    if not change.rows[table]:
        return 0
    if top is not None:
        change.mark(table, top)
    change.commit()
    return change.rows[table]
