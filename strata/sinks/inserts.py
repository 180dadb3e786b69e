"""Inserts that write new rows only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame

from strata.operators.joins import ConstraintError, constraint_violations
from strata.operators.keys import KeyIndex, first_per_key
from strata.sinks.snapshots import Lake, together


def insert_new(lake: Lake, table: str, rows: DataFrame, key: Sequence[str], order: Sequence[str],
               not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), buckets: int = 64) -> int:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` as an append; returns the rows inserted.

    Of the offered rows the first per key under ``order`` counts. Whether a key is there already is asked of a
    key index (hash buckets, Bloom filters), so the stored rows are neither read nor written again. A NULL in one of ``not_null``
    or a value of a ``unique`` column set that the table or another new row has raises ``ConstraintError``;
    each unique set has an index of its own (sets with a NULL member never clash, as in SQL). Rows
    and indexes are published in one commit.
    """
    name = lambda cols: f"{table}_by_{'_'.join(cols)}"
    indexes = [KeyIndex(name(cols), tuple(cols), buckets) for cols in (key, *unique)]
    lake = Lake(lake.spark, lake.root, lake.locations, {**lake.options, **{i.table: i.write_options for i in indexes}})
    change = lake.begin()
    first = first_per_key(rows, key, order).checkpoint(eager=True)
    new = indexes[0].unseen(change.base, first).checkpoint(eager=True)
    if not_null or unique:
        broken = constraint_violations(new, not_null, unique).where("violations > 0").collect()  # a row per rule
        if broken:
            raise ConstraintError(f"constraints broken: {[r.asDict() for r in broken]}")

    def no_clash(index: KeyIndex) -> None:
        asked = new.dropna(subset=list(index.keys))
        clash = asked.count() - index.unseen(change.base, asked).count()
        if clash:
            raise ConstraintError(f"{clash} new rows repeat a stored value of {list(index.keys)}")

    if unique and any(change.base.has(i.table) for i in indexes[1:]):
        together(*[partial(no_clash, i) for i in indexes[1:]])
    kept = [(i, new if i is indexes[0] else new.dropna(subset=list(i.keys))) for i in indexes]
    together(lambda: change.append(table, new), *[partial(i.remember, change, rows) for i, rows in kept])
    change.commit()
    return change.rows[table]
