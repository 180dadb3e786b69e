"""An index of keys seen so far, in hash buckets, kept as a table of a lake.

``unseen`` tells new keys from known ones by reading the touched buckets only;
for few keys the Parquet Bloom filters and ranges of the key hash leave out most
files of those as well. ``remember`` appends the new keys in the change that
appends their rows, so index and rows are published together. A bucket's folders
are merged once there are more than ``max_folders`` of them.

NULL key members compare equal, as in SELECT DISTINCT.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sinks.snapshots import Change, Snapshot

_HASH, _BUCKET = "key_hash", "key_bucket"


@dataclass(frozen=True)
class KeyIndex:
    table: str
    keys: tuple[str, ...]
    buckets: int = 64
    max_folders: int = 8
    few_keys: int = 1000  # the key hashes of up to so many rows go into the scan's filter

    @property
    def write_options(self) -> dict[str, str]:
        return {f"parquet.bloom.filter.enabled#{_HASH}": "true"}

    def _hashed(self, rows: DataFrame) -> DataFrame:
        h = F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])
        return rows.withColumn(_HASH, h).withColumn(_BUCKET, F.pmod(F.col(_HASH), F.lit(self.buckets)).cast("int"))

    def known(self, snapshot: Snapshot, rows: DataFrame) -> DataFrame:
        """The indexed keys that can match ``rows`` (with hash and bucket)."""
        hashed = self._hashed(rows)
        hashes = [r[0] for r in hashed.select(_HASH).limit(self.few_keys + 1).collect()]
        few = len(hashes) <= self.few_keys
        # At most one row per bucket.
        touched = {h % self.buckets for h in hashes} if few else {r[0] for r in hashed.select(_BUCKET).distinct().collect()}
        found = snapshot.table(self.table, [f"{_BUCKET}={b}" for b in sorted(touched)])
        return found.where(F.col(_HASH).isin(hashes)) if few else found

    def unseen(self, snapshot: Snapshot, rows: DataFrame) -> DataFrame:
        """Rows whose key is not in the index. ``rows`` is used more than once and should be stored."""
        if not snapshot.has(self.table):
            return rows
        known = self.known(snapshot, rows).select(F.col(_HASH).alias("__h"), *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(self.keys)])
        same = [F.col("__hash") == F.col("__h"), *[F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)]]
        marked = rows.withColumn("__hash", F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]))
        return marked.join(known, reduce(Column.__and__, same), "left_anti").drop("__hash")

    def remember(self, change: Change, rows: DataFrame) -> None:
        """Add the keys of ``rows`` (one row per key, none of them indexed)."""
        new = self._hashed(rows.select(*[F.col(f"`{k}`") for k in self.keys]))
        change.append(self.table, new, _BUCKET)
        full = [part for part, n in Counter(p for p, _ in change.folders[self.table]).items() if n > self.max_folders]
        if full:
            entries = tuple(e for e in change.folders[self.table] if e[0] in full)
            merged = Snapshot(change.lake, change.base.version, change.schemas, {self.table: entries}).table(self.table)
            change.replace(self.table, merged, _BUCKET)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first under ``order``, then under the other columns (cast to text where they have no order)."""
    from strata.operators.clean import dedup_latest
    rest = [c for c in rows.columns if c not in keys and c not in {o.split()[0] for o in order}]
    return dedup_latest(rows, list(keys), [*order, *rest] or list(keys))
