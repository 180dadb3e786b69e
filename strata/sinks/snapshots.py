"""Tables that change together, in versions.

A ``Lake`` is a folder of Parquet tables and manifests. A change writes new
folders beside the old ones, never into them; nothing of it can be seen until
``commit`` adds the next manifest, a single small file that names every live
folder of every table. So a run that fails at any step, at a quality gate or
by a lost driver, leaves all tables at the version they had, and a
reader that has pinned a version keeps it while others are published.

A manifest also carries marks (the last stream batch, a high-water time): a
mark moves in the same commit as the rows it stands for, so a repeated run knows
what is already there, and nothing is lost or written twice.

Partitioned tables are changed by partition: ``replace`` swaps the folders of the
partition values in the new rows, ``append`` adds folders beside the present ones.
The driver handles folder names (as many as live partitions), never rows. One
writer at a time: a second one that commits the same version fails.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "kind string, name string, part string, commit string, value string"
_COMMIT = "commit"


class CommitConflict(RuntimeError):
    """The next version has been published by someone else."""


def together(*steps: Callable[[], None]) -> None:
    """Run steps that change different tables at the same time; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


@dataclass(frozen=True)
class Snapshot:
    """One version of all tables."""

    lake: Lake
    version: int
    schemas: Mapping[str, str] = field(default_factory=dict)
    folders: Mapping[str, tuple[tuple[str, str], ...]] = field(default_factory=dict)  # table -> (partition, commit)
    marks: Mapping[str, str] = field(default_factory=dict)

    def has(self, table: str) -> bool:
        return table in self.schemas

    def schema(self, table: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schemas[table]))

    def parts(self, table: str) -> list[str]:
        """Live partitions, as ``column=value`` folders (one empty text for an unpartitioned table)."""
        return sorted({part for part, _ in self.folders.get(table, ())})

    def table(self, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The table; with ``parts`` only those partitions are listed and read."""
        if not self.has(table):
            raise KeyError(f"no table {table!r} in version {self.version}")
        wanted = None if parts is None else set(parts)
        paths = [os.path.join(self.lake.path(table), f"{_COMMIT}={commit}", part).rstrip("/")
                 for part, commit in self.folders.get(table, ()) if wanted is None or part in wanted]
        schema, spark = self.schema(table), self.lake.spark
        if not paths:
            return spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField(_COMMIT, T.StringType())])
        df = spark.read.schema(full).option("basePath", self.lake.path(table)).parquet(*paths)
        return df.select(*[F.col(f"`{f.name}`") for f in schema.fields])


class Change:
    """New folders of some tables, seen by nobody before ``commit``."""

    def __init__(self, lake: Lake, base: Snapshot, name: str | None = None):
        self.lake, self.base, self.name = lake, base, name or uuid.uuid4().hex
        self.schemas, self.marks = dict(base.schemas), dict(base.marks)
        self.folders = {table: list(entries) for table, entries in base.folders.items()}
        self.rows: dict[str, int] = {}
        self._writes: dict[str, int] = {}

    def _write(self, table: str, df: DataFrame, partition: str | None) -> tuple[str, list[str]]:
        """The folder written (a new one per write) and its partitions."""
        if _COMMIT in df.columns:
            raise ValueError(f"a table cannot have a column {_COMMIT!r}")
        fields = [f for f in df.schema.fields if f.name != partition] + [f for f in df.schema.fields if f.name == partition]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        self._writes[table] = self._writes.get(table, 0) + 1
        commit = f"{self.name}.{self._writes[table]}"
        path = os.path.join(self.lake.path(table), f"{_COMMIT}={commit}")
        seen = Observation(f"{table}-{uuid.uuid4().hex}")
        rows = df.hint("rebalance", F.col(f"`{partition}`")) if partition else df
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        # A folder of its own for this change: an earlier attempt of the same name is replaced as a whole.
        writer = writer.option("partitionOverwriteMode", "static").option("maxRecordsPerFile", "5000000")
        for option, value in self.lake.options.get(table, {}).items():
            writer = writer.option(option, value)
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        n = int(seen.get["rows"])
        self.rows[table] = self.rows.get(table, 0) + n
        if table in self.schemas and self.schemas[table] != schema.json():
            raise ValueError(f"{table}: the columns differ from those of the table")
        self.schemas[table] = schema.json()
        if not partition:
            return commit, [""]
        if not n:
            return commit, []
        files = self.lake.spark.read.schema(schema).parquet(path).inputFiles()
        return commit, sorted({os.path.basename(os.path.dirname(unquote(f))) for f in files})

    def replace(self, table: str, df: DataFrame, partition: str | None = None) -> Change:
        """The partitions of ``df``'s values (the whole table without ``partition``) hold ``df``'s rows only."""
        commit, parts = self._write(table, df, partition)
        kept = [e for e in self.folders.get(table, []) if partition and e[0] not in parts]
        self.folders[table] = kept + [(p, commit) for p in parts]
        return self

    def append(self, table: str, df: DataFrame, partition: str | None = None) -> Change:
        commit, parts = self._write(table, df, partition)
        self.folders[table] = self.folders.get(table, []) + [(p, commit) for p in parts]
        return self

    def staged(self, table: str, own: bool = False) -> DataFrame:
        """The table as it will be; with ``own`` only the folders of this change."""
        entries = tuple(e for e in self.folders[table] if not own or e[1].rsplit(".", 1)[0] == self.name)
        return Snapshot(self.lake, self.base.version, self.schemas, {table: entries}).table(table)

    def mark(self, name: str, value: str) -> Change:
        self.marks[name] = value
        return self

    def commit(self) -> Snapshot:
        return self.lake._publish(Snapshot(self.lake, self.base.version + 1, self.schemas,
                                           {t: tuple(e) for t, e in self.folders.items()}, self.marks))


class Lake:
    """``locations`` puts single tables outside ``root``; ``options`` are Parquet write options by table."""

    def __init__(self, spark: SparkSession, root: str, locations: Mapping[str, str] | None = None,
                 options: Mapping[str, Mapping[str, str]] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.locations, self.options = dict(locations or {}), dict(options or {})

    def path(self, table: str) -> str:
        return self.locations.get(table, os.path.join(self.root, table))

    def _manifest(self, version: int) -> str:
        return os.path.join(self.root, "_versions", f"version={version:012d}")

    def versions(self) -> list[int]:
        """All published versions, in order (file names only, no contents)."""
        try:
            files = self.spark.read.schema(MANIFEST).json(os.path.join(self.root, "_versions")).inputFiles()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({int(f.rsplit("/version=", 1)[1].split("/")[0]) for f in files})

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The latest version, or the one asked for; version 0 is the empty lake."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Snapshot(self, 0)
        rows = self.spark.read.schema(MANIFEST).json(self._manifest(version)).collect()  # a row per table, folder and mark
        folders: dict[str, list[tuple[str, str]]] = {}
        for r in rows:
            if r["kind"] == "folder":
                folders.setdefault(r["name"], []).append((r["part"], r[_COMMIT]))
        of = lambda kind: {r["name"]: r["value"] for r in rows if r["kind"] == kind}
        return Snapshot(self, version, of("schema"), {t: tuple(e) for t, e in folders.items()}, of("mark"))

    def begin(self, name: str | None = None) -> Change:
        """A change on top of the latest version. With a ``name`` of its own (a batch's), a repeated attempt uses the same folders."""
        return Change(self, self.snapshot(), name)

    def _publish(self, new: Snapshot) -> Snapshot:
        rows = [("schema", t, None, None, s) for t, s in new.schemas.items()]
        rows += [("folder", t, part, commit, None) for t, entries in new.folders.items() for part, commit in entries]
        rows += [("mark", name, None, None, value) for name, value in new.marks.items()]
        try:
            self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").json(self._manifest(new.version))
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise CommitConflict(f"version {new.version} of {self.root} has been published meanwhile") from e
        return new

    def rollback(self, version: int) -> Snapshot:
        """Publish an old version's tables and marks again, as the next version."""
        old, last = self.snapshot(version), self.snapshot()
        return self._publish(Snapshot(self, last.version + 1, old.schemas, old.folders, old.marks))

    def once(self, mark: str, value: str, step: Callable[[Change], None]) -> Snapshot | None:
        """Run ``step`` on a change and commit it with the mark, unless the mark already stands at ``value``."""
        change = self.begin(f"{mark}-{value}")
        if change.base.marks.get(mark) == value:
            return None
        step(change)
        return change.mark(mark, value).commit()
