"""Incremental runs with Structured Streaming.

A file source + checkpoint remembers which files were already processed,
which is the stored high-water mark a scheduled batch job lacks.
``trigger(availableNow=True)`` processes everything new and stops, so the
same code serves a daily schedule and a continuous stream. Checkpoints
must live in shared storage (``scratch_path`` derives them from
``spark.checkpoint.dir``) so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.clean import dedup_latest
from strata.operators.keys import KeyIndex, first_per_key
from strata.operators.rules import QualityGateError, split
from strata.session import ensure_checkpoint_dir
from strata.sinks.files import write_layer
from strata.sinks.snapshots import Change, Lake
from strata.sources.files import stored_table


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def run_available(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                  partitions: Sequence[str] | None = None, output_mode: str = "append") -> None:
    """Write everything available now, then stop (blocking)."""
    writer = (stream.writeStream.format(fmt).outputMode(output_mode)
              .option("path", sink_path).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if partitions:
        writer = writer.partitionBy(*partitions)
    query = writer.start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_batches(stream: DataFrame, step, checkpoint: str) -> None:
    """Hand everything available now to ``step(batch, batch_id)``, then stop (blocking)."""
    query = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_land(spark: SparkSession, source: str, schema: T.StructType, sink_path: str, checkpoint: str,
                fmt: str = "parquet", sink_fmt: str = "parquet",
                partitions: Sequence[str] | None = None, **options) -> None:
    """Land only the source files not seen by earlier runs."""
    stream = read_stream(spark, source, schema, fmt, **options)
    run_available(stream, sink_path, checkpoint, sink_fmt, partitions)


def stream_dedup(spark: SparkSession, source: str, schema: T.StructType, keys: Sequence[str], ts_col: str,
                 delay: str | None, sink_path: str, checkpoint: str, fmt: str = "parquet", buckets: int = 64, **options) -> None:
    """Drop repeats of ``keys`` within and across micro-batches and runs (S2), exactly.

    Of the rows of a key in the first micro-batch that has it, the one with the
    least ``ts_col`` (then the least other columns) is kept; every later row of the key is a
    repeat, however late or early its time. The keys seen so far are a
    table in hash buckets beside the sink (``KeyIndex``): a micro-batch reads the
    buckets it touches. Rows, keys and the batch's number are published in one commit, so a batch that is
    run again after a crash changes nothing. ``delay`` is taken for older
    callers: no result depends on event time any more. Read with ``read_deduped``.
    """
    index = KeyIndex(_KEYS, tuple(keys), buckets)
    lake = _dedup_lake(spark, sink_path, index)

    def step(batch: DataFrame, batch_id: int) -> None:
        def keep(change: Change) -> None:
            first = first_per_key(batch, keys, [ts_col])
            first = first.checkpoint(eager=True)  # used for the buckets, the join and the two tables
            new = index.unseen(change.base, first).checkpoint(eager=True)
            change.append(_ROWS, new)
            index.remember(change, new)

        lake.once("batch", f"{batch_id:012d}", keep)

    ensure_checkpoint_dir(spark)
    run_batches(read_stream(spark, source, schema, fmt, **options), step, checkpoint)


_ROWS, _KEYS = "rows", "keys"


def _dedup_lake(spark: SparkSession, sink_path: str, index: KeyIndex | None = None) -> Lake:
    """Rows at ``sink_path``, the keys and versions beside it."""
    options = {} if index is None else {_KEYS: index.write_options}
    return Lake(spark, sink_path.rstrip("/") + "_state", {_ROWS: sink_path.rstrip("/")}, options)


def read_deduped(spark: SparkSession, sink_path: str, schema: T.StructType) -> DataFrame:
    """All rows that ``stream_dedup`` kept."""
    now = _dedup_lake(spark, sink_path).snapshot()
    return now.table(_ROWS) if now.has(_ROWS) else spark.createDataFrame([], schema)


def stream_gate(spark: SparkSession, source: str, schema: T.StructType, lake: Lake, table: str, rules: Mapping[str, Any],
                max_bad_share: float, checkpoint: str, fmt: str = "parquet", **options) -> None:
    """Append a stream's valid rows to ``table`` and the others, with their reasons, to ``<table>_quarantine``.

    ``rules`` are those of ``route`` (ranges, not_null, extra). Both tables and the batch's number are
    published in one commit, and only if at most ``max_bad_share`` of the batch's rows are bad; otherwise the
    stream stops with a ``QualityGateError`` and neither table has changed. The counts are
    observed on the writes; a batch that is run again changes nothing.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        def keep(change: Change) -> None:
            good, bad = split(batch.checkpoint(eager=True), **rules)
            change.append(table, good)
            change.append(f"{table}_quarantine", bad)
            n_good, n_bad = change.rows[table], change.rows[f"{table}_quarantine"]
            if n_bad > max_bad_share * (n_good + n_bad):
                raise QualityGateError(f"batch {batch_id}: {n_bad} of {n_good + n_bad} rows break a rule")

        lake.once(f"{table}-batch", f"{batch_id:012d}", keep)

    ensure_checkpoint_dir(spark)
    run_batches(read_stream(spark, source, schema, fmt, **options), step, checkpoint)


def touched_rows(batch: DataFrame, target: DataFrame, partition_col: str) -> DataFrame:
    """Rows of ``target`` in the partitions that ``batch`` touches. The batch's
    least and greatest value become literal partition filters, so the scan lists
    that stretch only; the semi join then leaves out the untouched ones between."""
    part = F.col(partition_col)
    ends = batch.agg(F.min(part).alias("lo"), F.max(part).alias("hi"), F.count_if(part.isNull()).alias("nulls")).first()
    near = F.lit(False) if ends["lo"] is None else part.between(F.lit(ends["lo"]), F.lit(ends["hi"]))
    if ends["nulls"]:
        near = near | part.isNull()
    touched = batch.select(part.alias("__touched")).distinct()
    return target.where(near).join(touched, part.eqNullSafe(F.col("__touched")), "left_semi")


def merge_into_partitions(batch: DataFrame, target: str, keys: Sequence[str], order: Sequence[str],
                          partition_col: str) -> int:
    """Merge one batch into a partitioned Parquet table: rows of the touched
    partitions are combined with the batch, deduplicated on ``keys`` (first
    under ``order``), and only those partitions are overwritten. Replaying a
    batch gives the same table (idempotent).

    ``keys`` must hold ``partition_col``: a key that moved to another
    partition would leave its old row behind."""
    if partition_col not in keys:
        raise ValueError(f"the keys {list(keys)} must hold the partition column {partition_col!r}")
    spark = batch.sparkSession
    current = stored_table(spark, target, batch.schema)
    combined = batch if current is None else touched_rows(batch, current, partition_col).unionByName(batch)
    # Materialise the merged partitions (reliable checkpoint) so the
    # overwrite does not read the files it replaces.
    merged = dedup_latest(combined, keys, order).checkpoint(eager=True)
    return write_layer(merged, target, [partition_col], mode="overwrite", dynamic=True)


def stream_merge(spark: SparkSession, source: str, schema: T.StructType, keys: Sequence[str],
                 order: Sequence[str], partition_col: str, partition_expr, target: str, checkpoint: str,
                 fmt: str = "parquet", **options) -> None:
    """Upsert new source rows into ``target`` without losing older
    partitions (S3): ``foreachBatch`` + dynamic partition overwrite. ``keys``
    must hold ``partition_col``."""
    if partition_col not in keys:
        raise ValueError(f"the keys {list(keys)} must hold the partition column {partition_col!r}")
    stream = read_stream(spark, source, schema, fmt, **options).withColumn(partition_col, partition_expr)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_into_partitions(batch, target, keys, order, partition_col)

    run_batches(stream, merge, checkpoint)
