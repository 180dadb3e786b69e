"""Dimension tables with dense, stable surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import order_spec
from strata.operators.clean import dedup_latest
from strata.session import ensure_checkpoint_dir

# Row position inside a partition = lower 33 bits of monotonically_increasing_id.
_LOCAL_BITS = (1 << 33) - 1


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx",
                partitions: int | None = None) -> DataFrame:
    """Number rows 1..N in ``order`` without moving all rows into one task.

    ``ROW_NUMBER() OVER (ORDER BY ...)`` has no partition key, so Spark runs it
    in a single task. Here the rows are range-partitioned on the order (adjacent
    ranges land in adjacent partitions), sorted inside each partition, numbered
    locally, and shifted by the row count of all earlier partitions. The
    offset table has one row per partition, so it is bounded by the partition
    count (not by the data) and is safe to broadcast. ``order`` must be a total
    order for a repeatable numbering.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = order_spec(order)
    pid, local = "__strata_pid", "__strata_local"
    # The partition id and local position are materialised once (reliable
    # checkpoint in the shared checkpoint folder): the count branch and the
    # numbering branch must see the same partitions, which two independently
    # (AQE-)coalesced reads of one shuffle would not guarantee.
    ranged = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn(pid, F.spark_partition_id())
        .withColumn(local, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)))
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy(pid).agg(F.count(F.lit(1)).alias("__strata_n"))
    offsets = counts.select(
        pid,
        (F.sum("__strata_n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__strata_off"),
    ).fillna(0, subset=["__strata_off"])
    return (
        ranged.join(F.broadcast(offsets), pid)
        .withColumn(name, F.col("__strata_off") + F.col(local) + F.lit(1))
        .drop(pid, local, "__strata_off")
    )


def dimension(
    df: DataFrame,
    natural_key: str,
    attrs: Sequence[str],
    order: Sequence[str] | None = None,
    key_name: str = "dim_key",
    existing: DataFrame | None = None,
) -> DataFrame:
    """Distinct natural keys with attributes and a dense surrogate key.

    One row per natural key survives (first under ``order``, default the
    attributes themselves). Without ``existing`` keys run 1..N in natural-key
    order. With ``existing`` (a previous build holding ``key_name``), known
    keys keep their surrogate, new keys continue after the current maximum, and
    the attributes are those of ``df`` where it has the key, else the stored ones.
    """
    cols = [natural_key, *attrs]
    survivors = dedup_latest(df.select(*cols), [natural_key], list(order or attrs or [natural_key]))
    if existing is None:
        return dense_index(survivors, [natural_key], key_name).select(key_name, *cols)
    new = survivors.join(existing.select(natural_key), natural_key, "left_anti")
    top = existing.agg(F.coalesce(F.max(key_name), F.lit(0))).scalar()
    numbered = dense_index(new, [natural_key], "__strata_new").select(
        (F.col("__strata_new") + top).cast(existing.schema[key_name].dataType).alias(key_name), *cols
    )
    newer = survivors.select(F.lit(True).alias("__newer"), F.col(natural_key), *[F.col(a).alias(f"__{a}") for a in attrs])
    both = existing.select(key_name, *cols).join(newer, natural_key, "left")
    current = both.select(key_name, natural_key, *[F.when(F.col("__newer"), F.col(f"__{a}")).otherwise(F.col(a)).alias(a) for a in attrs])
    return current.unionByName(numbered)
