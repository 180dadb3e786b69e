"""Sharding by a two-pass external shuffle.

Law ``key``: a row's shard is the one whose seeded hash with the row's id is the
highest (rendezvous hashing), so the id and the number of shards decide, and
one more shard takes rows only into itself.

First pass: rows scatter by a seeded hash into bins of their shard; a narrow
count of the bins gives every bin its first slot. Second pass: the rows of a bin
come together, are ordered by hash, cut into buckets of at most
``bucket_bytes`` and each bucket is Fisher-Yates shuffled (Spark's seeded
``shuffle`` of an array). Slots run through a shard without a gap.

Scale: one exchange moves the texts. A bucket is bounded by bytes whatever the
bin holds, since the cut runs over a spilling window; equal texts under
different ids scatter apart. The bins are at most ``n_shards * FINE`` (98,304 for
24 shards), which bounds the broadcast of their offsets. The partition number
and the order inside a partition are fixed, so a lost task repeats its result.

Edge cases: a null text has size ``row_bytes`` and crc32 of nothing; a null id hashes
like no id, so such rows share a shard by the law and spread over its bins by
text; rows alike in id and text are ordered by their other columns (maps and
variants, which have no order, left out), and rows alike in those too may be swapped
unnoticed; an empty table gives no rows; all columns are kept, but one that is named
like an output is replaced by it (``names`` gives the outputs other names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import materialise

FINE = 4096


def rendezvous(key: Column, n_shards: int, seed: int) -> Column:
    """The shard of ``key`` among 0 .. n_shards - 1."""
    bids = F.array(*[F.struct(F.xxhash64(F.lit(seed), key, F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(n_shards)])
    return F.array_max(bids)["i"]


def byte_size(text: Column, row_bytes: int = 8) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(row_bytes)


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _ordered(kind: T.DataType) -> bool:
    """Whether Spark can sort values of this type."""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def shard(docs: DataFrame, n_shards: int = 24, seed: int = 23, row_bytes: int = 8, bin_bytes: int = 8 << 20,
          bucket_bytes: int = 2 << 20, id_col: str = "doc_id", text_col: str = "text",
          names: tuple[str, str, str] = ("shard", "slot", "grown_shard")) -> DataFrame:
    """All columns of ``docs`` plus shard, slot and grown_shard (the shard among one more)."""
    cols = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    plain = [i for i, c in enumerate(cols) if _ordered(docs.schema[c].dataType)]
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    h = F.xxhash64(F.lit(seed + 1), key, F.xxhash64(text))
    fine = F.shiftrightunsigned(h, 64 - 12).cast("int")  # FINE = 2 ** 12
    counts = materialise(
        docs.select(rendezvous(key, n_shards, seed).alias("shard"), fine.alias("fine"), byte_size(text, row_bytes).alias("size"))
        .groupBy("shard", "fine").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "shard-counts")
    total = counts.agg(F.sum("bytes")).first()[0] or 0
    bits = min(12, max(0, (max(1, total // (n_shards * bin_bytes)) - 1).bit_length()))
    bins = counts.groupBy("shard", F.shiftright("fine", 12 - bits).alias("bin")).agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    rows = docs.select(rendezvous(key, n_shards, seed).alias("shard"), rendezvous(key, n_shards + 1, seed).alias("grown_shard"),
                       F.shiftright(fine, 12 - bits).alias("bin"), h.alias("_h"), byte_size(text, row_bytes).alias("_size"),
                       *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cols)])
    # A bucket is sorted by what can be sorted; the rest travels behind it.
    row = F.struct(F.struct("_h", "grown_shard", *[f"_c{i}" for i in plain]).alias("key"),
                   F.struct(F.lit(0).alias("_"), *[f"_c{i}" for i in range(len(cols)) if i not in plain]).alias("rest")).alias("row")
    rows = rows.select("shard", "bin", "_h", "_size", row)
    rows = rows.join(F.broadcast(offsets), ["shard", "bin"])
    parts = max(1, n_shards << bits, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    scattered = rows.repartition(parts, "shard", "bin")
    upto = Window.partitionBy("shard", "bin").orderBy("_h", "_size").rowsBetween(Window.unboundedPreceding, 0)
    cut = scattered.withColumn("_bucket", F.floor((F.sum("_size").over(upto) - F.col("_size")) / bucket_bytes)).withColumn(
        "_place", F.row_number().over(Window.partitionBy("shard", "bin").orderBy("_h", "_size")))
    buckets = cut.groupBy("shard", "bin", "_bucket").agg(
        F.collect_list("row").alias("rows"), (F.min("_place") - 1 + F.first("offset")).alias("first"))
    in_order = F.array_sort("rows") if len(plain) == len(cols) else F.array_sort(
        "rows", lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    shuffled = buckets.sortWithinPartitions("shard", "bin", "_bucket").select(
        "shard", "first", F.shuffle(in_order, F.lit(seed)).alias("rows"))
    out = shuffled.select("shard", "first", F.posexplode("rows").alias("_at", "row"))
    value = lambda i: F.col(f"row.{'key' if i in plain else 'rest'}._c{i}")
    return out.select(*[value(i).alias(c) for i, c in enumerate(cols)], F.col("shard").alias(names[0]),
                      (F.col("first") + F.col("_at")).cast("long").alias(names[1]), F.col("row.key.grown_shard").alias(names[2]))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write one folder per shard (``shard=K``), rows with their slot."""
    shard(docs, **options).write.partitionBy(options.get("names", ("shard",))[0]).parquet(path)
