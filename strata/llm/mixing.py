"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target size by its weight; a target stops at ``max_epochs``
times the source's size and the excess goes to the others by weight. A source
is read in whole epochs first; the rest of its target is a weighted sample
without replacement: a document's key is ``-ln(u) / quality`` with u from a
seeded hash, documents are taken by ascending key, and prefix sums of their
sizes end the sample at the document that leaves it nearest to the target.

Scale: texts are read once, for sizes and keys; all else runs on narrow rows.
A source is cut by the leading bits of its keys into about ``bucket_rows`` rows a bucket,
whose sums locate the bucket in which the budget ends; while that one still holds more rows
(keys crowd where the quality is low), it alone is cut by further bits. Only the last
one is sorted, so no task sorts or sums a whole source. The shares are solved by rounds
of two sums over the source table, of which the driver sees only the sums.

Edge cases: a null text has size 0; the null source is a source of its own, last
in order; empty documents are taken in whole epochs at no cost; repeated
rows are rows of their own (alike in everything, they share a key and
count one by one); without any words all targets are 0; an empty table
gives no rows; a null or non-positive quality counts as the least quality. ``mixed_documents``
takes columns of any names and types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import WORD, materialise, unit
from strata.operators.dimension import dense_index

MIN_QUALITY = 0.1
_BIG = "decimal(38,0)"
_FEW_SOURCES = 10_000  # rows of five numbers and a name that may be broadcast

# Keys as whole numbers of this many bits, in the same order; and the most bits that one cut takes (4,096 sums per source).
_CODE_BITS, _STEP_BITS = 52, 12


def _code(key: Column) -> Column:
    return F.floor(key / (1 + key) * F.lit(float(1 << _CODE_BITS))).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """A plain quality weight: the share of letters and blanks in the text."""
    kept = F.length(F.regexp_replace(text, r"[^\p{L}\s]+", ""))
    return F.when(F.length(text) > 0, kept / F.length(text)).otherwise(F.lit(MIN_QUALITY))


def cyclic_weights(sources: DataFrame, weights: Sequence[int] = (5, 2, 1)) -> DataFrame:
    """Sources (one row each) with ``weight``: the given weights repeat over the
    sources in code point order (the order of UTF-8 bytes), null last."""
    ordered = dense_index(sources.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_at")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("_at") - 1, F.lit(len(weights))) + 1).cast("int"))
    return ordered.withColumn("weight", turn).drop("_last", "_at")


def capped_targets(sources: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """Adds ``target``: weight shares of ``total``, none above ``max_epochs * source_size``.

    The level (target per weight) is a ratio of integers, raised round by round
    as more sources stop at their bound, until no further one does.
    """
    bound = (F.col("source_size") * max_epochs).cast(_BIG)
    rate, weights = total, sources.agg(F.sum("weight")).first()[0] or 1
    stopped = -1
    while True:
        over = F.col("weight").cast(_BIG) * F.lit(rate).cast(_BIG) > bound * F.lit(weights).cast(_BIG)
        row = sources.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, bound)), F.lit(0)).alias("held"),
                          F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("free")).first()
        if row["n"] == stopped or not row["free"]:
            break
        stopped, rate, weights = row["n"], total - int(row["held"]), int(row["free"])
    share = F.col("weight") * F.lit(float(rate)) / F.lit(float(weights))
    return sources.withColumn("target", F.when(over, bound.cast("double")).otherwise(share))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), size: Column | None = None, quality: Column | None = None,
        max_epochs: int = 3, seed: int = 17, bucket_rows: int = 256, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: the ``carry`` columns, source, size, source_size, target, epochs (times taken), taken."""
    size = word_count(F.col("text")) if size is None else size
    quality = letter_share(F.col("text")) if quality is None else quality
    body = F.xxhash64("text")
    u = unit(F.xxhash64(F.lit(seed), F.col("doc_id"), body))
    weight = F.greatest(F.coalesce(quality, F.lit(MIN_QUALITY)), F.lit(MIN_QUALITY))
    rows = materialise(docs.select(*carry, F.col("source"), size.alias("size"), (-F.log(u) / weight).alias("_key"),
                                   body.alias("_body")).withColumn("_code", _code(F.col("_key"))), "mix-sizes")
    bits = min(_STEP_BITS, (rows.count() // bucket_rows).bit_length())
    bucket = lambda n: F.shiftright("_code", _CODE_BITS - n).alias("_bucket")
    sums = materialise(rows.groupBy("source", bucket(bits)).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-buckets")
    sources = materialise(sums.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = capped_targets(cyclic_weights(sources, weights), total, max_epochs)
    sources = materialise(sources.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                             .otherwise(F.lit(0)).cast("int"))
                          .withColumn("_budget", F.col("target") - F.col("_whole") * F.col("source_size")), "mix-targets")
    # The bucket of each source in which its budget ends, and the words before it; cut again while it is large.
    upto = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    parts = sums.join(_renamed(sources), _same("source", "_source")).withColumn("_base", F.lit(0).cast("long"))
    while True:
        ends = (parts.withColumn("_upto", F.col("_base") + F.sum("words").over(upto)).where(F.col("_upto") >= F.col("_budget")).groupBy("_source")
                .agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("words")).alias("before"), "n", "_budget")).alias("e"))
                .select("_source", F.col("e._bucket").alias("_end"), F.col("e.before").alias("_before"), "e.n", "e._budget"))
        end = materialise(ends, "mix-ends")
        largest = end.agg(F.max("n")).first()[0] or 0
        if largest <= bucket_rows or bits == _CODE_BITS:
            break
        had, bits = bits, min(_CODE_BITS, bits + min(_STEP_BITS, (largest // bucket_rows).bit_length() + 1))
        near = rows.join(F.broadcast(end) if sources.count() <= _FEW_SOURCES else end,
                         _same("source", "_source") & (F.shiftright("_code", _CODE_BITS - had) == F.col("_end")))
        parts = near.groupBy("_source", "_budget", F.col("_before").alias("_base"), bucket(bits)).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    rows, end = rows.withColumn("_bucket", bucket(bits)), end.drop("n", "_budget")
    plan = _renamed(sources, keep=["source_size", "target", "_whole", "_budget"]).join(
        end.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    plan = materialise(plan, "mix-plan")
    salts = 16
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_key", "_body"), F.lit(salts)).cast("int"))
    rows = rows.join(salted, _same("source", "_source") & (rows["_salt"] == salted["_salt"])).drop(salted["_salt"])
    inside = rows.where(F.col("_bucket") == F.col("_end"))
    order = Window.partitionBy("source", "_bucket").orderBy("_key", "_body", *[c for c in carry]).rowsBetween(Window.unboundedPreceding, 0)
    upto_here = F.col("_before") + F.sum("size").over(order)
    inside = inside.withColumn("_extra", (upto_here - F.col("size") / 2 <= F.col("_budget")).cast("int"))
    outside = rows.where(F.col("_end").isNull() | (F.col("_bucket") != F.col("_end"))).withColumn(
        "_extra", F.coalesce((F.col("_bucket") < F.col("_end")).cast("int"), F.lit(0)))
    taken = inside.unionByName(outside)
    epochs = F.least(F.col("_whole") + F.when(F.col("_budget") > 0, F.col("_extra")).otherwise(0), F.lit(max_epochs))
    return taken.withColumn("epochs", epochs.cast("int")).select(
        *carry, "source", "size", "source_size", "target", "epochs", (F.col("size") * F.col("epochs")).cast("long").alias("taken"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _renamed(sources: DataFrame, keep: Sequence[str] = ("_budget",)) -> DataFrame:
    return sources.select(F.col("source").alias("_source"), *keep)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; all columns stay.

    Rows are found again by a 128-bit hash of all their columns, so only rows alike in everything take their
    repeats together, and the targets of the sources hold. Such twins are combined before they are repeated.
    """
    names = docs.columns
    cols = [F.col(f"`{c}`") for c in names]
    # Maps cannot be hashed; their JSON can.
    parts = [x for c, f in zip(cols, docs.schema.fields) for x in (c.isNull(), F.to_json(F.struct(c)) if _has_map(f.dataType) else c)]
    key = [F.xxhash64(F.lit(i), *parts).alias(k) for i, k in enumerate(("_ka", "_kb"))]
    own = lambda c: F.col(f"`{c}`").alias(c)
    times = mix(docs.select(own("doc_id"), own("text"), own("source"), *key), carry=("_ka", "_kb"), **options)
    each = materialise(times.groupBy("_ka", "_kb").agg(F.sum("epochs").alias("times"), F.count(F.lit(1)).alias("alike")), "mix-times")
    rows = docs.select(*key, F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).alias("row"))
    taken = rows.join(each.where("times > 0"), ["_ka", "_kb"])
    alone = taken.where("alike = 1").select("row", "times")
    alike = taken.where("alike > 1").groupBy("_ka", "_kb", "times").agg(F.any_value("row").alias("row")).select("row", "times")
    repeated = alone.unionByName(alike).select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return repeated.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return _has_map(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))
