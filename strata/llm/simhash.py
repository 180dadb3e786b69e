"""SimHash near-duplicate detection.

Fingerprints: 64 bits from the XXH64 values (seed 42) of all word shingles; a
bit is 1 where over half of the values set it. Links: fingerprints at
``max_bits`` or fewer differing bits. Pairs are found by pigeonhole: the bits
are cut into ``blocks`` blocks, so a close pair agrees on at least
``blocks - max_bits`` of them; every choice of that many blocks is a join key
and the joined pairs are verified by their Hamming distance.

Scale: copies share a fingerprint, so everything after the fingerprints runs on
distinct fingerprints (a group of copies is one row). A block key shared by
more than ``bucket_limit`` distinct fingerprints is not paired; its members go
through an exact linear way instead (see ``_ball_links``), so no key emits more
than ``bucket_limit`` rows per member and no link is lost. Components come
from alternating star contractions, each round written to the shared folder.

Edge cases: a null or blank text has no shingle and the fingerprint zero, which
links like any other; fewer words than ``shingle`` give one shingle of all
words; repeated rows give repeated result rows; a null id is never the
smallest id of a component that has another; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

SEED = 42
BITS = 64
_CHUNK = 1 << 15


def simhash64(text: str | None, shingle: int) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    grams = zip(*(islice(words, i, None) for i in range(k)))
    total = np.zeros(BITS, np.int64)
    n = 0
    while chunk := [digest(b" ".join(g), SEED) for g in islice(grams, _CHUNK)]:
        hashes = np.array(chunk, dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
        n += len(chunk)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Column of signed 64-bit fingerprints (Arrow batches)."""

    @F.pandas_udf("long")
    def _fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash64(t, shingle) for t in texts], dtype="int64")

    return _fingerprint(text)


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _block_masks(blocks: int, keep: int) -> list[int]:
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(parts, keep)]


def _ball_links(members: DataFrame, max_bits: int) -> DataFrame:
    """All links among ``members`` (distinct fp) as stars, without pairing them.

    For an even bound 2t, two fingerprints are close exactly if their balls of
    radius t meet: each sends itself to every point of its ball, and all that
    meet at a point are within 2t of each other, so a star at the smallest is
    right. A point is reached by its own ball's size at most, which bounds the
    groups. For an odd bound the same holds with one bit (any) cleared first.
    """
    t, odd = divmod(max_bits, 2)
    flips = [_signed(sum(1 << b for b in bits)) for r in range(t + 1) for bits in combinations(range(BITS), r)]
    cleared = [(i, _signed((1 << BITS) - 1 - (1 << i))) for i in range(BITS)] if odd else [(-1, -1)]
    points = members.select("fp", F.explode(F.array([F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in cleared])).alias("c"))
    points = points.select("fp", "c.i", F.explode(F.array([F.lit(x) for x in flips])).alias("x"), F.col("c.m").alias("m"))
    points = points.select("fp", "i", F.col("fp").bitwiseAND(F.col("m")).bitwiseXOR(F.col("x").bitwiseAND(F.col("m"))).alias("p")).distinct()
    stars = points.groupBy("i", "p").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    return (stars.select(F.array_min("near").alias("b"), F.explode("near").alias("a"))
            .where("a <> b").select("a", "b").distinct())


def links(distinct_fps: DataFrame, max_bits: int = 2, blocks: int = 5, bucket_limit: int = 64) -> DataFrame:
    """(a, b): enough links among distinct ``fp`` that every pair at
    ``max_bits`` or fewer bits is connected; each link is such a pair."""
    masks = _block_masks(blocks, blocks - max_bits)
    keyed = distinct_fps.select("fp", F.posexplode(F.array([F.lit(m) for m in masks])).alias("c", "m"))
    keyed = keyed.select("fp", "c", F.col("fp").bitwiseAND(F.col("m")).alias("k"))
    sizes = keyed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialise(keyed.join(sizes, ["c", "k"]), "simhash-buckets")
    small = members.where(F.col("n") <= bucket_limit)
    x, y = small.alias("x"), small.alias("y")
    close = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits
    pairs = x.join(y, (F.col("x.c") == F.col("y.c")) & (F.col("x.k") == F.col("y.k")) & (F.col("x.fp") < F.col("y.fp")) & close)
    found = pairs.select(F.col("y.fp").alias("a"), F.col("x.fp").alias("b"))
    large = members.where(F.col("n") > bucket_limit).select("fp").distinct()
    return found.unionByName(_ball_links(large, max_bits)).distinct()


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links (a, b); root: the smallest node reachable.

    Alternates large-star and small-star contraction until nothing changes:
    O(log^2) rounds also for long chains. Each round is written out.
    """
    def mark(df):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    def contract(df, both_ways):
        near = df.select("a", "b")
        if both_ways:  # neighbours on either side; the larger ones move to the smallest
            near = near.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")) if both_ways else \
            near.groupBy("a").agg(F.min("b").alias("m"))
        moved = near.join(least, "a")
        if both_ways:
            return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(moved.select("a", F.col("m").alias("b")))
        return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    current = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    seen = mark(current)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        current = materialise(contract(contract(current, True), False), "links")
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def fingerprint_groups(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, root) for every distinct ``fp`` of ``fps``; root names its component."""
    distinct_fps = materialise(fps.select("fp").distinct(), "simhash-distinct")
    joined = star_components(links(distinct_fps, max_bits))
    return distinct_fps.join(joined, distinct_fps["fp"] == joined["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) per row; component_id: the smallest id reachable over links, itself included."""
    fps = materialise(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash-docs")
    groups = materialise(fingerprint_groups(fps, max_bits), "simhash-groups")
    first = fps.groupBy("fp").agg(F.min("id").alias("id")).join(groups, "fp")
    least = first.groupBy("root").agg(F.min("id").alias("component_id"))
    named = groups.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), hex16(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """One row of each component: smallest id (null last), then smallest fingerprint; all columns stay.

    Rows alike in id and fingerprint leave one of them. The join key holds the
    id, so the texts of a large group of copies are spread by their ids.
    """
    cols = docs.columns
    key = [F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_sid"), F.col(id_col).isNull().alias("_null"),
           fingerprint(F.col(text_col), shingle).alias("_fp")]
    marked = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]).alias("row"), *key)
    fps = materialise(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash-docs")
    groups = fingerprint_groups(fps, max_bits)
    order = F.struct(F.col("id").isNull().alias("z"), F.col("id"), F.col("fp"))
    kept = (fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("z"), F.col("id"))).alias("o"))
            .select("fp", "o.id").join(groups, "fp").groupBy("root").agg(F.min(order).alias("o"))
            .select(F.coalesce(F.col("o.id").cast("string"), F.lit("")).alias("_sid"), F.col("o.z").alias("_null"), F.col("o.fp").alias("_fp")))
    kept = materialise(kept, "simhash-kept")
    return (marked.join(kept, ["_sid", "_null", "_fp"], "left_semi")
            .dropDuplicates(["_sid", "_null", "_fp"]).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(cols)]))
