"""Merkle manifest of a dataset, with an inclusion proof for every row.

Rows are leaves. Within a group (a source) leaves stand in key order; while
several nodes remain, runs of three consecutive ones become their parent. The
groups' last nodes, in group order, are the leaves of one more tree of the
same kind, whose last node is the root.

Proofs come from pointer jumping. Every inner node starts with a pointer to its
parent and the segment of its siblings there. A round joins the nodes with
themselves: a node takes over the pointer of the node it points to and appends
that one's segment, which doubles the distance, so trees of height h need
log2(h) rounds. When all inner nodes have reached the root, each leaf is joined
once with its parent's whole path.

Scale: texts are hashed in the scan and never shuffled. Positions come from a
range partitioning by (group, key) and one count per partition, so a group
with a third of the rows is spread over many tasks. Trees are built in blocks of
3^6 nodes (one shuffle for six levels; a block holds at most 729 digests). In a
round whose pointers span d levels at most 3^d nodes share a target; the
targets are broadcast only if counted to be few, and otherwise they
are so many that none is hot. All intermediate tables are written to the shared
scratch folder, so a lost executor costs its tasks only.

Edge cases: null values count as ``-`` in a leaf; null groups and keys come
first; rows of one key stand in the order of their leaves, so rows alike in
every column are neighbours (each with its own proof); a single row is root,
subroot and leaf in one, with an empty proof; an empty table gives no rows;
all columns of a row are
kept as a struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.operators.dimension import dense_index
from strata.operators.joins import bounded_broadcast

FANOUT = 3
BLOCK_LEVELS = 6
BLOCK = FANOUT ** BLOCK_LEVELS
BROADCAST_TARGETS = 20_000  # rows; a path has at most 2 KB per 16 levels

# A segment is an array with one text per level: the siblings' digests in hex with a
# dot in the node's own place. A group's last node stands between the two trees as "#" + digest.
OWN, LAST = ".", "#"

# Node numbers: level, then the place in the whole table (a group's nodes of a level
# stand from its first row on, so groups never meet). The tree over the groups has levels of its own.
_PLACE_BITS, _TOP = 50, 64


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: per value ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _height(leaves: Column) -> Column:
    """Levels above the leaves: how many powers of the fan-out are less than their number."""
    return sum((F.lit(FANOUT ** j) < leaves).cast("int") for j in range(32))


def _node(level: Column, place: Column) -> Column:
    return F.shiftleft(level.cast("long"), _PLACE_BITS).bitwiseOR(place)


def _positions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (_row, _group, _key, digest) with their place in the whole table (``_at``, from 0, by group, key and
    digest), their group's first place (``_first``), number of rows (``_n``) and rank (``_rank``, from 0); and the groups."""
    marked = rows.withColumns({"_g": F.col("_group").isNotNull(), "_k": F.col("_key").isNotNull()})  # nulls come first
    placed = dense_index(marked, ["_g", "_group", "_k", "_key", "digest"], "_at").withColumn("_at", F.col("_at") - 1)
    groups = placed.groupBy(F.col("_group").alias("_of")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = dense_index(groups, ["_first"], "_rank").withColumn("_rank", F.col("_rank") - 1)
    groups = materialise(groups, "manifest-groups")
    few = bounded_broadcast(groups, BROADCAST_TARGETS)
    return placed.join(few, F.col("_group").eqNullSafe(F.col("_of"))).drop("_of", "_group", "_key", "_g", "_k"), groups


def _levels_of_block(digests: Column, levels: Column) -> Column:
    """The levels of a block from its lowest digests up: ``levels`` + 1 arrays."""
    def above(level: Column) -> Column:
        runs = F.ceil(F.size(level) / FANOUT).cast("int")
        return F.transform(F.sequence(F.lit(0), runs - 1),
                           lambda j: F.sha2(F.array_join(F.slice(level, j * FANOUT + 1, FANOUT), "").cast("binary"), 256))

    steps = F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.expr("array()").cast("array<int>"))
    return F.aggregate(steps, F.array(digests), lambda built, _: F.concat(built, F.array(above(F.element_at(built, -1)))))


def _segments(level: Column, up: Column) -> Column:
    """For each node of a level: the level, its place, and its run with a dot in its own place."""
    def one(j: Column) -> Column:
        begin = j - j % FANOUT
        run = F.transform(F.slice(level, begin + 1, FANOUT), lambda d, k: F.when(begin + k == j, F.lit(OWN)).otherwise(d))
        return F.struct(up.alias("_up"), j.alias("_j"), F.array(F.array_join(run, "")).alias("seg"))

    return F.transform(level, lambda _, j: one(j))


def _tree(nodes: DataFrame, top: bool) -> tuple[list[DataFrame], DataFrame]:
    """Nodes below the last ones, with pointer and segment, as one table per block of levels,
    and the last node of each tree. ``nodes`` are the leaves: _first, _n, _rank, _i (place in the tree) and digest."""
    built, last = [], []
    height, base, lift = _height(F.col("_n")), 0, _TOP if top else 0
    tree = ["_first", "_n", "_rank"]
    while True:
        levels = F.least(height - base, F.lit(BLOCK_LEVELS))
        block = nodes.groupBy(*tree, F.floor(F.col("_i") / BLOCK).alias("_block")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_i", "digest"))), lambda x: x["digest"]).alias("_low"))
        block = block.withColumn("_levels", levels).withColumn("_built", _levels_of_block(F.col("_low"), F.col("_levels")))
        block = materialise(block.drop("_low"), f"manifest-block-{lift + base}")
        below = F.flatten(F.transform(F.slice("_built", F.lit(1), F.col("_levels")), _segments))
        inner = block.select(*tree, "_block", F.inline(below))
        scale = F.element_at(F.array(*[F.lit(FANOUT ** (BLOCK_LEVELS - u)) for u in range(BLOCK_LEVELS)]), F.col("_up") + 1)
        place = F.col("_block") * scale + F.col("_j")
        level, parent = F.col("_up") + base, F.floor(place / FANOUT)
        pointer = _node(level + 1 + lift, F.col("_first") + parent)
        built.append(inner.select(
            _node(level + lift, F.col("_first") + place).alias("id"), (level + lift).alias("level"),
            (F.when(level + 1 < height, pointer) if top else pointer).alias("ptr"), "seg"))
        ended = F.element_at(F.element_at("_built", -1), 1).alias("digest")
        last.append(block.where(height <= base + BLOCK_LEVELS).select(*tree, ended))
        more = block.where(height > base + BLOCK_LEVELS)
        if more.isEmpty():
            break
        nodes = more.select(*tree, F.col("_block").alias("_i"), ended)
        base += BLOCK_LEVELS
    return built, reduce(DataFrame.unionByName, last)


def _jump(nodes: DataFrame, hops: int) -> DataFrame:
    """Pointer jumping: after the rounds every node's segment goes up to the root."""
    distance, n = 1, 0
    while distance < hops:
        reach = nodes.where(F.col("level") >= distance).select(
            F.col("id").alias("_to"), F.col("ptr").alias("_ptr"), F.col("seg").alias("_seg"))
        far = nodes.join(bounded_broadcast(reach, BROADCAST_TARGETS), F.col("ptr") == F.col("_to"), "left")
        # A node whose pointer is null has reached the root; the others find their target.
        far = far.select("id", "level", F.col("_ptr").alias("ptr"),
                         F.when(F.col("_to").isNull(), F.col("seg")).otherwise(F.concat("seg", "_seg")).alias("seg"))
        nodes = materialise(far, f"manifest-jump-{n}")
        distance, n = distance * 2, n + 1
    return nodes


def _span(leaves: int) -> int:
    return sum(FANOUT ** j < leaves for j in range(32))


def manifest(rows: DataFrame, group: Column, key: Column, leaf: Column) -> tuple[DataFrame, str | None]:
    """Every row as ``row`` (a struct of its columns), its ``leaf`` and its ``path`` (the segments from the leaf to
    the root); and the root's digest (None for an empty table)."""
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), group.alias("_group"), key.alias("_key"), leaf.alias("digest"))
    placed, table = _positions(rows)
    tops = table.agg(F.max("_n").alias("n"), F.max("_rank").alias("rank")).first()
    if tops["n"] is None:
        return rows.select(F.col("_row").alias("row"), F.col("digest").alias("leaf"), F.array().cast("array<string>").alias("path")), None
    groups = tops["rank"] + 1
    parts, lasts = _tree(placed.select("_first", "_n", "_rank", (F.col("_at") - F.col("_first")).alias("_i"), "digest"), top=False)
    lasts = materialise(lasts, "manifest-last")
    none = F.lit(0).cast("long")
    top_parts, root = _tree(lasts.select(none.alias("_first"), F.lit(groups).cast("long").alias("_n"), none.alias("_rank"),
                                         F.col("_rank").alias("_i"), "digest"), top=True)
    # From a group's last node into the tree over the groups.
    height = _height(F.col("_n"))
    into = _node(F.lit(_TOP), F.col("_rank")) if groups > 1 else F.lit(None).cast("long")
    hop = lasts.select(_node(height, F.col("_first")).alias("id"), height.alias("level"), into.alias("ptr"),
                       F.array(F.concat(F.lit(LAST), "digest")).alias("seg"))
    nodes = reduce(DataFrame.unionByName, [hop, parts[0].where("level > 0"), *parts[1:], *top_parts])
    nodes = _jump(materialise(nodes, "manifest-nodes"), _span(tops["n"]) + 1 + _span(groups))
    # Leaves take the path of their parent; the row of a group of one stands at the group's last node itself.
    own = parts[0].where("level = 0").select(F.col("id").alias("_at"), F.col("ptr").alias("_up"), F.col("seg").alias("_own"))
    above = nodes.where("level <= 1").select(F.col("id").alias("_above"), F.col("seg").alias("_rest"))
    found = placed.select("_row", "digest", "_at").join(own, "_at", "left").join(above, F.coalesce("_up", "_at") == F.col("_above"), "left")
    path = F.concat(F.coalesce("_own", F.array().cast("array<string>")), F.col("_rest"))
    return found.select(F.col("_row").alias("row"), F.col("digest").alias("leaf"), path.alias("path")), root.first()["digest"]


def siblings(path: Column) -> Column:
    """All sibling digests of a path, joined, level by level, left to right."""
    return F.replace(F.array_join(F.filter(path, lambda s: ~F.startswith(s, F.lit(LAST))), ""), F.lit(OWN), F.lit(""))


def subroot(path: Column) -> Column:
    """The last digest of the row's group."""
    return F.substring(F.filter(path, lambda s: F.startswith(s, F.lit(LAST)))[0], 2, 64)


def fold(path: Column, own: Column) -> Column:
    """The root that a leaf ``own`` and the siblings of ``path`` give."""
    steps = F.filter(path, lambda s: ~F.startswith(s, F.lit(LAST)))
    return F.aggregate(steps, own, lambda digest, s: F.sha2(F.replace(s, F.lit(OWN), digest).cast("binary"), 256))
