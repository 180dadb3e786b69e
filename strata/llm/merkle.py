"""Document fingerprints by a Merkle tree.

A text is cut into sections (at blank lines), sections into paragraphs (lines)
and paragraphs into clauses (after a mark that is no letter or digit and a
blank; clauses over 48 code points every 32). The pieces put
together give the text again, so nothing is left out of the tree: a paragraph's
node is the SHA-256 of its text, a section's that of its paragraphs' nodes,
the root's that of its sections'. Equal roots mean equal texts. Below a
paragraph stand the 32-bit digests of its clauses. A fingerprint is the root, the
first 8 digits of each paragraph's node, and the clause digests by paragraph.
Likeness is read from two fingerprints: 1 for equal roots, otherwise the share
of distinct clause digests that both hold. Branches that differ locate an edit
(``differing_paragraphs``): a paragraph put in, taken out or changed is marked,
those it only moves along are not.

Scale: the next document in id order is found inside cells. A hashed choice of
places (id, text hash) in the table, one of every ``rows_per_cell`` and about
``max_cells`` at most, begins the cells, so they follow the rows and not the
numbers: ids far from all others, equal ids and null ids spread like any other.
The places are written once (a lost executor changes none) and travel as one
array of 16 bytes a cell, in which a row finds its cell by halving; a cell is
closed by a copy of the next cell's first document, the last by the first's.
One exchange moves the texts, and no task sees more than its cells.

Edge cases: a null text is the empty text, which has one empty clause; ids need
not be dense; equal ids are ordered by text hash; null ids come first; a single
document is its own next one; rows alike in id and text share a cell and follow
each other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, unused

SECTION = r"(?<=\n\n)(?=[^\n])"
PARAGRAPH = r"(?<=\n)(?=[^\n])"
CLAUSE = r"(?<=[^\p{L}\p{N}\x20\n][\x20\n])(?=[^\x20\n])"
LONG_CLAUSE, PIECE = 48, r"(?s)(?<=\G.{32})"
DIGEST = "[0-9a-f]{8}"


def clauses(text: Column) -> Column:
    """Digests of the clauses, 8 hexadecimal digits each; long ones count as pieces."""
    digest = lambda x: F.lpad(F.lower(F.hex(F.xxhash64(x).bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    pieces = lambda x: F.when(F.length(x) > LONG_CLAUSE, F.split(x, PIECE, -1)).otherwise(F.array(x))
    return F.flatten(F.transform(F.split(text, CLAUSE, -1), lambda x: F.transform(pieces(x), digest)))


def paragraphs(text: Column) -> Column:
    """The tree below the root: by section, its paragraphs' nodes and clause digests."""
    paragraph = lambda p: F.struct(F.sha2(p, 256).alias("node"), clauses(p).alias("leaves"))
    return F.transform(F.split(text, SECTION, -1), lambda s: F.transform(F.split(s, PARAGRAPH, -1), paragraph))


def section(s: Column) -> Column:
    """Node of a section."""
    return F.sha2(F.array_join(F.transform(s, lambda p: p["node"]), ""), 256)


def root(tree: Column) -> Column:
    return F.sha2(F.array_join(F.transform(tree, section), ""), 256)


def render(tree: Column) -> Column:
    """The fingerprint as text: root ; paragraph digests ; clause digests (``.`` between paragraphs, ``/`` between sections)."""
    level = lambda one: F.array_join(F.transform(tree, lambda s: F.array_join(F.transform(s, one), ".")), "/")
    return F.concat_ws(";", root(tree), level(lambda p: F.left(p["node"], F.lit(8))), level(lambda p: F.array_join(p["leaves"], "")))


def _once(value: Column, use) -> Column:
    """``use(value)``, the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint_of(text: Column) -> Column:
    return _once(paragraphs(F.coalesce(text, F.lit(""))), render)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    held = lambda f: F.regexp_extract_all(F.substring_index(f, ";", -1), F.lit(DIGEST), F.lit(0))
    share = lambda z: F.size(F.array_intersect(z["x"], z["y"])) / F.size(F.array_union(z["x"], z["y"]))
    return F.when(F.substring_index(a, ";", 1) == F.substring_index(b, ";", 1), 1.0).otherwise(
        _once(F.struct(held(a).alias("x"), held(b).alias("y")), share))


def fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text in column ``name`` (an earlier one of that name is replaced)."""
    return docs.withColumn(name, fingerprint_of(F.col(f"`{text_col}`")))


def differing_paragraphs(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, side, section, paragraph, node) of the paragraphs of texts ``a`` and ``b`` that the other
    text does not hold as often; places count from 0.

    Sections with equal nodes at one place are not looked into. The paragraphs
    of the others are grouped by node, so long texts cost their length, not its square."""
    (row,) = unused(pairs, "pair")
    tree = lambda c: paragraphs(F.coalesce(F.col(f"`{c}`"), F.lit("")))
    trees = materialise(pairs.select(F.monotonically_increasing_id().alias(row), F.col(f"`{key}`").alias("key"), tree(a).alias("a"), tree(b).alias("b")),
                        "merkle-pairs")
    nodes = trees.select(row, "key", "a", "b", F.transform("a", section).alias("na"), F.transform("b", section).alias("nb"))

    def places(side: str, own: str, other: str) -> DataFrame:
        sections = nodes.select(row, "key", F.posexplode(side).alias("section", "s"), own, other)
        sections = sections.where(~F.get(own, F.col("section")).eqNullSafe(F.get(other, F.col("section"))))
        return sections.select(row, "key", F.lit(side).alias("side"), "section", F.posexplode("s.node").alias("paragraph", "node"))

    both = places("a", "na", "nb").unionByName(places("b", "nb", "na"))
    nth = F.row_number().over(Window.partitionBy(row, "node", "side").orderBy("section", "paragraph"))
    one = both.withColumn("nth", nth).groupBy(row, "node", "nth").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "side", "section", "paragraph")).alias("at"))
    return one.where("n = 1").select(F.col("at.key").alias(key), "at.side", "at.section", "at.paragraph", "node")


def _begins(rows: DataFrame, rows_per_cell: int, max_cells: int) -> list[str]:
    """Sorted places at which cells begin, the first one of the table among them: (their number, JSON array)."""
    every = max(rows_per_cell, -(-rows.count() // max_cells))
    place = F.struct("doc_id", "h")
    chosen = F.when(F.pmod(F.xxhash64("doc_id", "h", F.lit("cell")), F.lit(every)) == 0, place)
    found = rows.agg(F.min(place).alias("first"), F.collect_set(chosen).alias("others"))
    begins = F.concat(F.array("first"), F.array_sort(F.filter("others", lambda x: x > F.col("first"))))
    return list(materialise(found.select(begins.alias("b")), "merkle-cells").select(F.size("b").cast("string"), F.to_json("b")).first())


def with_next(docs: DataFrame, rows_per_cell: int = 512, max_cells: int = 65536) -> DataFrame:
    """(doc_id, text, fingerprint) of every row with ``next_text`` and ``next_fingerprint`` of the row after it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    n, listed = _begins(rows, rows_per_cell, max_cells)
    begins = F.from_json(F.lit(listed), "array<struct<doc_id:bigint,h:bigint>>")
    # Number of begins up to the row's own place, by halving; the accumulator carries the place.
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(int(n).bit_length()))])
    found = lambda acc, half: F.struct(
        F.when(F.get(begins, acc["at"] + half - 1) <= acc["place"], acc["at"] + half).otherwise(acc["at"]).alias("at"), acc["place"].alias("place"))
    at = F.aggregate(halves, F.struct(F.lit(0).alias("at"), F.struct("doc_id", "h").alias("place")), found, lambda acc: acc["at"])
    rows = rows.withColumn("cell", at - 1)
    heads = rows.where(F.get(begins, F.col("cell")) == F.struct("doc_id", "h")).dropDuplicates(["cell"])
    marks = heads.withColumn("cell", F.pmod(F.col("cell") - 1, F.lit(int(n)))).withColumn("mark", F.lit(1))
    both = rows.withColumn("mark", F.lit(0)).unionByName(marks).repartition("cell")
    both = both.withColumn("fingerprint", fingerprint_of(F.col("text")))
    order = Window.partitionBy("cell").orderBy("mark", "doc_id", "h")
    return (both.withColumn("next_text", F.lead("text").over(order)).withColumn("next_fingerprint", F.lead("fingerprint").over(order))
            .where("mark = 0").drop("mark", "h", "cell"))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
