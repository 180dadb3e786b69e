"""Dataset manifest against trees and proofs built in plain Python."""

import hashlib
import random
import zlib

import pytest

from strata.llm import manifest
from strata.llm.queries import manifest_proofs

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(leaves):
    built = [leaves]
    while len(built[-1]) > 1:
        built.append([digest("".join(built[-1][i:i + 3])) for i in range(0, len(built[-1]), 3)])
    return built


def siblings(tree, i):
    found = []
    for level in tree[:-1]:
        begin = i - i % 3
        found.append(("".join(level[begin:i]), "".join(level[i + 1:begin + 3])))
        i //= 3
    return found


def proofs(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[3], []).append(d)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        rows = sorted(((leaf(*d), d) for d in groups[source]), key=lambda r: (r[1][0] is not None, r[1][0] or 0, r[0]))
        trees.append((rows, levels([r[0] for r in rows])))
    top = levels([tree[-1][0] for _, tree in trees]) if trees else []
    out = []
    for k, (rows, tree) in enumerate(trees):
        for i, (own, d) in enumerate(rows):
            path = siblings(tree, i) + siblings(top, k)
            folded = own
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0 and d[1] is not None:
                folded = leaf(d[0], d[1].replace("\n", ""), *d[2:])
            for left, right in path:
                folded = digest(left + folded + right)
            out.append((d[0], own, tree[-1][0], top[-1][0], digest("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in manifest_proofs(df).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [1, 1, 1, 1], [730, 1, 27, 28], [2200, 3]])
def test_proofs_of_trees_of_all_shapes(spark, sizes):
    docs = [(s * 10_000 + i, f"text {i}\n of\n{s}", "en", None if s == 1 else f"src{s}é", i) for s, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(docs)
    assert got(spark.createDataFrame(docs, SCHEMA)) == proofs(docs)


def test_nulls_ties_and_many_groups(spark):
    rng = random.Random(4)
    docs = [(rng.choice([None, i, i % 7, -i]), rng.choice([None, "", "a\nb", "é" * 50_000 + "\n", f"t{i}"]), rng.choice([None, "de"]),
             rng.choice([None, "", "ä", "z", "Z", "\U0001f600", "￮", f"s{i}"]), rng.choice([None, i])) for i in range(400)]
    docs += docs[:20]  # repeated rows
    assert got(spark.createDataFrame(docs, SCHEMA)) == proofs(docs)


def test_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BROADCAST_TARGETS", 0)
    docs = [(i, f"text {i}\n", "en", f"s{i % 4}", i) for i in range(300)]
    assert got(spark.createDataFrame(docs, SCHEMA)) == proofs(docs)


def test_empty_table_and_clashing_names(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    docs = [(i, f"text {i}\n", "en", f"s{i % 2}", i) for i in range(9)]
    from pyspark.sql import functions as F
    wide = spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit(1) for c in ("_at", "_row", "path", "row", "leaf", "digest", "_n", "a.b")})
    proved, root = manifest.manifest(wide, F.col("source"), F.col("doc_id"), F.sha2("text", 256))
    assert root is not None and set(proved.first().row.asDict()) == set(wide.columns)
    assert got(wide.select(*COLUMNS)) == proofs(docs)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_the_table(spark, sf):
    from strata.llm.queries import QUERIES
    path = f"/root/testdata/{sf}"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select(*COLUMNS).collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_manifest"](spark, path).collect()), key=str) == proofs(docs)
