"""Small tests of the training-data operators: edge cases, brute force, round trips."""

import base64
import hashlib
import os
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import chat, decontam, line_dedup, lm, merkle, mixing, secret_scan, sharding, simhash, toxicity
from strata.llm.queries import ORACLE, QUERIES

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, fp string, rid string"


def docs_of(spark, rows):
    """(doc_id, text, source) rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", "z", "q") for i, t, s in rows], SCHEMA)


LONG = " ".join(f"word{i}, and{i % 7}" for i in range(30_000))
ODD = [(1, None, "a"), (2, "", None), (3, "   \n\t ", "a"), (4, LONG, "b"), (5, "one", "a"), (6, "one two", None), (None, "one two", "c"),
       (7, "same text here again", "a"), (7, "same text here again", "a"), (8, "same text here again", "b"), (9, "émile Ünder 日本 語", "c")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- mixing ---------------------------------------------------------------

def brute_targets(sizes, weights, cap):
    total, over = sum(sizes), set()
    while True:
        free = sum(w for i, w in enumerate(weights) if i not in over)
        left = total - sum(cap * sizes[i] for i in over)
        now = over | {i for i, w in enumerate(weights) if i not in over and w * left / free > cap * sizes[i]}
        if now == over:
            return [cap * sizes[i] if i in over else weights[i] * left / free for i in range(len(sizes))]
        over = now


def test_mix_targets_and_takes(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), f"s{i % 5}" if i % 11 else None) for i in range(600)]
    rows += [(1000 + i, "tiny text", "zz") for i in range(2)]
    out = [r.asDict() for r in mixing.mix(docs_of(spark, rows)).collect()]
    assert len(out) == len(rows)
    names = sorted({s for _, _, s in rows if s}) + [None]
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    want = dict(zip(names, brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 3)))
    for n, size in zip(names, sizes):
        mine = [r for r in out if r["source"] == n]
        assert {r["source_size"] for r in mine} == {size}
        assert mine[0]["target"] == pytest.approx(want[n])
        assert abs(sum(r["taken"] for r in mine) - want[n]) <= max(r["size"] for r in mine)
        assert max(r["epochs"] for r in mine) - min(r["epochs"] for r in mine if r["size"]) <= 1
    assert all(r["taken"] <= 3 * r["size"] for r in out)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs_of(spark, rows[::-1]), bucket_rows=50).collect()}
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(docs_of(spark, rows), bucket_rows=50).collect()} == again


def test_mix_edge_rows(odd, empty):
    assert mixing.mix(odd).count() == len(ODD)
    assert mixing.mix(empty).count() == 0
    repeated = mixing.mixed_documents(odd)
    assert repeated.columns == odd.columns
    assert repeated.count() == mixing.mix(odd).agg(F.sum("epochs")).first()[0]


def test_takes_do_not_depend_on_the_cuts(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)) + " 123456" * (i % 4), f"s{i % 3}") for i in range(900)]
    docs = docs_of(spark, rows)
    takes = [sorted((r["doc_id"], r["taken"]) for r in mixing.mix(docs, bucket_rows=n).collect()) for n in (1, 7, 100_000)]
    assert takes[0] == takes[1] == takes[2]


def test_mixed_rows_keep_their_sources_targets(spark):
    rows = [(7, "three plain words", s) for s in "ab" * 40] + [(i, f"some text {i}", "c") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumns({c: F.lit(5) for c in ("_n", "_i", "_times", "_alike", "_at", "_rk", "_rc", "rid", "row", "of", "epochs", "_key", "_bucket")})
    want = {r["source"]: r["n"] for r in mixing.mix(docs).groupBy("source").agg(F.sum("epochs").alias("n")).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {r["source"]: r["count"] for r in out.groupBy("source").count().collect()} == {s: n for s, n in want.items() if n}
    assert {tuple(r)[3:] for r in out.distinct().collect()} == {(5,) * 13}
    maps = mixing.mixed_documents(docs.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))))
    assert maps.count() == out.count() and maps.columns[-1] == "m"
    one, two = (sorted(map(tuple, mixing.mixed_documents(docs).collect())) for _ in range(2))
    assert one == two


def test_quality_favours_documents(spark):
    rows = [(i, "w " * 10, "a") for i in range(400)] + [(5000, "w " * 4000, "b")]
    low = F.when(F.col("doc_id") % 2 == 0, 0.1).otherwise(1.0)
    out = mixing.mix(docs_of(spark, rows), weights=(1, 3), quality=low).where("source = 'a' and taken > 0").collect()
    odd_share = sum(r["doc_id"] % 2 for r in out) / max(1, len(out))
    assert odd_share > 0.7


# --- sharding ---------------------------------------------------------------

def test_shards_are_gapless_and_stable(spark, odd, empty):
    rows = [(i, f"text {i % 40} " * (i % 9), "a") for i in range(500)]
    docs = docs_of(spark, rows).drop("shard")
    out = sharding.shard(docs, n_shards=5, bucket_bytes=300).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted((i, t) for i, t, _ in rows)
    for k in range(5):
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(sum(r["shard"] == k for r in out)))
    grown = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, n_shards=6).collect()}
    assert all(grown[r["doc_id"]] == r["grown_shard"] and r["grown_shard"] in (r["shard"], 5) for r in out)
    assert sorted(map(tuple, sharding.shard(docs, n_shards=5, bucket_bytes=300).collect())) == sorted(map(tuple, out))
    assert sharding.shard(odd.drop("shard")).count() == len(ODD)
    assert sharding.shard(empty.drop("shard")).count() == 0


def brute_rendezvous(spark, ids, n, seed=23):
    """The shard of each id by comparing all hashes one by one."""
    pairs = spark.createDataFrame([(i, k) for i in ids for k in range(n)], "i long, k int")
    bids = pairs.select("i", "k", F.xxhash64(F.lit(seed), "i", "k").alias("h")).collect()
    return {i: max((b for b in bids if b["i"] == i), key=lambda b: (b["h"], b["k"]))["k"] for i in ids}


def test_shards_of_any_columns(spark):
    docs = spark.createDataFrame([(i % 30, f"text {i % 30}", {"a": i}, f"s{i}") for i in range(90)], "doc_id long, text string, m map<string,int>, Shard string")
    docs = docs.withColumns({"slot": F.lit("mine"), "bin": F.lit(1), "_h": F.lit(2), "rows": F.lit(3), "first": F.lit(4)})
    out = sharding.shard(docs, n_shards=4, bucket_bytes=60)
    assert out.columns == ["doc_id", "text", "m", "bin", "_h", "rows", "first", "shard", "slot", "grown_shard"]
    rows = out.collect()
    assert sorted((r["doc_id"], r["m"]["a"]) for r in rows) == sorted((i % 30, i) for i in range(90))
    assert {r["doc_id"]: r["shard"] for r in rows} == brute_rendezvous(spark, range(30), 4)
    assert {r["doc_id"]: r["grown_shard"] for r in rows} == brute_rendezvous(spark, range(30), 5)
    for k in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sum(r["shard"] == k for r in rows)))
    named = sharding.shard(docs, n_shards=4, names=("part", "place", "more"))
    assert named.columns == [*docs.columns, "part", "place", "more"] and {r["slot"] for r in named.collect()} == {"mine"}


# --- SimHash ----------------------------------------------------------------

def brute_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hs = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark, odd, empty):
    out = {(r["doc_id"], r["fingerprint"]) for r in simhash.near_duplicates(odd).collect()}
    assert out == {(i, f"{brute_simhash(t):016x}") for i, t, _ in ODD}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 7, 9]


@pytest.mark.parametrize("limit", [1, 4, 64])
def test_links_lose_nothing_when_buckets_are_full(spark, limit):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    fps = sorted({b ^ sum(1 << int(k) for k in rng.integers(0, 64, n)) for b in base for n in (0, 1, 1, 2, 2, 3, 4, 5)})
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(signed.index(r["a"]), signed.index(r["b"])) for r in simhash.links(df, bucket_limit=limit).collect()]
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 2 for a, b in edges)
    got = {r["node"]: r["root"] for r in simhash.star_components(simhash.links(df, bucket_limit=limit)).collect()}
    want = brute_components(fps)
    same = {}
    for i, x in enumerate(signed):
        assert same.setdefault(want[i], got.get(x, x)) == got.get(x, x)
    assert len(set(same.values())) == len(same)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "a long, b long")
    assert {r["root"] for r in simhash.star_components(edges).collect()} == {0}


# --- decontamination ----------------------------------------------------------

ITEM = "Last spring the farmer Anselm sold 45 crates of pears for 3 dollars each, how much did the farmer earn in the end?"


def test_reparameterised_items_are_found(spark, empty):
    bench = spark.createDataFrame([(1, ITEM), (2, "a short item"), (3, None), (4, "")], "item_id long, text string")
    other = ITEM.replace("45", "120").replace("Anselm", "Brigitte").replace(" 3 ", " 7 ")
    rows = [(1, f"Intro words. {ITEM} And more text follows here.", "a"), (2, f"Some lines before it. {other} After.", "a"),
            (3, "Nothing of the kind is written in this clean text about pears and farmers.", "a"), (4, None, "a"), (5, "", "a"),
            (6, "Here is a short item indeed", "a"), (None, f"{other}", "a")]
    found = {(r["doc_id"], r["item_id"]): r["exact"] for r in decontam.contaminated(docs_of(spark, rows), bench).collect()}
    assert found == {(1, 1): True, (2, 1): False, (6, 2): True, (None, 1): False}
    unfiltered = decontam.contaminated(docs_of(spark, rows), bench, max_index=0).collect()
    assert {(r["doc_id"], r["item_id"]): r["exact"] for r in unfiltered} == found
    kept = decontam.drop_contaminated(docs_of(spark, rows), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]
    assert decontam.contaminated(empty, bench).count() == 0
    assert decontam.contaminated(docs_of(spark, rows), bench.where("false")).count() == 0


def test_inconsistent_slots_are_no_match(spark):
    item = "add 5 to the box then take 5 from the box and write 5 on the lid of the box"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    mixed = "add 6 to the box then take 7 from the box and write 8 on the lid of the box"
    same = item.replace("5", "9")
    out = decontam.contaminated(docs_of(spark, [(1, mixed, "a"), (2, same, "a")]), bench).collect()
    assert [r["doc_id"] for r in out] == [2]


def test_one_changed_name_vetoes_no_verbatim_windows(spark):
    words = [f"plain{i}" for i in range(100)]
    for i in (20, 50, 56):
        words[i] = "Anna"
    copy = words[:50] + ["Ana"] + words[51:]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = docs_of(spark, [(1, "Some words before it. " + " ".join(copy), "a"), (2, "nothing of it", "a")])
    found = decontam.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["exact"]) for r in found] == [(1, 1, False)] and found[0]["run_tokens"] >= 43
    assert [r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()] == [2]


@pytest.mark.parametrize("max_index", [0, 4_000_000])
def test_verbatim_copies_are_found_whatever_their_slots(spark, max_index):
    caps = "WHICH RIVER RUNS THROUGH THE OLD CITY OF PRAGUE AND ENDS IN THE ELBE NEAR MELNIK"
    numbers = "12 15 sum 27 and 30 41 sum 71 and 8 9 sum 17 and 100 3 sum 103"
    bench = spark.createDataFrame([(1, caps), (2, numbers), (3, "What is the capital of France?"), (4, ITEM)], "item_id long, text string")
    other = ITEM.replace("45", "120").replace("Anselm", "Brigitte").replace(" 3 ", " 7 ")
    rows = [(1, f"so asked: {caps} and so on", "a"), (2, f"rows are {numbers} in all", "a"), (3, "Question: What is the capital of France?", "a"),
            (4, "Question: What is the weather of France today in April?", "a"), (5, numbers.replace("7", "8").replace("1", "2"), "a"),
            (6, f"Some words before it. {other} After.", "a")]
    found = {(r["doc_id"], r["item_id"]): (r["exact"], r["coverage"]) for r in
             decontam.contaminated(docs_of(spark, rows), bench, max_index=max_index).collect()}
    assert found == {(1, 1): (True, 1.0), (2, 2): (True, 1.0), (3, 3): (True, 1.0), (5, 2): (False, 1.0), (6, 4): (False, 1.0)}


STEM = "which of the following statements is the correct answer to this"


@pytest.mark.parametrize("max_index", [0, 4_000_000])
def test_common_stems_make_no_pairs(spark, max_index):
    bench = spark.createDataFrame([(i, f"{STEM} topic{i} thing{i}") for i in range(300)], "item_id long, text string")
    stems = [(i, f"Some talk. {STEM} other{i} matter{i} of note", "a") for i in range(300)]
    copies = [(1000 + i, f"Before it. {STEM} topic{i} thing{i} and after", "a") for i in range(0, 300, 50)]
    found = decontam.contaminated(docs_of(spark, stems + copies), bench, max_index=max_index).collect()
    assert sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in found) == [(1000 + i, i, 1.0) for i in range(0, 300, 50)]


@pytest.mark.parametrize("max_index", [0, 4_000_000])
def test_copies_with_shared_windows_only_are_found(spark, max_index):
    words = lambda tag, n: " ".join(f"{tag}{chr(97 + j)}" for j in range(n))
    middle, stem = words("mid", 12), words("stem", 14)
    # Every window of an item a-middle-b is in ten items or more; items 900.. share a stem of 14 words; item 500 is a part of these.
    items = [(10 * a + b, f"{words(f'a{a}', 4)} {middle} {words(f'b{b}', 4)}") for a in range(10) for b in range(10)]
    items += [(900 + i, f"{stem} topic{i} thing{i} matter{i}") for i in range(20)] + [(500, " ".join(stem.split()[2:12]))]
    texts = dict(items)
    docs = [(1, texts[37]), (2, f"so {stem} and"), (3, f"then {' '.join(stem.split()[2:12])} and"), (4, f"then {' '.join(stem.split()[3:13])} on"),
            (5, " ".join(stem.split()[2:9])), (6, "nothing of it at all in these few words"), (7, texts[37])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contaminated(docs_of(spark, [(d, t, "a") for d, t in docs]), bench, max_index=max_index).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    brute = brute_contaminated(docs, items)
    # Short stretches that more than eight items share are no hit of the items that have something of their own.
    assert pairs == {(d, i) for d, i in brute if i == 500 or d not in (3, 4)}
    assert {(1, 37), (7, 37), (2, 900), (2, 919), (2, 500), (3, 500), (4, 500)} <= pairs and not {5, 6} & {d for d, _ in pairs}
    assert {r["coverage"] for r in found if (r["doc_id"], r["item_id"]) in {(1, 37), (3, 500)}} == {1.0}


def test_copies_of_a_passage_are_one_passage(spark):
    spaced = [(i, ITEM.replace(" ", " " * (i + 1))) for i in range(12)]
    bench = spark.createDataFrame(spaced + [(50, f"({ITEM})")], "item_id long, text string")
    other = ITEM.replace("45", "120").replace("Anselm", "Brigitte").replace(" 3 ", " 7 ")
    found = decontam.contaminated(docs_of(spark, [(1, f"Before it. {ITEM}", "a"), (2, f"Before it. {other}", "a")]), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, i) for d in (1, 2) for i in (*range(12), 50)}


def test_items_of_one_form_are_found_verbatim(spark):
    form = "Then the keeper of the old house sold {} barrels to {} for {} coins and {} jars of the best honey in town"
    bench = spark.createDataFrame([(i, form.format(i + 3, f"Anna{i}", i + 50, i + 90)) for i in range(40)], "item_id long, text string")
    docs = [(1, "Listen. " + form.format(10, "Anna7", 57, 97), "a"), (2, "Listen. " + form.format(999, "Bert", 888, 777), "a")]
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs_of(spark, docs), bench).collect()}
    assert (1, 7) in found and all(d == 1 for d, _ in found)
    few = decontam.contaminated(docs_of(spark, docs), bench.where("item_id = 7")).collect()
    assert {r["doc_id"] for r in few} == {1, 2}  # of a single item another set of values is a copy


def brute_contaminated(docs, items, width=8, coverage=0.5, run=13):
    """Pairs whose plain lower-cased windows agree, for texts without numbers and names."""
    split = lambda t: [w.strip(decontam._OUTER).lower() for w in t.split()]
    grams = lambda ws, w: [tuple(ws[i:i + w]) for i in range(len(ws) - w + 1)]
    out = set()
    for i, item in items:
        own = split(item)
        w = min(width, len(own))
        want = grams(own, w)
        for d, text in docs:
            have = set(grams(split(text), w))
            hit = [g in have for g in want]
            longest, n = 0, 0
            for h in hit:
                n = n + 1 if h else 0
                longest = max(longest, n)
            if want and any(hit) and (sum(hit) / len(want) >= coverage or longest + w - 1 >= run):
                out.add((d, i))
    return out


def test_decontamination_matches_brute_force_on_plain_texts(spark):
    rng = np.random.default_rng(8)
    word = lambda: f"w{'abcdefghij'[rng.integers(10)]}{'klmnopqrst'[rng.integers(10)]}"
    items = [(i, " ".join(word() for _ in range(rng.integers(3, 40)))) for i in range(60)]
    docs = []
    for d in range(200):
        words = [word() for _ in range(rng.integers(0, 60))]
        for _ in range(rng.integers(0, 3)):  # stretches of items, in part
            own = items[rng.integers(60)][1].split()
            a = rng.integers(len(own))
            b = a + rng.integers(1, 30)
            at = rng.integers(len(words) + 1)
            words[at:at] = own[a:b]
        docs.append((d, " ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs_of(spark, [(d, t, "a") for d, t in docs]), bench).collect()}
    assert found == brute_contaminated(docs, items)


def test_every_benchmark_passage_is_searched(spark):
    passages = [f"{w} one plain line about {w} and the long way home to {w}" for w in ("apples", "bridges", "candles", "doors")]
    big = (1 << 62) + 1
    bench = spark.createDataFrame([(0, passages[0]), (0, passages[1]), (None, passages[2]), (None, passages[3]), (big, passages[3]), (0, passages[0])],
                                  "item_id long, text string")
    docs = docs_of(spark, [(i, f"before it. {t}", "a") for i, t in enumerate(passages)])
    found = sorted(((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()), key=str)
    assert found == [(0, 0), (1, 0), (2, None), (3, big), (3, None)]
    assert decontam.drop_contaminated(docs, bench).count() == 0


# --- toxicity -----------------------------------------------------------------

def brute_segments(scores):
    """Maximal segments by their definition: best positive segment, then both sides."""
    def cut(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 1e-12:
            return []
        return cut(a, best[3]) + [(best[3], best[4])] + cut(best[4], b)
    return cut(0, len(scores))


def maximal_by_growth(scores):
    """The same as a recursion over prefix sums, for longer texts."""
    sums = np.concatenate(([0.0], np.cumsum(scores)))

    def cut(a, b):
        best, low, at = (1e-12, None, None), sums[a], a
        for j in range(a + 1, b + 1):
            if sums[j] - low > best[0]:
                best = (sums[j] - low, at, j)
            if sums[j] <= low:
                low, at = sums[j], j
        return [] if best[1] is None else cut(a, best[1]) + [best[1:]] + cut(best[2], b)
    return cut(0, len(scores))


def test_maximal_segments_match_definition():
    rng = np.random.default_rng(1)
    for _ in range(150):
        scores = np.where(rng.random(14) < 0.4, rng.integers(1, 6, 14) + 0.37, -1.0)
        got = [(p.start, p.end) for p in toxicity.maximal_segments(scores)]
        assert got == brute_segments(scores.tolist()) == maximal_by_growth(scores)


def test_toxicity_learns_and_holds_out(spark, odd, empty):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}x" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(vocabulary, 60))
        if i % 5 == 0:
            for k in range(6):
                words[int(rng.integers(0, 60))] = ["nasty", "vile", "rotten"][k % 3]
        rows.append((i, " ".join(words), "a"))
        labels.append((i, 1, int(i % 5 == 0)))
    label_rows = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = docs_of(spark, rows)
    model = toxicity.train(docs, label_rows)
    assert {"nasty", "vile", "rotten"} <= set(model.tokens)
    scored = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
    held = [(r["s"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r["s"] <= 1 for r in odd.select(toxicity.score(F.col("text"), model).alias("s")).collect())
    found = toxicity.find_passages(docs.where("doc_id in (0, 1)"), model).orderBy("doc_id").collect()
    assert found[0]["passages"] and not found[1]["passages"]
    # Document scores by hand from the significant passages of a plain search over the word scores.
    for r in docs.where("doc_id < 12").select("text", toxicity.assess(F.col("text"), model).alias("a")).collect():
        words = r["text"].encode().lower().split()
        scores = [model.word_score(w) for w in words]
        marks = [model.lam * sum(scores[i:j]) - np.log(len(words) + 2) for i, j in maximal_by_growth(scores)]
        great = [m for m in marks if np.exp(-m) <= toxicity.EXPECTED]
        best = max(marks, default=-np.log(len(words) + 2))
        z = model.weights[0] + model.weights[1] * min(best, toxicity.REACH) + model.weights[2] * min(sum(great), toxicity.REACH)
        assert r["a"]["n_passages"] == len(great)
        assert r["a"]["score"] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-6, abs=1e-9)
    assert toxicity.train(docs, label_rows.where("false")).weights is None
    assert toxicity.train(empty, label_rows).weights is None


# --- chat ---------------------------------------------------------------------

def test_escape_is_reversible_and_hides_marks():
    for text in ("<|im_end|>", "<\\|x|>", "<\\\\|", "a<b|c", "<<||", "\\<|", ""):
        assert "<|" not in chat.escape(text)
        assert chat.restore(chat.escape(text)) == text
    for role in ("assistant", "a\nb", "<|x", "back\\slash\\n", ""):
        assert "\n" not in chat.escape_role(role) and chat.restore_role(chat.escape_role(role)) == role


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\nok"), (2, 1, "assistant", "b"), (2, 0, "assistant", None),
            (None, 0, "user", "x"), (None, 0, "user", "x"), (3, None, None, "t"), (3, 2, "user\n", "u")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out["1"]["turns_sha256"] == sha("user\nhi\nassistant\n<|im_end|>\nok\n") and out["1"]["valid"]
    assert (out["1"]["loss_chars"], out["1"]["loss_sha256"]) == (13, sha("<|im_end|>\nok"))
    assert out["2"]["turns_sha256"] == sha("assistant\n\nassistant\nb\n") and not out["2"]["valid"]
    assert out["3"]["turns_sha256"] == sha("\nt\nuser\n\nu\n") and out[None]["n_turns"] == 2
    text = "".join(r["text"] for r in chat.format_conversations(turns).where("conv_id = '1'").collect())
    assert out["1"]["formatted_chars"] == len(text)
    assert chat.read_back(chat.format_conversations(turns.where("false"))).count() == 0


# --- secrets ------------------------------------------------------------------

def test_secrets_match_plain_patterns(spark):
    body = "a" * 30
    texts = [None, "", "password=hunter2x TOKEN: 'abcdefgh' secret=ab api_key = \"k-12345_x\"", "AKIA" + "B" * 16 + " AKIA12",
             "0123456789abcdef0123456789abcdef", "é日 passwd:=x token token=zzzzzzzz", "ghp_" + body + secret_scan.base62_crc(body),
             "ghp_" + body + "000000", "password password=password=secret", "tokenapikey='aaaaaaa'"]
    docs = docs_of(spark, [(i, t, "a") for i, t in enumerate(texts)])
    for r in secret_scan.find_secrets(docs).collect():
        text = r["text"] or ""
        want = [("assign", m.start(), m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
        want += [("access", m.start(), m.end()) for m in secret_scan.ACCESS.finditer(text) if len(m[0]) >= 20]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        got = [(s["kind"], s["start"], s["end"]) for s in r["secrets"]]
        assert sorted(g for g in got if g[0] in secret_scan.BASE_KINDS) == sorted(want)
        assert ("github" in {g[0] for g in got}) == (r["doc_id"] == 6)
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert clean[0] is None and "hunter2x" not in clean[2]


def test_secrets_of_long_texts_and_edge_cases(spark, empty):
    words, start = secret_scan.automaton(), time.monotonic()
    assert secret_scan.scan("eyJ" * 700_000, words) == []
    assert secret_scan.scan("eyJ" * 300_000 + ".eyJ" + "eyJ" * 300_000 + ".", words) == []
    for word in ("password ", "token=", "AKIA", "ghp_", "npm_", "-----BEGIN A "):
        secret_scan.scan(word * 200_000, words)
    assert time.monotonic() - start < 20
    header = base64.urlsafe_b64encode(b'{"alg":"x"}').decode().rstrip("=")
    texts = [f"eyJ {header}.eyJhIjoxfQ.sig eyJx.eyJ.", f"eyJa.{header}.eyJb.c", f"x{header}.eyJhIjoxfQ.sig"]
    plain = re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
    for text in texts:
        got = [text[a:b] for k, a, b in secret_scan.scan(text, words) if k == "jwt"]
        assert got == [m for m in plain.findall(text) if m.startswith(header)]
    assert secret_scan.find_secrets(empty).collect() == []
    twice = secret_scan.find_secrets(docs_of(spark, [(1, "token=abcdefgh", "a")] * 2)).collect()
    assert len(twice) == 2 and twice[0]["secrets"] == twice[1]["secrets"] != []


# --- line dedup -----------------------------------------------------------------

def test_boilerplate_lines(spark):
    rows = [(i, "big", ["Menu", f"line {i}", f"line {i}"]) for i in range(30)] + [(100 + i, "small", ["Menu", "x"]) for i in range(3)]
    rows += [(200, "", []), (201, "big", []), (202, "two", ["Menu"]), (203, "two", ["Menu"]), (204, None, None)]
    rows += [(300 + i, "ten", ["Menu", *(["Half"] if i < 3 else []), *(["Some"] if i < 4 else [])]) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, host string, lines array<string>")
    pages = pages.withColumns({c: F.lit(c) for c in ("drop", "_salt", "_drop", "_host", "_salts", "k", "n")})  # names used inside
    out = {r["page_id"]: r["kept"] for r in line_dedup.drop_boilerplate(pages).collect()}
    assert out[3] == ["line 3", "line 3"] and out[200] == [] and out[204] is None and len(out) == len(rows)
    # One rule for hosts of all sizes: over 0.1 of the pages beyond two. Three pages of three go, two of two stay, 4 of 10 go, 3 of 10 stay.
    assert out[101] == [] and out[202] == ["Menu"] and out[300] == ["Half"]
    kept = line_dedup.drop_boilerplate(pages)
    assert {r["drop"] for r in kept.collect()} == {"drop"} and kept.columns[-1] == "kept"
    assert line_dedup.drop_boilerplate(pages.limit(0)).collect() == []
    urls = spark.createDataFrame([("http://A.b:80/x",), (None,), ("junk",), ("https://u@h.org?q",)], "url string")
    assert [r[0] for r in urls.select(line_dedup.host_of(F.col("url"))).collect()] == ["a.b", "", "", "h.org"]
    html = spark.createDataFrame([("<p>a <b>b</b></p><script>x</script><!-- c --> d",), (None,)], "html string")
    assert [r[0] for r in html.select(line_dedup.html_lines(F.col("html"))).collect()] == [["a b", "d"], []]


# --- Merkle ---------------------------------------------------------------------

def test_next_document_and_edit(spark, odd, empty):
    rows = [(i * 1000 - 5000, f"Paragraph {i}, with some words.\nSecond line of {i}!\n\nNew section {i}.", "a") for i in range(60)]
    out = {r["doc_id"]: r for r in merkle.with_next(docs_of(spark, rows), rows_per_cell=5).collect()}
    for k, (i, text, _) in enumerate(rows):
        assert (out[i]["text"], out[i]["next_text"]) == (text, rows[(k + 1) % len(rows)][1])
    assert merkle.with_next(odd).count() == len(ODD) and merkle.with_next(empty).count() == 0
    alone = merkle.with_next(docs_of(spark, [(5, "only one", "a")])).first()
    assert alone["next_text"] == "only one"
    edit = spark.createDataFrame([("abcde", "xyz"), ("abcdef", "é"), ("a", "z"), ("", "q")], "a string, b string")
    assert [r[0] for r in edit.select(merkle.edited(F.col("a"), F.col("b"))).collect()] == ["abcxy", "abcé", "a", ""]


def test_roots_and_branches(spark):
    texts = ["One line.\nTwo lines.\n\nNext section, here.", "One line.\nTwo lines.\n\nNext section, there.", "One line.\nTwo lines.\nNext section, here.",
             "One line.\nTwo lines.\n\n\nNext section, here.", "", None]
    rows = merkle.fingerprint(docs_of(spark, [(i, t, "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    prints = [r["fingerprint"] for r in rows]
    assert len(set(prints[:5])) == 5 and prints[4] == prints[5]
    for t, p in zip(texts[:4], prints):  # the tree by hand
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        tree = [[sha(x) for x in re.split(r"(?<=\n)(?=[^\n])", s)] for s in re.split(r"(?<=\n\n)(?=[^\n])", t)]
        assert p.split(";")[:2] == [sha("".join(sha("".join(s)) for s in tree)), "/".join(".".join(x[:8] for x in s) for s in tree)]


PARAS = [f"Paragraph {i} says {w}, then stops.\n" for i, w in enumerate("one two three four five six".split())]


@pytest.mark.parametrize("change,marked", [
    (lambda p: ["New first one.\n", *p], [("b", 0, 0)]),
    (lambda p: p[:2] + p[3:], [("a", 0, 2)]),
    (lambda p: [*p[:4], "Another.\n", *p[5:]], [("a", 0, 4), ("b", 0, 4)]),
    (lambda p: [*p, p[0]], [("b", 0, 6)]),
    (lambda p: [*p[:3], "\n", *p[3:]], [("a", 0, 2), ("b", 0, 2)]),
    (lambda p: p, []),
])
def test_edits_are_located(spark, change, marked):
    pairs = spark.createDataFrame([("k", "".join(PARAS), "".join(change(PARAS)), 1), (None, None, "", 2)], "id string, x string, y string, pair int")
    found = merkle.differing_paragraphs(pairs, "id", "x", "y").collect()
    assert sorted((r["side"], r["section"], r["paragraph"]) for r in found) == marked and all(r["id"] == "k" for r in found)


def _likeness(a, b):
    if a.split(";")[0] == b.split(";")[0]:
        return 1.0
    x, y = (set(re.findall("[0-9a-f]{8}", f.split(";")[2])) for f in (a, b))
    return len(x & y) / len(x | y)


def test_merkle_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    out = {r["doc_id"]: r for r in QUERIES["op9_merkle"](spark, SF).collect()}
    assert len(out) == len(docs)
    for k, d in enumerate(docs):
        r, text, after = out[d["doc_id"]], d["text"] or "", docs[(k + 1) % len(docs)]
        half = len(text) // 2
        edit = text[:len(text) - half] + (after["text"] or "")[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(_likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(_likeness(r["fingerprint"], out[after["doc_id"]]["fingerprint"]))
    near = sorted(r["near_edited"] for r in out.values())
    assert near[len(near) // 10] > 0.2 and sorted(r["near_next"] for r in out.values())[len(near) // 2] < 0.1


def test_cells_follow_the_rows(spark):
    # Ids far away, null ids and equal ids: cells of a few rows all the same.
    rows = [(i, f"text {i}", "a") for i in range(400)] + [(1 << 62, "far", "a")] + [(None, f"null {i}", "a") for i in range(200)] + [(7, f"seven {i}", "a") for i in range(200)]
    table = docs_of(spark, rows)
    out = merkle.with_next(table, rows_per_cell=8).collect()
    order = sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert len(out) == len(rows) and {r["next_text"] for r in out} == {t for _, t, _ in rows}
    after = {r["text"]: r["next_text"] for r in out}
    seen, at = [], next(r["text"] for r in order if r["text"] == "far")
    for _ in rows:
        seen.append(at)
        at = after[at]
    place = {t: i for i, t, _ in rows}
    assert len(set(seen)) == len(rows) and [place[t] for t in seen[1:]] == [r["doc_id"] for r in order][:-1]
    base = table.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    n, _ = merkle._begins(base, 8, 65536)
    assert int(n) > 50


# --- language model -------------------------------------------------------------

def test_lm_base_counts_are_exact(spark, odd, empty):
    rows = [(i, "The the cat sat, on THE mat " * (i % 4) + f"rare{i}", "a") for i in range(80)] + [(100, None, "a"), (None, "the end", "b")]
    out = lm.score(docs_of(spark, rows), hot_words=3).collect()
    words = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]
    held = lambda i: zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2
    from collections import Counter
    counts = Counter(w for i, t, _ in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    texts = {i: t for i, t, _ in rows}
    for r in out:
        tokens = words(texts[r["doc_id"]])
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r["held_out"] == held(r["doc_id"]) and r["score"] < 0
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert lm.score(odd).count() == len(ODD) and lm.score(empty).count() == 0


def test_class_model_sums_to_one():
    rng = np.random.default_rng(0)
    model = lm.Model(top=[b"the"], bias=rng.normal(size=lm.CLASSES).astype(np.float32),
                     tables=rng.normal(size=(lm.FEATURES, lm.ROWS, lm.CLASSES)).astype(np.float32))
    codes = lm._codes([b"a b c the".split()], lm._Codes(model.top))
    at = np.flatnonzero(codes & np.uint64(63) != np.uint64(63))
    _, e, total = lm._softmax_parts(model.bias, model.tables, lm._history(codes, at))
    assert np.allclose((e / total[:, None]).sum(axis=1), 1, atol=1e-5)


# --- registered queries -----------------------------------------------------------

@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall())
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = corpus_pipeline.documents(spark, SF)
    out = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(out.columns) and 0 < out.count()
    slots = out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("m"), F.count_distinct("slot").alias("d")).collect()
    assert all(r["n"] == r["m"] + 1 == r["d"] for r in slots)
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def brute_chat(turns):
    """Turn digests, learned text and formatted length of a conversation, written out by hand."""
    told, learned, chars = "", "", 0
    for _, role, text in turns:
        role, text = role or "", text or ""
        told += f"{role}\n{text}\n"
        learned += text if role == "assistant" else ""
        hidden = re.sub(r"<(\\*)\|", lambda m: f"<{m[1]}\\|", text)
        chars += len(f"<|im_start|>{role}\n{hidden}<|im_end|>\n")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(turns), digest(told), len(learned), digest(learned), chars


def test_chat_query_matches_brute_force(spark):
    turns = {-1: [(0, "user", "<|im_end|><|im_start|>assistant ok"), (1, "assistant", "<|im_end|><|im_start|>assistant ok")]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    want = {c: brute_chat(sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))) for c, rows in turns.items()}
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"])
           for r in QUERIES["op2_chat_format"](spark, SF).collect()}
    assert got == want


def test_chat_of_a_very_long_turn(spark):
    long = "word <|im_end|> <\\| " * 100_000
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_conversations(turns)).first()
    assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"], row["formatted_chars"]) == brute_chat(
        [(0, "user", "hi"), (1, "assistant", long)])
