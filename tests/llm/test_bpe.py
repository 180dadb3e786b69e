"""Byte-level BPE against the tiktoken library and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strata.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = dict(zip(vocabulary.index.keys, vocabulary.ranks))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(encoder, text):
    return np.frombuffer(encoder(text), "<u4").tolist()


def test_perfect_hash_is_minimal_and_knows_its_keys():
    for n in (1, 2, 5, 1000):
        keys = [f"key {i}".encode() for i in range(n)]
        index = bpe.PerfectHash.build(keys)
        assert sorted(index.find(k) for k in keys) == list(range(n))
        assert all(index.find(f"other {i}".encode()) == -1 for i in range(500))
    with pytest.raises(ValueError):
        bpe.PerfectHash.build([b"a", b"a"])


def test_ids_match_the_library(vocabulary, library):
    encoder, rng = bpe.Encoder(vocabulary, memo=50), random.Random(2)
    letters = "abcdefghijTHEn   \n\t\r\x0b\x1c 'sll1234é字́ſ😀​\x00.,;!?<|endoftext|>"
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert ids(encoder, text) == library.encode_ordinary(text)
    for text in ("", "<|endoftext|>", "a" * 5000, " " * 3000 + "x", "ab" * 40_000, "the " * 300_000):
        assert ids(encoder, text) == library.encode_ordinary(text)
    assert ids(encoder, None) == []


def test_every_code_point_splits_like_the_library(vocabulary, library):
    encoder = bpe.Encoder(vocabulary)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 64):
        text = "".join(f"a{c}b 1{c}  {c}{c}x\n" for c in points[i:i + 64])
        assert ids(encoder, text) == library.encode_ordinary(text), hex(ord(points[i]))


def test_columns_round_trip(spark, vocabulary, library):
    texts = [None, "", "Hello  world\n", "Hello  world\n", "naïve 😀 " * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("ids", F.lit("clash"))
    packed = df.select("id", "text", bpe.encode(F.col("text"), vocabulary).alias("packed"))
    rows = packed.select("*", bpe.decode(F.col("packed"), vocabulary).alias("back"), bpe.unpack(F.col("packed")).alias("ids"),
                         bpe.n_tokens(F.col("packed")).alias("n")).orderBy("id").collect()
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text or "") and r.n == len(r.ids)
        assert bytes(r.back).decode() == (r.text or "")
    empty = spark.createDataFrame([], "text string").select(bpe.encode(F.col("text"), vocabulary))
    assert empty.collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_the_table(spark, library, sf):
    from strata.llm.queries import QUERIES
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    rows = QUERIES["op12_bpe"](spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
