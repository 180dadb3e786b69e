"""Byte-level BPE encoding and decoding by a rank file.

Two tiers. A pre-token (one match of the vocabulary's pattern) that is in the
vocabulary as a whole is resolved by a minimal perfect hash over all entries:
buckets of keys are displaced until every key has a slot of its own, so a
lookup costs one hash, one table access and one comparison with the slot's
key, and a foreign pre-token is told apart by that comparison. Any other
pre-token starts as a list of linked bytes; a heap of (rank, place) holds the
neighbours whose joined bytes have a rank, and the least rank (then the
leftmost) is joined first, so a pre-token of n bytes takes O(n log n) steps
also where it is millions of bytes long.

A text's ids are packed as little-endian unsigned 32-bit integers in one
binary value, which is the form token files are stored in; ``unpack`` gives
them as an array.

Scale: rows are independent (no shuffle). A task holds the vocabulary (a size
fixed by its file), one Arrow batch and a memory of at most ``memo`` pre-tokens.

Edge cases: a null or empty text has no ids; texts alike have ids alike; an
empty table gives no rows; ids that are not in the vocabulary fail the decoding.
Special tokens are not known: their strings are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import islice
from struct import iter_unpack, pack

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

_GOLDEN, _MIX, _MASK = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1
_TRIES = 256
_LONG_TOKEN, _LONG_SPAN, _LONG_TEXT = 64, 16, 1 << 20


def _slot(h: int, displacement: int, n: int) -> int:
    x = (h + displacement * _GOLDEN) & _MASK
    x = ((x ^ (x >> 32)) * _MIX) & _MASK
    return (x ^ (x >> 32)) % n


def _slots(h: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    x = h[:, None] + displacements[None, :] * np.uint64(_GOLDEN)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return (x ^ (x >> np.uint64(32))) % np.uint64(n)


@dataclass(frozen=True)
class PerfectHash:
    """A bijection of ``keys`` to 0..n-1. ``displacements`` by bucket: 0 or more is
    mixed into the hash, a negative one is the complement of the slot itself."""

    keys: list[bytes]
    displacements: list[int]

    @classmethod
    def build(cls, keys: Sequence[bytes]) -> PerfectHash:
        n = len(keys)
        if len(set(keys)) != n:
            raise ValueError("repeated keys")
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        n_buckets = max(1, n // 4)
        bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=n_buckets)
        ends = np.cumsum(sizes)
        taken, slot_of = np.zeros(n, dtype=bool), np.empty(n, dtype=np.int64)
        displacements = [0] * n_buckets
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[sizes[by_size] > 1].tolist():
            members = order[ends[b] - sizes[b]:ends[b]]
            h, first = hashes[members], 0
            if len(set(h.tolist())) < len(h):
                raise ValueError("two keys of one 64-bit hash")
            while True:
                tried = np.arange(first, first + _TRIES, dtype=np.uint64)
                places = _slots(h, tried, n).astype(np.int64)
                apart = np.sort(places, axis=0)
                fits = ~taken[places].any(axis=0) & (apart[1:] != apart[:-1]).all(axis=0)
                if fits.any():
                    d = int(np.argmax(fits))
                    break
                first += _TRIES
            displacements[b] = first + d
            slot_of[members] = places[:, d]
            taken[places[:, d]] = True
        free = iter(np.flatnonzero(~taken).tolist())
        for b in by_size[sizes[by_size] == 1].tolist():
            slot = next(free)
            slot_of[order[ends[b] - 1]], displacements[b] = slot, ~slot
        placed: list[bytes] = [b""] * n
        for key, slot in zip(keys, slot_of.tolist()):
            placed[slot] = key
        return cls(placed, displacements)

    def find(self, key: bytes) -> int:
        """The slot of ``key``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacements[h % len(self.displacements)]
        slot = ~d if d < 0 else _slot(h, d, len(self.keys))
        return slot if self.keys[slot] == key else -1


@dataclass(frozen=True)
class Vocabulary:
    """A pattern for pre-tokens and the rank (also the id) of each entry, by slot."""

    pattern: str
    index: PerfectHash
    ranks: list[int]
    digest: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """From a rank file: a line per entry, its bytes in base64 and its rank."""
        with open(path, "rb") as file:
            content = file.read()
        entries = [line.split() for line in content.splitlines() if line.strip()]
        ranks = {base64.b64decode(text): int(rank) for text, rank in entries}
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"{path} lacks the bytes {lacking}")
        index = PerfectHash.build(list(ranks))
        digest = xxhash.xxh3_128_hexdigest(content + pattern.encode())
        return cls(pattern, index, [ranks[key] for key in index.keys], digest)

    def rank(self, token: bytes) -> int:
        slot = self.index.find(token)
        return -1 if slot < 0 else self.ranks[slot]


class _Ranks(dict):
    """Ranks of short byte strings (-1: no entry) that have been looked up before."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._look = vocabulary.rank

    def __missing__(self, token: bytes) -> int:
        rank = self._look(token)
        if len(token) <= _LONG_SPAN:
            self[token] = rank
        return rank


class Encoder:
    """Encodes texts one after another. It remembers the ids of at most ``memo`` pre-tokens, in a younger and an
    older half: when the younger is full it becomes the older, so what comes up often stays. Ranks of byte strings are
    remembered up to the same number, then begun anew."""

    def __init__(self, vocabulary: Vocabulary, memo: int = 400_000):
        self._split, self._half = regex.compile(vocabulary.pattern), max(1, memo // 2)
        self._byte_ids = [vocabulary.rank(bytes([b])) for b in range(256)]
        self._pair_ranks = [vocabulary.rank(bytes([a, b])) for a in range(256) for b in range(256)]
        self._ranks = _Ranks(vocabulary)
        self._whole = vocabulary.rank
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token that is no entry: neighbours of the least rank are joined first."""
        n, look, pair_ranks = len(token), self._ranks.__getitem__, self._pair_ranks
        ids = [self._byte_ids[b] for b in token]  # of the piece that starts here
        end = list(range(1, n + 1))  # of the piece that starts here; 0: none does any more
        before = list(range(-1, n - 1))  # start of the piece to the left
        joined = [pair_ranks[a << 8 | b] for a, b in zip(token, token[1:])]  # rank of this piece with the next one, or -1
        joined.append(-1)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(joined) if r >= 0]
        heapify(heap)
        while heap:
            pair = heappop(heap)
            left, r = pair & mask, pair >> bits
            if joined[left] != r:
                continue  # one of the two has been joined to another since
            right = end[left]
            stop = end[right]
            ids[left], end[left], end[right], joined[right] = r, stop, 0, -1
            if stop < n:
                before[stop] = left
                joined[left] = r = look(token[left:end[stop]])
                if r >= 0:
                    heappush(heap, r << bits | left)
            else:
                joined[left] = -1
            start = before[left]
            if start >= 0:
                joined[start] = r = look(token[start:stop])
                if r >= 0:
                    heappush(heap, r << bits | start)
        return [i for i, stop in zip(ids, end) if stop]

    def _pack(self, token: str) -> bytes:
        """Packed ids of a pre-token that the younger half does not hold."""
        packed = self._old.get(token)
        if packed is None:
            raw = token.encode("utf-8")
            whole = self._whole(raw)
            ids = [whole] if whole >= 0 else self.merge(raw)
            packed = pack(f"<{len(ids)}I", *ids)
        if len(token) <= _LONG_TOKEN:
            self._young[token] = packed
        return packed

    def _packed(self, tokens: list[str]) -> bytes:
        if len(self._young) > self._half:
            self._young, self._old = {}, self._young
        if len(self._ranks) > 2 * self._half:
            self._ranks.clear()
        known, make = self._young.get, self._pack
        return b"".join([known(t) or make(t) for t in tokens])

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) <= _LONG_TEXT:
            return self._packed(self._split.findall(text))
        out, found = bytearray(), (m.group() for m in self._split.finditer(text))
        while some := list(islice(found, 1 << 16)):
            out += self._packed(some)
        return bytes(out)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary, memo: int) -> Encoder:
    """This worker process's encoder: its memory serves one task after another. Only the latest vocabulary's is kept."""
    name = f"{vocabulary.digest}:{memo}"
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary, memo)
    return _ENCODERS[name]


def encode(text: Column, vocabulary: Vocabulary, memo: int = 400_000) -> Column:
    """The packed ids of a text."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(vocabulary, memo)
        for texts in batches:
            yield pd.Series([encoder(t) for t in texts], dtype=object)

    return run(text)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self._token_of = dict(zip(vocabulary.ranks, vocabulary.index.keys))

    def __call__(self, packed: bytes | None) -> bytes | None:
        if packed is None:
            return None
        token_of = self._token_of
        return b"".join([token_of[i] for (i,) in iter_unpack("<I", packed)])


def decode(packed: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that packed ids stand for; null for null."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary)
        for values in batches:
            yield pd.Series([decoder(v) for v in values], dtype=object)

    return run(packed)


def round_trip(text: Column, vocabulary: Vocabulary, memo: int = 400_000) -> Column:
    """``ids`` (packed) and ``decoded`` (what ``decode`` gives for them) of a text, by one worker process."""

    @F.pandas_udf("ids binary, decoded binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, decoder = _encoder(vocabulary, memo), Decoder(vocabulary)
        for texts in batches:
            ids = [encoder(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [decoder(v) for v in ids]}, dtype=object)

    return run(text)


def n_tokens(packed: Column) -> Column:
    return F.shiftright(F.octet_length(packed), 2).cast("long")


def unpack(packed: Column) -> Column:
    """Packed ids as an array."""

    @F.pandas_udf("array<long>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else np.frombuffer(v, "<u4").astype("int64") for v in values], dtype=object)

    return run(packed)
