"""Language-model scoring by a hashed maximum-entropy model.

The probability of a word is factored by classes:

    P(word | history) = P(class | history) * P(word | class)

P(class | history) is a softmax over the classes with hashed features of the
history: the last word, the last two words, the word before the last (skip) and
the last with the third last (skip bigram). Words are classed by frequency
and ending: the ``TOP`` most frequent words and the text end have classes of
their own, others are hashed by their last letters. P(word | class) is the
word's share in its class over the training corpus, with one part per distinct
word kept for an unknown word (Witten-Bell), so the model sums to one.

Training: stochastic gradient steps run in every task over its own whole
documents (Adagrad, batches of ``STEP`` words); the tasks' tables are averaged
row by row in two levels of groups and the mean is the next round's start. Word
counts are exact sums over all training documents.

Scoring: the class part is computed in sparse numpy batches (four table rows per
word). The counts of the ``hot_words`` most frequent words travel with the
tasks (a fixed bound); all other words are joined to the count table, so the
vocabulary may grow without limit and every count is exact.

Bounds: the model has ``FEATURES * ROWS * classes`` numbers whatever the corpus;
its training runs in one task per ``trainer_tokens`` tokens (as far as the input has
splits), so a task's work does not grow with the input; blocks of it are averaged
in two levels.

Edge cases: null and empty texts have one token, the end; without training
documents all counts are 0 and every word is unknown; repeated rows are
counted and scored each; a null id belongs to the training rows unless the crc32
of the empty text says otherwise; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, materialise

END, PAD = b"\n", b"\r"  # no word holds a blank
TOP, ENDINGS = 7, 24
CLASSES = 1 + TOP + ENDINGS  # the end, the most frequent words, the endings
ROWS, FEATURES, STEP = 1 << 14, 4, 1 << 14
_BLOCK = 1024
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_SHIFT = np.uint64(64 - 14)


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case (bytes split at ASCII blanks only)."""
    return (text or "").encode("utf-8", "replace").lower().split()


class _Endings(dict):
    """Last two bytes -> class (65,793 entries at most)."""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = k = 1 + TOP + xxhash.xxh32_intdigest(tail) % ENDINGS
        return k


_ENDINGS = _Endings()


def ending_class(word: bytes) -> int:
    """Class of a word without one of its own: by its last two bytes before outer marks."""
    return _ENDINGS[word.rstrip(b".,;:!?\"')]}")[-2:]]


@dataclass
class Model:
    top: list[bytes] = field(default_factory=list)
    total: int = 0  # N
    distinct: int = 0  # V
    in_class: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # tokens per class
    kinds: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # distinct words per class
    bias: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES, np.float32))
    tables: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, ROWS, CLASSES), np.float32))


class _Codes(dict):
    """Word -> 64-bit hash, class in the low bits (the pad: 63); forgets when it grows large."""

    LIMIT = 400_000

    def __init__(self, top: list[bytes]):
        super().__init__()
        self.own = {w: 1 + i for i, w in enumerate(top)} | {END: 0, PAD: 63}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        k = self.own.get(word)
        self[word] = code = xxhash.xxh64_intdigest(word) & ~63 | (ending_class(word) if k is None else k)
        return code


class _Places(dict):
    """Word -> place in ``code``. The ``frequent`` words (with their codes) have the first
    places; others get the next ones. ``trim`` forgets these when they are many; it runs
    between groups of texts only."""

    LIMIT = 400_000

    def __init__(self, frequent: list[bytes], codes: np.ndarray):
        super().__init__()
        self.fixed = {w: i for i, w in enumerate(frequent)}
        self.fixed_codes = codes.astype(np.uint64).tobytes()
        self.trim(force=True)

    def trim(self, force: bool = False) -> None:
        if force or len(self) >= self.LIMIT + len(self.fixed):
            self.clear()
            self.update(self.fixed)
            self.code = array("Q", self.fixed_codes)

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self.code)
        self.code.append(xxhash.xxh64_intdigest(word) & ~63 | (0 if word == END else ending_class(word)))
        return place


def _stream(texts: list[list[bytes]]) -> Iterator[bytes]:
    """All texts in a row: three pads, the words, the end."""
    return chain.from_iterable((PAD, PAD, PAD, *w, END) for w in texts)


def _codes(texts: list[list[bytes]], codes: _Codes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, _stream(texts)), np.uint64)


def _history(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Table rows of the features before each position, (FEATURES, len(at))."""
    one, two, three = code[at - 1], code[at - 2], code[at - 3]
    mixed = (one * _MIX[0], one * _MIX[1] + two * _MIX[0], two * _MIX[2], one * _MIX[3] + three * _MIX[1])
    return np.stack([((x ^ (x >> np.uint64(31))) * _MIX[1]) >> _SHIFT for x in mixed]).astype(np.int32)


def _softmax_parts(bias: np.ndarray, tables: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the classes, their exponentials and the sums of these."""
    z = np.take(tables[0], rows[0], axis=0) + bias
    for j in range(1, FEATURES):
        z += np.take(tables[j], rows[j], axis=0)
    if z.max() > 60 or z.min() < -60:  # keep the exponentials in range
        z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return z, e, np.einsum("ij->i", e)


def _row_sums(rows: np.ndarray, lines: np.ndarray, layers: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` (below 2 ** 16) and the sums of their ``lines``.

    Most rows have few lines, which are added layer by layer; what
    the others have beyond ``layers`` is summed by segments.
    """
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # 16 bits: radix sort
    ordered = rows[order]
    first = np.concatenate(([0], np.flatnonzero(np.diff(ordered)) + 1))
    n = np.diff(np.append(first, len(ordered)))
    sums = np.take(lines, order[first], axis=0)
    for k in range(1, layers):
        more = np.flatnonzero(n > k)
        sums[more] += np.take(lines, order[first[more] + k], axis=0)
    long = np.flatnonzero(n > layers)
    if len(long):
        left = n[long] - layers
        starts = np.cumsum(left) - left
        rest = np.repeat(first[long] + layers - starts, left) + np.arange(left.sum())
        sums[long] += np.add.reduceat(np.take(lines, order[rest], axis=0), starts, axis=0)
    return ordered[first], sums


def class_scores(code: np.ndarray, at: np.ndarray, model: Model) -> np.ndarray:
    """Natural log probability of the class at each of the positions ``at``."""
    out = np.empty(len(at))
    for a in range(0, len(at), STEP):
        here = at[a:a + STEP]
        z, _, total = _softmax_parts(model.bias, model.tables, _history(code, here))
        out[a:a + STEP] = z[np.arange(len(here)), (code[here] & np.uint64(63)).astype(np.int64)] - np.log(total)
    return out


def _groups(texts: Iterator[list[bytes]], size: int = 4 * STEP) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for w in texts:
        held.append(w)
        n += len(w) + 1
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


# ---------------------------------------------------------------------------
# Word counts
# ---------------------------------------------------------------------------

def _count_words(batches):
    """Words per task, summed here as far as memory allows."""
    counts: Counter = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            counts.update(words_of(text))
            counts[END] += 1
            if len(counts) > 400_000:
                yield _counted(counts)
                counts.clear()
    if counts:
        yield _counted(counts)


def _counted(counts: Counter) -> pd.DataFrame:
    return pd.DataFrame({"word": pd.Series([w.decode("utf-8", "replace") for w in counts], dtype=object),
                         "k": [0 if w == END else ending_class(w) for w in counts], "n": list(counts.values())})


def word_counts(train: DataFrame) -> DataFrame:
    """(word, k, c): training count of every word and the end; k: class by ending (0: the end)."""
    parts = train.select("text").mapInPandas(_count_words, "word string, k int, n long")
    return materialise(parts.groupBy("word", "k").agg(F.sum("n").alias("c")), "lm-counts")


# ---------------------------------------------------------------------------
# Training
# ---------------------------------------------------------------------------

def _steps(model: Model, rate: float):
    def run(batches):
        codes, bias = _Codes(model.top), model.bias
        tables = model.tables.copy()
        power = np.full((FEATURES, ROWS), 1e-6, np.float32)
        touched = np.zeros((FEATURES, ROWS), bool)
        texts = (words_of(t) for pdf in batches for t in pdf["text"])
        for group in _groups(texts):
            code = _codes(group, codes)
            at = np.flatnonzero(code & np.uint64(63) != np.uint64(63))
            for a in range(0, len(at), STEP):
                here = at[a:a + STEP]
                rows = _history(code, here)
                _, slope, total = _softmax_parts(bias, tables, rows)
                slope /= total[:, None]
                slope[np.arange(len(here)), (code[here] & np.uint64(63)).astype(np.int64)] -= 1.0
                for j in range(FEATURES):
                    ids, g = _row_sums(rows[j], slope)
                    power[j][ids] += np.einsum("ij,ij->i", g, g) / CLASSES
                    g *= (rate / np.sqrt(power[j][ids]))[:, None]
                    tables[j][ids] -= g
                    touched[j][ids] = True
        for j in range(FEATURES):
            for b in range(0, ROWS, _BLOCK):
                if touched[j, b:b + _BLOCK].any():
                    mine = touched[j, b:b + _BLOCK]
                    sums = (tables[j, b:b + _BLOCK] - model.tables[j, b:b + _BLOCK]) * mine[:, None]
                    yield pd.DataFrame({"j": [j], "b": [b], "salt": [int(xxhash.xxh32_intdigest(sums.tobytes()) % 64)],
                                        "sums": [sums.astype(np.float16).tobytes()], "times": [mine.astype(np.float32).tobytes()]})
    return run


def _add(kind):
    """Sum of the blocks of a group; blocks come as half (first) or single (then) precision."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(x, kind).astype(np.float32) for x in pdf["sums"])
        times = sum(np.frombuffer(x, np.float32) for x in pdf["times"])
        return pd.DataFrame({"j": pdf["j"][:1], "b": pdf["b"][:1], "sums": [sums.astype(np.float32).tobytes()], "times": [times.astype(np.float32).tobytes()]})
    return run


def frequent_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """Counts of all words at or above the least count that ``most`` words at most reach.

    The bound is read off a histogram of the counts on a log scale (some hundred
    rows), so no task sends more than its share of the result.
    """
    step = F.floor(F.log2("c") * 8).cast("int")
    bins = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, n = None, 0
    for s, k in bins:
        n += k
        if n > most:
            break
        least = s
    if least is None:
        return {}
    return {r["word"].encode("utf-8"): r["c"] for r in counts.where(step >= least).collect()}


def train(train_docs: DataFrame, counts: DataFrame, hot_words: int = 100_000, rounds: int = 1, rate: float = 0.15,
          trainers: int | None = None, trainer_tokens: int = 1_000_000) -> tuple[Model, dict[bytes, int]]:
    """The model, and the counts of the most frequent words (``hot_words`` at most)."""
    spark = train_docs.sparkSession
    hot = frequent_words(counts, hot_words)
    model = Model(top=sorted((w for w in hot if w != END), key=lambda w: (-hot[w], w))[:TOP])
    for r in counts.groupBy("k").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        model.in_class[r["k"]], model.kinds[r["k"]] = r["c"], r["v"]
    model.total, model.distinct = int(model.in_class.sum()), int(model.kinds.sum())
    for i, w in enumerate(model.top):
        k = ending_class(w)
        model.in_class[k] -= hot[w]
        model.kinds[k] -= 1
        model.in_class[1 + i], model.kinds[1 + i] = hot[w], 1
    model.bias = np.log((model.in_class + 1.0) / (model.total + CLASSES)).astype(np.float32)
    trainers = trainers or max(4 * spark.sparkContext.defaultParallelism, -(-model.total // trainer_tokens))
    for _ in range(rounds if model.total else 0):
        parts = train_docs.select("text").coalesce(trainers).mapInPandas(
            _steps(model, rate), "j int, b int, salt int, sums binary, times binary")
        schema = "j int, b int, sums binary, times binary"
        halves = parts.groupBy("j", "b", "salt").applyInPandas(_add(np.float16), schema)
        # FEATURES * ROWS / 1024 rows of fixed size, whatever the corpus
        for r in halves.groupBy("j", "b").applyInPandas(_add(np.float32), schema).collect():
            sums = np.frombuffer(r["sums"], np.float32).reshape(-1, CLASSES)
            times = np.maximum(np.frombuffer(r["times"], np.float32), 1.0)
            model.tables[r["j"], r["b"]:r["b"] + _BLOCK] += sums / times[:, None]
    return model, hot


# ---------------------------------------------------------------------------
# Scoring
# ---------------------------------------------------------------------------

_PARTS = ("rid long, id string, held_out boolean, n_tokens long, n_known long, base double, model double, "
          "words array<string>, ks array<int>, ns array<int>")


def _score(model: Model, hot: dict[bytes, int]):
    """Class part and frequent words of each text; other words are handed on."""
    own = _Codes(model.top)
    words = [PAD, *hot]
    code = np.array([own[w] for w in words], np.uint64)
    c = np.array([hot[w] for w in words[1:]], float)
    # Log terms of the frequent words; the pad and (last) all other words have none here.
    of_class = np.log10(model.in_class + model.kinds + 1.0)[(code[1:] & np.uint64(63)).astype(np.int64)]
    base_terms = np.concatenate(([0.0], np.log10(c + 1.0) - np.log10(model.total + model.distinct + 1.0), [0.0]))
    inner_terms = np.concatenate(([0.0], np.log10(c) - of_class, [0.0]))

    def run(batches):
        known = _Places(words, code)
        for pdf in batches:
            about = list(zip(pdf["rid"].tolist(), pdf["id"].tolist(), pdf["held_out"].tolist()))
            for ids in _groups_of(pdf):
                texts = [words_of(t) for t in pdf["text"].iloc[ids]]
                known.trim()
                places = np.fromiter(map(known.__getitem__, _stream(texts)), np.int32)
                stream = np.array(known.code, np.uint64)[places]
                at = np.flatnonzero(stream & np.uint64(63) != np.uint64(63))
                places = np.minimum(places[at], len(words))
                sizes = np.array([len(w) + 1 for w in texts])
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                rare = places == len(words)
                base = np.add.reduceat(base_terms[places], starts)
                inner = np.add.reduceat(inner_terms[places] + class_scores(stream, at, model) / np.log(10.0), starts)
                n_rare = np.add.reduceat(rare.astype(np.int64), starts)
                ends = np.cumsum(n_rare)
                spots = np.flatnonzero(rare) - np.repeat(starts, n_rare)  # within their texts; the last place is the end
                rows = []
                for i, of_text in enumerate(texts):
                    tally = Counter(of_text[j] if j < len(of_text) else END for j in spots[ends[i] - n_rare[i]:ends[i]].tolist())
                    rows.append((*about[ids[i]], int(sizes[i]), int(sizes[i] - n_rare[i]), float(base[i]), float(inner[i]),
                                 [w.decode("utf-8", "replace") for w in tally], [known.code[known[w]] & 63 for w in tally],
                                 list(tally.values())))
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in _PARTS.split(", ")])
    return run


def _groups_of(pdf: pd.DataFrame, chars: int = 1 << 20) -> Iterator[list[int]]:
    """Row numbers in groups of about ``chars`` characters."""
    held, n = [], 0
    for i, t in enumerate(pdf["text"]):
        held.append(i)
        n += len(t or "")
        if n >= chars:
            yield held
            held, n = [], 0
    if held:
        yield held


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, hot_words: int = 100_000,
          rounds: int = 1) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned from the rows not held out."""
    rows = docs.select(F.col(id_col), F.col(f"`{text_col}`").alias("text"), held_out(F.col(id_col), modulus).alias("held_out"))
    learned = rows.where(~F.col("held_out"))
    counts = word_counts(learned)
    model, hot = train(learned, counts, hot_words, rounds)
    # Row numbers are drawn once and written: both uses below read the same ones.
    numbered = rows.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("string").alias("id"), "held_out", "text")
    parts = materialise(numbered.mapInPandas(_score(model, hot), _PARTS), "lm-parts")
    rest = parts.select("rid", F.explode(F.arrays_zip("words", "ks", "ns")).alias("w")).select(
        "rid", F.col("w.words").alias("word"), F.col("w.ks").alias("k"), F.col("w.ns").alias("n"))
    seen = F.col("c").isNotNull()
    n_plus_v = F.lit(float(model.total + model.distinct + 1))
    size = F.array(*[F.lit(float(x)) for x in model.in_class + model.kinds + 1.0])[F.col("k")]
    kinds = F.array(*[F.lit(float(x)) for x in model.kinds + 1.0])[F.col("k")]
    base = F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / n_plus_v)
    inner = F.col("n") * F.log10(F.when(seen, F.col("c")).otherwise(kinds) / size)
    sums = rest.join(counts.select("word", "c"), "word", "left").groupBy("rid").agg(
        F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("r_known"), F.sum(base).alias("r_base"), F.sum(inner).alias("r_model"))
    zero = F.lit(0)
    return parts.select("rid", "id", "held_out", "n_tokens", "n_known", "base", "model").join(sums, "rid", "left").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("r_known", zero)).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", zero)).alias("base_score"), (F.col("model") + F.coalesce("r_model", zero)).alias("score"))
