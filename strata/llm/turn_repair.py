"""Repair of conversations to alternating turns at the least cost.

A repaired conversation is empty or an optional system row followed by pairs
of a user and an assistant row. A row may be kept (cost 0), given the role
that is due (``rerole``), or deleted; rows with empty texts may be inserted
anywhere. Blank rows and rows said before have to go; a truncated row that
stays costs extra. Of all cheapest edits, the ones whose initials (D, I, K, R)
are least in ASCII order are taken.

The dynamic program runs over the rows in order with four states: nothing
written yet, after a system, a user or an assistant row. Per state it carries
the cost and the order of the best edits so far. (Two different edit lists that
end with the same row's edit are never prefixes of each other, so keeping their
order as a rank is enough to break ties exactly.) A row's four backpointers
take one 32-bit number.

Scale: rows are hashed by conversation and sorted by turn (one shuffle; all sorts
spill to disk). The first pass streams them through the program, which carries its
state across Arrow batches and hands every row on with its backpointers; a second
pass reads the same partition in reverse, follows the backpointers and emits the
edits. So neither pass holds more than a batch, however long a conversation is:
backpointers wait in Spark's sort, which is rebuilt when an executor is lost.
A conversation's rows depend on each other from first to last, so one task
reads it; the sort's memory does not grow with it.

Edge cases: nulls in role or text count as one space (so such a text is blank);
rows of one turn stand by role, then text; null turns come first and are left out
of the gaps; the null conversation is one conversation; a conversation listed
without rows is repaired to nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the contract: what stands between words, and what ends a sentence.
BLANK = " \t\n\v\f\r"
STOPS = ".!?"

# Fixed values of the contract: adjacent role initials that are legal.
LEGAL = ("su", "ua", "au")

# States: nothing yet, after a system, a user, an assistant row. What is due next, and the state after it.
_START, _S, _U, _A = range(4)
_DUE = {_START: ("user", _U), _S: ("user", _U), _U: ("assistant", _A), _A: ("user", _U)}
_AFTER = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_A, "u"): _U, (_U, "a"): _A}
_ENDS = (_START, _A)
_EDITS = "DKR"
_MOST_INSERTS = 2  # more would come back to a state already passed, at a higher cost


@dataclass(frozen=True)
class Costs:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


def _inserted(state: int, times: int) -> int:
    for _ in range(times):
        state = _DUE[state][1]
    return state


def _program(costs: Costs):
    """(step, close): one row's transition and the end of a conversation.

    A carried state is a tuple of (cost above the least, rank) per automaton state, or None.
    """

    @lru_cache(maxsize=1 << 16)
    def step(carried: tuple, initial: str, must_go: bool, truncated: bool) -> tuple[tuple, int, int]:
        """(state after, what the least cost has grown by, backpointers)."""
        best: dict[int, tuple] = {}
        stays = costs.truncated if truncated else 0
        for p, held in enumerate(carried):
            if held is None:
                continue
            for k in range(_MOST_INSERTS + 1):
                at, spent = _inserted(p, k), held[0] + k * costs.insert
                moves = [("D", at, spent + costs.delete)]
                if not must_go:
                    moves.append(("R", _DUE[at][1], spent + costs.rerole + stays))
                    if (at, initial) in _AFTER:
                        moves.append(("K", _AFTER[at, initial], spent + stays))
                for edit, to, cost in moves:
                    key = (cost, held[1], "I" * k + edit, p, k)
                    if to not in best or key < best[to]:
                        best[to] = key
        least = min(key[0] for key in best.values())
        order = {to: i for i, (to, _) in enumerate(sorted(best.items(), key=lambda x: x[1][1:3]))}
        after = tuple((best[q][0] - least, order[q]) if q in best else None for q in range(4))
        back = sum((p | k << 2 | _EDITS.index(text[-1]) << 4) << 8 * q for q, (_, _, text, p, k) in best.items())
        return after, least, back

    def close(carried: tuple) -> tuple[int, int, int]:
        """(cost above the least, last state, inserts after the last row)."""
        ends = [(held[0] + k * costs.insert, held[1], "I" * k, p, k) for p, held in enumerate(carried) if held is not None
                for k in range(_MOST_INSERTS + 1) if _inserted(p, k) in _ENDS]
        cost, _, _, p, k = min(ends)
        return cost, p, k

    return step, close


_BEGIN = ((0, 0), None, None, None)
ROWS = "conv_id string, at long, kind int, role string, text string, fault string, back long, summary string"
_COLUMNS = [c.split()[0] for c in ROWS.split(", ")]
# Of a conversation's entry without an edit, written when all its rows have been seen.
SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _forward(costs: Costs):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step, close = _program(costs)
        none = object()
        conv, state = none, _BEGIN

        def end() -> list[tuple]:
            if conv is none:
                return []
            cost, p, k = close(state)
            gaps = 0 if first is None else min(last - first + 1 - turns, (1 << 63) - 1)
            counts = [gaps, *(faults[f] for f in SUMMARY[1:4]), illegal, total + cost]
            return [(conv, at + 1, 1, None, None, None, p | k << 2, ",".join(map(str, counts)))]

        for pdf in batches:
            out: list[tuple] = []
            for c, turn, has_turn, is_row, role, text, said in zip(*(pdf[x] for x in pdf.columns)):
                c = None if pd.isna(c) else c
                if conv is none or c != conv:
                    out += end()
                    conv, state, at, total, illegal, before = c, _BEGIN, 0, 0, 0, None
                    faults = dict.fromkeys(SUMMARY[1:4], 0)
                    first = last = None
                    turns = 0
                if not is_row:
                    continue
                if has_turn:
                    turns += last is None or turn != last
                    first, last = turn if first is None else first, turn
                body = text.strip(BLANK)
                fault = "blank" if not body else "duplicate" if said else "truncated" if body[-1] not in STOPS else None
                if fault:
                    faults[fault] += 1
                initial = role[:1]
                illegal += before is not None and before + initial not in LEGAL
                before = initial
                state, grown, back = step(state, initial, fault in ("blank", "duplicate"), fault == "truncated")
                total, at = total + grown, at + 1
                out.append((c, at, 0, role, text, fault, back, None))
            yield pd.DataFrame(out, columns=_COLUMNS, dtype=object)
        yield pd.DataFrame(end(), columns=_COLUMNS, dtype=object)

    return run


EDITS = "conv_id string, at long, sub int, edit string, role string, text string, fault string, summary string"
_EDIT_COLUMNS = [c.split()[0] for c in EDITS.split(", ")]


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state = _START

    def inserts(c, at: int, p: int, k: int) -> list[tuple]:
        """What is inserted before row ``at``, the last one first."""
        return [(c, at, i, "I", _DUE[_inserted(p, i)][0], "", None, None) for i in reversed(range(k))]

    for pdf in batches:
        out: list[tuple] = []
        for c, at, kind, role, text, fault, back, summary in zip(*(pdf[x] for x in _COLUMNS)):
            c = None if pd.isna(c) else c
            if kind == 1:
                p, k = back & 3, back >> 2
                out.append((c, at, _MOST_INSERTS + 1, None, None, None, None, summary))
            else:
                pointer = back >> 8 * state & 255
                p, k, edit = pointer & 3, pointer >> 2 & 3, _EDITS[pointer >> 4]
                new = _DUE[_inserted(p, k)][0] if edit == "R" else role
                out.append((c, at, _MOST_INSERTS, edit, new, text, None if pd.isna(fault) else fault, None))
            out += inserts(c, at, p, k)
            state = p
        yield pd.DataFrame(out, columns=_EDIT_COLUMNS, dtype=object)


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The edits of every conversation of ``rows`` (conv_id, turn, role, text, and optionally ``is_row``: false for an
    entry that only lists its conversation): conv_id as a string, place (``at``, ``sub``), edit, the role it leaves,
    text, fault; and after the last edit one entry without an edit that carries the conversation's summary.

    Rows of a conversation lie in one partition, in order. The repaired rows are those of the edits I, K and R.
    """
    is_row = F.col("is_row") if "is_row" in rows.columns else F.lit(True)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       is_row.alias("is_row"), text("role").alias("role"), text("text").alias("text")).repartition("conv_id")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    twins = Window.partitionBy("conv_id", "is_row", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    flagged = rows.withColumn("said", F.row_number().over(twins) > 1)
    # Of rows alike in turn, role and text the first is the one not said before.
    flagged = flagged.sortWithinPartitions("conv_id", *order, "said")
    flagged = flagged.select("conv_id", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("has_turn"),
                             "is_row", "role", "text", "said")
    moved = flagged.mapInPandas(_forward(costs), ROWS)
    back = moved.sortWithinPartitions("conv_id", F.col("at").desc())
    edits = back.mapInPandas(_backward, EDITS)
    return edits.sortWithinPartitions("conv_id", "at", "sub")


def damaged(rows: DataFrame) -> DataFrame:
    """Test damage by crc32(``conv_id:turn``) % 20: 0 drops a row (it stays as an entry of its conversation), 1 empties
    its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it a user's."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    kept = rows.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return kept.select("conv_id", "turn", (F.col("kind") != 0).alias("is_row"), "role", "text", F.explode(times).alias("_copy")).drop("_copy")


DIGESTS = f"conv_id string, {', '.join(f'{c} long' for c in SUMMARY)}, audit string, repaired_sha256 string"
_DIGEST_COLUMNS = [c.split()[0] for c in DIGESTS.split(", ")]


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    audit, text, lines = [], hashlib.sha256(), 0
    for pdf in batches:
        done: list[tuple] = []
        for c, edit, role, body, summary in zip(*(pdf[x] for x in ("conv_id", "edit", "role", "text", "summary"))):
            if edit:
                audit.append(edit)
                if edit != "D":
                    text.update(f"{chr(10) if lines else ''}{role}:{body}".encode("utf-8", "surrogatepass"))
                    lines += 1
                continue
            done.append((None if pd.isna(c) else c, *map(int, summary.split(",")), "".join(audit), text.hexdigest()))
            audit, text, lines = [], hashlib.sha256(), 0
        yield pd.DataFrame(done, columns=_DIGEST_COLUMNS, dtype=object)


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation the summary, the edits' initials and the digest of its repaired rows, read from the edits in their order."""
    return edits.select("conv_id", "edit", "role", "text", "summary").mapInPandas(_digest, DIGESTS)
