"""Conversation repair against a search over all edit lists."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}
BLANK = " \t\n\v\f\r"


def cheapest(rows):
    """(cost, edits, repaired): uniform-cost search over (cost, edits so far), which pops the ASCII-least of the cheapest first."""
    seen, entries = set(), []
    for role, text in rows:
        body = text.strip(BLANK)
        gone = not body or (role, text) in seen
        seen.add((role, text))
        entries.append((role, text, gone, bool(body) and body[-1] not in ".!?"))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, edits, i, last, out = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(entries) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
            return cost, edits, out
        due = {"u": "user", "a": "assistant"}[DUE[last]]
        heapq.heappush(queue, (cost + 2, edits + "I", i, due[0], (*out, (due, ""))))
        if i < len(entries):
            role, text, gone, cut = entries[i]
            heapq.heappush(queue, (cost + 3, edits + "D", i + 1, last, out))
            if not gone:
                heapq.heappush(queue, (cost + 2 + cut, edits + "R", i + 1, due[0], (*out, (due, text))))
                if role[:1] and role[:1] in ("us" if last == "" else DUE[last]):
                    heapq.heappush(queue, (cost + cut, edits + "K", i + 1, role[:1], (*out, (role, text))))


def damage(table):
    out = {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        rows = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv: sorted(rows) for conv, rows in out.items()}


def expected(table):
    out = {}
    for conv, rows in damage(table).items():
        said, blank, duplicate, truncated = set(), 0, 0, 0
        for _, _, role, text in rows:
            body = text.strip(BLANK)
            if not body:
                blank += 1
            elif (role, text) in said:
                duplicate += 1
            elif body[-1] not in ".!?":
                truncated += 1
            said.add((role, text))
        turns = [t for known, t, _, _ in rows if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = cheapest([r[2:] for r in rows])
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def run(spark, table):
    df = spark.createDataFrame(table, SCHEMA)
    rows = turn_repair.digests(turn_repair.repair(turn_repair.damaged(df))).withColumn("conv_id", F.col("conv_id").cast("long"))
    return {r[0]: tuple(r[1:]) for r in rows.collect()}


def test_cheapest_edits_of_random_conversations(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", "ends here. ", "", " \n", None, "ok?", "a . b"]
    table = [(conv, rng.choice([t, t, t + 3, None, -t]), rng.choice(roles), rng.choice(texts) if rng.random() < .5 else f"Line {rng.random()}.")
             for conv in [*range(400), None] for t in range(rng.randint(1, 9))]
    assert run(spark, table) == expected(table)


def test_ties_take_the_least_initials():
    step, close = turn_repair._program(turn_repair.Costs())
    rng = random.Random(9)
    for _ in range(300):
        rows = [(rng.choice("suat"), rng.choice(["Yes.", "cut"]) + str(i) + rng.choice([".", ""])) for i in range(rng.randint(0, 7))]
        state, total, backs = turn_repair._BEGIN, 0, []
        for role, text in rows:
            state, grown, back = step(state, role, False, text[-1] != ".")
            total += grown
            backs.append(back)
        cost, p, k = close(state)
        edits = "I" * k
        for back in reversed(backs):
            pointer = back >> 8 * p & 255
            edits = "I" * (pointer >> 2 & 3) + "DKR"[pointer >> 4] + edits
            p = pointer & 3
        assert (total + cost, edits) == cheapest(rows)[:2]


def test_long_conversation_across_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(3)
        table = [(1, t, rng.choice(["user", "assistant", "tool"]), rng.choice(["Same.", f"Text {t}.", f"cut {t}"])) for t in range(500)]
        table += [(2, t, "tool", f"cut {t}") for t in range(100)]
        assert run(spark, table) == expected(table)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_rows_and_edge_cases(spark):
    df = spark.createDataFrame([(1, 0, "system", "Rules."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."),
                                (1, 3, "user", "x" * 300_000 + ".")], SCHEMA)
    df = df.withColumns({"edit": F.lit(9), "at": F.lit("x"), "summary": F.lit(None).cast("int")})  # names used inside
    rows = turn_repair.repair(df).orderBy("at", "sub").collect()
    assert [(r.edit, r.role, r.fault) for r in rows] == [
        ("K", "system", None), ("I", "user", None), ("K", "assistant", None), ("D", "assistant", "duplicate"),
        ("K", "user", None), ("I", "assistant", None), (None, None, None)]
    assert len(rows[4].text) == 300_001
    assert run(spark, []) == {}
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert run(spark, [(7, dropped, "user", "Gone.")]) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    wide = [(8, -2**63, "user", "A."), (8, 2**63 - 1, "assistant", "B."), (None, None, None, None)]
    assert run(spark, wide)[8][0] >= 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_the_table(spark, sf):
    from strata.llm.queries import QUERIES
    table = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op11_turn_repair"](spark, f"/root/testdata/{sf}").collect()}
    assert got == expected(table)
