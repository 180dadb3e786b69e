"""Chat formatting by a declarative template and a state machine over roles.

A template names the marks around a turn, the roles whose text is learned
(loss) and which role may follow which. Formatting emits segments: the opening
mark, the text and the closing mark of each turn, with a loss flag each.
Control strings inside texts are escaped reversibly: a ``<`` followed by any
number of backslashes and a ``|`` gets one more backslash, so no text can hold
a mark, and taking one backslash away restores it.

The state machine does not drop anything: a turn that may not follow its
predecessor is formatted like any other and marked (``valid`` false, with the
reason), as is a conversation that does not end in a role that may be last.

Scale: rows are hashed by conversation, sorted by turn and streamed through the
machine, so a conversation of any length needs the memory of one batch.

Edge cases: a null text is empty; a null role is the empty role (never valid);
rows of one turn number are taken by role, then text; null turns come first;
the null conversation is one conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TO_ESCAPE = re.compile(r"<(\\*)\|")
_TO_RESTORE = re.compile(r"<(\\*)\\\|")


@dataclass(frozen=True)
class ChatTemplate:
    open: str = "<|im_start|>{role}\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = ""
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant", "tool")})
    last: tuple[str, ...] = ("assistant",)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\1\\|", text)


def restore(text: str) -> str:
    return _TO_RESTORE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def restore_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], restore(role))


SEGMENTS = "conv_id string, segment long, turn_no long, kind string, text string, loss boolean, valid boolean, problem string"


def _segments(template: ChatTemplate):
    opening, closing = template.open, template.close

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = object()
        conv, state, turn_no, segment = none, template.start, 0, 0
        held = None  # the last closing mark waits: only the next row tells whether its conversation is over

        def close(over: bool) -> list[tuple]:
            if held is None:
                return []
            ok = not over or state in template.last
            return [(*held, ok, None if ok else f"ends with {state or 'no role'}")]

        for pdf in batches:
            rows: list[tuple] = []
            for c, role, text in zip(pdf["conv_id"], pdf["role"], pdf["text"]):
                c = None if pd.isna(c) else c
                if conv is none or c != conv:
                    rows += close(True)
                    conv, state, turn_no, segment = c, template.start, 0, 0
                else:
                    rows += close(False)
                role, text = role or "", text or ""
                ok = role in template.follows.get(state, ())
                why = None if ok else f"{role or 'no role'} after {state or 'start'}"
                loss = role in template.loss_roles
                rows.append((c, segment, turn_no, "open", opening.replace("{role}", escape_role(role)), False, ok, why))
                rows.append((c, segment + 1, turn_no, "text", escape(text), loss, ok, why))
                held = (c, segment + 2, turn_no, "close", closing, False)
                state, turn_no, segment = role, turn_no + 1, segment + 3
            yield _frame(rows)
        yield _frame(close(True))

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "segment", "turn_no", "kind", "text", "loss", "valid", "problem"], dtype=object)


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Segments of all conversations (conv_id, turn, role, text), in order within a partition."""
    rows = turns.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInPandas(_segments(template), SEGMENTS)


DIGESTS = ("conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "valid boolean, problems long")


def _read_back(template: ChatTemplate):
    before, after = template.open.split("{role}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = object()
        conv, done = none, []
        turns = loss = None
        n_turns = loss_chars = chars = problems = 0
        turn = ""

        def result() -> tuple:
            return (conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, problems == 0, problems)

        for pdf in batches:
            for c, kind, text, learned, valid in zip(pdf["conv_id"], pdf["kind"], pdf["text"], pdf["loss"], pdf["valid"]):
                c = None if pd.isna(c) else c
                if conv is none or c != conv:
                    if conv is not none:
                        done.append(result())
                    conv, n_turns, loss_chars, chars, problems, turn = c, 0, 0, 0, 0, ""
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                problems += (kind != "text") and not valid
                if learned:
                    plain = restore(text)
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                turn += text
                if turn.endswith(template.close):  # a text cannot hold the mark
                    role, body = turn[len(before):-len(template.close)].split(after, 1)
                    turns.update(f"{restore_role(role)}\n{restore(body)}\n".encode("utf-8", "surrogatepass"))
                    n_turns, turn = n_turns + 1, ""
            yield pd.DataFrame(done, columns=[x.split()[0] for x in DIGESTS.split(", ")], dtype=object)
            done = []
        if conv is not none:
            yield pd.DataFrame([result()], columns=[x.split()[0] for x in DIGESTS.split(", ")], dtype=object)

    return run


def read_back(segments: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Per conversation: turns and learned text parsed back from the formatted segments (in the order made)."""
    return segments.mapInPandas(_read_back(template), DIGESTS)
