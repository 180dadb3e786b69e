"""Secret scanning: keyword automaton, anchored patterns, checksums.

An Aho-Corasick automaton over the lower-cased text (A-Z only, so offsets
stay) finds keywords; a kind's pattern is tried only at its keyword's
place. Hex runs have no keyword and are found by their own run pattern.
Tokens that carry a checksum (base-62 CRC32 of the random part) count only if
it holds; JSON web tokens count if their header decodes, private keys if their
armour closes around base64.

Spans are in code points, end exclusive, leftmost and non-overlapping within a
kind, over the whole text.

A text is scanned in linear time: after a match that kind goes on behind it, after a
failed web token behind the run of its letters.

Edge cases: null and empty texts have no spans; repeated rows are scanned
each; an empty table gives no rows; all other columns pass through.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in their order, the base ones first, with their patterns.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "private_key")
BASE_KINDS = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)")
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]++")
PRIVATE_KEY = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s]*)-----END \1PRIVATE KEY-----")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
            "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
            "ghs_": "github", "ghr_": "github", "npm_": "npm", "eyj": "jwt", "-----begin ": "private_key"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    """CRC32 of ``body`` in six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def _checksum(m: re.Match) -> bool:
    return base62_crc(m[1][:30]) == m[1][30:]


def _jwt_header(m: re.Match) -> bool:
    try:
        header = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except ValueError:
        return False
    return isinstance(header, dict) and "alg" in header


def _armour(m: re.Match) -> bool:
    try:
        return len(base64.b64decode("".join(m[2].split()), validate=True)) > 0
    except binascii.Error:
        return False


_RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= MIN_ASSIGN),
    "access": (ACCESS, lambda m: m.end() - m.start() >= MIN_ACCESS),
    "github": (GITHUB, _checksum),
    "npm": (NPM, _checksum),
    "jwt": (JWT, _jwt_header),
    "private_key": (PRIVATE_KEY, _armour),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def scan(text: str | None, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind in the order of KINDS."""
    if not text:
        return []
    spans, past = [], dict.fromkeys(KINDS, 0)
    for last, (length, kind) in words.iter(lower_ascii(text)):
        at = last + 1 - length
        if at < past[kind]:
            continue
        pattern, holds = _RULES[kind]
        if m := pattern.match(text, at):
            past[kind] = m.end()
            if holds(m):
                spans.append((kind, at, m.end()))
        elif kind == "jwt" and (run := _JWT_RUN.match(text, at)):
            past[kind] = run.end()  # what follows the run did not fit, so no other start inside it can match
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with an array of (kind, start, end), sorted."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def _scan(texts: pd.Series) -> pd.Series:
        words = automaton()
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scan(t, words)] for t in texts], dtype=object, index=texts.index)

    return docs.withColumn(out, _scan(F.col(f"`{text_col}`")))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span in the text replaced by ``mask`` (overlapping spans by one)."""

    @F.pandas_udf("string")
    def _redact(texts: pd.Series) -> pd.Series:
        words, out = automaton(), []
        for t in texts:
            parts, past = [], 0
            for _, a, b in scan(t, words):
                if a >= past:
                    parts += [t[past:a], mask]
                past = max(past, b)
            out.append(t if t is None else "".join(parts) + t[past:])
        return pd.Series(out, dtype=object, index=texts.index)

    return docs.withColumn(text_col, _redact(F.col(f"`{text_col}`")))
