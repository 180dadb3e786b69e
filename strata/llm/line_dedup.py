"""Boilerplate lines by site-relative frequency.

Pages are grouped by host; a line that stands on more than ``ratio`` of a
host's pages is boilerplate of that host and is dropped from its pages. The
share is taken of the pages beyond ``spare``, so one rule holds for hosts of every
size: a line needs ``ratio * pages + spare`` pages, which is nearly all of the
pages of a small host and nearly ``ratio`` of those of a large one.

Scale: a page sends each distinct line once, as a 128-bit hash, and counts are
summed before the shuffle, so a hot host or line is only a number. The
boilerplate of a host is a small array: each entry stands on over ``ratio`` of
its pages (and more than ``spare``), so there are at most (mean lines per page) / ``ratio``. Pages join
it by host and salt, so the pages of a hot host spread over ``salts`` tasks.

Edge cases: a null or unreadable url is the empty host, a site of its own; null
html has no lines; blank lines are no lines; repeated rows are pages of their
own; an empty table gives no rows; other columns pass through, whatever their
names (a column named like the output is replaced by it). Entities are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import unused

# Fixed patterns, shared with the SQL of the query.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
HIDDEN = r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>|<!--.*?-->"
INLINE = r"(?i)</?(?:a|abbr|b|i|em|strong|span|u|code|small|sub|sup|font)(?:\s[^>]*)?>"
TAG = r"<[^>]*>"
SPACES = r"[\x20\x09\x0B-\x0D]+"


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Visible lines of a page: hidden parts and inline tags go, other tags end a line."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, "\n"), INLINE, ""), TAG, "\n")
    lines = F.split(F.regexp_replace(text, SPACES, " "), "\n")
    return F.coalesce(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != ""), F.array().cast("array<string>"))


def line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = 0.1, spare: int = 2) -> DataFrame:
    """(host, drop): keys of the boilerplate lines of each host of ``pages`` (host, lines)."""
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    keys = pages.select("host", F.explode(F.array_distinct(F.transform("lines", line_key))).alias("k"))
    counts = keys.groupBy("host", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > spare)
    return (counts.join(totals, "host").where((F.col("n") - spare) / F.col("pages") > ratio)
            .groupBy("host").agg(F.collect_list("k").alias("drop")))


def drop_boilerplate(pages: DataFrame, ratio: float = 0.1, spare: int = 2, salts: int = 16, out: str = "kept") -> DataFrame:
    """``pages`` (host, lines, any others) with ``out``: the lines that are no boilerplate of their host."""
    host, salt, drop = unused(pages, "_host", "_salt", "_drop")
    found = boilerplate(pages.select("host", "lines"), ratio, spare).select(
        F.col("host").alias(host), F.col("drop").alias(drop), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(f"{salt}s"))
    salted = pages.withColumn(salt, F.pmod(F.xxhash64("lines"), F.lit(salts)).cast("int"))
    joined = salted.join(found, (F.col("host") == F.col(host)) & (F.col(salt) == F.col(f"{salt}s")), "left")
    kept = F.when(F.col(drop).isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col(drop), line_key(x))))
    return joined.withColumn(out, kept).drop(drop, salt, f"{salt}s", host)
