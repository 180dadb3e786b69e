"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, scratch_path
from strata.tables import load

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Fixed values of the contracts: a word is a run of characters other than
# these (space, tab, line feed, vertical tab, form feed, carriage return).
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation of what is
    written) and fixes the values that depend on partition numbers.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(key: Column, modulus: int, remainder: int = 2) -> Column:
    """crc32 of the key's decimal text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that identify a row by id and text, never null; rows alike in both share them."""
    body = F.coalesce(F.col(text), F.lit("\x00"))
    return [F.xxhash64(F.col(doc_id), body).alias("_rk"), F.crc32(body.cast("binary")).alias("_rc")]


def unit(hashed: Column) -> Column:
    """A 64-bit hash as a double in (0, 1)."""
    return (F.shiftrightunsigned(hashed, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until no column of ``df`` (in any case) has it."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
