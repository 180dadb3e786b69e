"""JSON documents whose schema drifts: typed columns, everything else rescued, and a count of what differs.

Documents are parsed as VARIANT, so no field has to be known beforehand. Field types are
names of Spark SQL (``int``, ``string``, ...).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types of JSON values, as VARIANT names them, that a column of a type holds without loss.
_WHOLE, _NUMBERS = ("BIGINT",), ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
_HOLDS = {"string": ("STRING",), "boolean": ("BOOLEAN",), "int": _WHOLE, "bigint": _WHOLE, "smallint": _WHOLE, "tinyint": _WHOLE}


def _fits(found: Column, wanted: str) -> Column:
    """Whether a variant's type is one that a column of type ``wanted`` holds (a number out of range fails the cast)."""
    names = _HOLDS.get(wanted, _NUMBERS)
    return F.regexp_extract(found, r"^[A-Z]+", 0).isin(*names)


def read_rescued(df: DataFrame, doc: str, expected: Mapping[str, str], rescued: str = "rescued", corrupt: str = "corrupt") -> DataFrame:
    """Columns of ``df`` without ``doc``; one typed column per expected field; ``rescued``, a map of field to JSON text for
    unknown fields and for values that are not of their field's type; ``corrupt``, the text of a document that is no JSON object
    or has a field twice.

    Nothing of a document is lost: a value is in its column or in ``rescued``, an unreadable document in ``corrupt``. JSON nulls
    of expected fields and absent fields are NULL. Text after the first document of a row is not read.
    """
    fields_of = F.from_json(F.col(f"`{doc}`"), "map<string,variant>")
    parsed = df.withColumn("__all", fields_of)
    parsed = parsed.withColumn("__all", F.when(F.size(F.array_distinct(F.map_keys("__all"))) == F.size("__all"), F.col("__all")))
    typed, settled = [], []
    for name, kind in expected.items():
        raw = F.try_element_at("__all", F.lit(name))
        value = F.try_variant_get(raw, "$", kind)
        fits = _fits(F.schema_of_variant(raw), kind) & value.isNotNull()
        typed.append(F.when(fits, value).alias(name))
        settled.append(F.when(fits | (F.schema_of_variant(raw) == "VOID"), F.lit(name)))
    done = F.array_compact(F.array(*settled)) if settled else F.array().cast("array<string>")
    others = F.map_filter("__all", lambda k, _: ~F.array_contains(done, k))
    rescue = F.when(F.size(others) > 0, F.transform_values(others, lambda _, v: F.to_json(v)))
    bad = F.when(F.col("__all").isNull(), F.col(f"`{doc}`"))
    rest = [F.col(f"`{c}`") for c in df.columns if c != doc]
    return parsed.select(*rest, *typed, rescue.alias(rescued), bad.alias(corrupt))


def drift_report(df: DataFrame, doc: str, expected: Mapping[str, str]) -> DataFrame:
    """Rows per field and type found: ``path``, ``found_type``, ``status`` (ok, mismatch, unknown, null, absent, corrupt) and ``documents``.

    One scan; the rows are field occurrences, which the aggregate combines before the shuffle.
    Expected fields that a document lacks count as absent; text that is no JSON object counts once, without a path.
    """
    spark = df.sparkSession
    v = df.select(F.try_parse_json(F.col(f"`{doc}`")).alias("v"), F.col(f"`{doc}`").isNotNull().alias("given"))
    is_doc = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    found = v.where(is_doc).lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("key").alias("path"), F.schema_of_variant("value").alias("t"))
    status = F.lit("unknown")
    for name, kind in expected.items():
        status = F.when(F.col("path") == name, F.when(F.col("t") == "VOID", "null").when(_fits(F.col("t"), kind), "ok").otherwise("mismatch")).otherwise(status)
    seen = found.groupBy("path", "t").agg(F.count(F.lit(1)).alias("documents")).select("path", F.col("t").alias("found_type"), status.alias("status"), "documents")
    totals = v.agg(F.count_if(is_doc).alias("docs"), F.count_if(F.col("given") & ~is_doc).alias("bad"))
    names = spark.createDataFrame([(n,) for n in expected], "path string")
    held = seen.groupBy("path").agg(F.sum("documents").alias("held"))
    absent = names.join(held, "path", "left").withColumn("docs", totals.select("docs").scalar())
    absent = absent.select("path", F.lit(None).cast("string").alias("found_type"), F.lit("absent").alias("status"),
                           (F.col("docs") - F.coalesce("held", F.lit(0))).alias("documents")).where("documents > 0")
    corrupt = totals.select(F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("found_type"),
                            F.lit("corrupt").alias("status"), F.col("bad").alias("documents")).where("documents > 0")
    return seen.unionByName(absent).unionByName(corrupt)
