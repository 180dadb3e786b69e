"""Landed API payloads and database dumps: provenance, error triage,
envelope unpacking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of an API payload that mark it as an error / rate-limit notice.
ERROR_FIELDS = ("Error Message", "Note")


def land(df: DataFrame, ingestion_ts: Column | None = None, **literals) -> DataFrame:
    """Stamp landed documents with the ingestion time and literal provenance
    columns (e.g. ``city_search="London"``)."""
    ts = ingestion_ts if ingestion_ts is not None else F.current_timestamp()
    return df.withColumns({"ingestion_timestamp": ts, **{k: F.lit(v) for k, v in literals.items()}})


def triage(df: DataFrame, error_fields: Sequence[str] = ERROR_FIELDS,
           reason_col: str = "reject_reason") -> DataFrame:
    """Tag each payload with the first error field that is set (NULL = good)."""
    present = [f for f in error_fields if f in df.columns]
    reason = F.lit(None).cast("string")
    for field in reversed(present):
        reason = F.when(F.col(f"`{field}`").isNotNull(), F.lit(field)).otherwise(reason)
    return df.withColumn(reason_col, reason)


def split_payloads(df: DataFrame, error_fields: Sequence[str] = ERROR_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(good payloads, rejected payloads with ``reject_reason``)."""
    tagged = triage(df, error_fields)
    good = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, tagged.where(F.col("reject_reason").isNotNull())


def read_envelope(df: DataFrame, data_col: str = "data", meta_col: str = "metadata") -> DataFrame:
    """Unpack ``{data: [rows], metadata: {...}}`` documents to one row per
    data element, with the metadata fields (prefixed ``meta_``) alongside.
    Timestamps that were dumped as text (``NaT`` for a missing value) should
    be parsed with ``try_to_timestamp`` afterwards."""
    meta_fields = df.schema[meta_col].dataType.fieldNames()
    rows = df.select(F.explode(data_col).alias("__row"), meta_col)
    return rows.select("__row.*", *[F.col(f"{meta_col}.{f}").alias(f"meta_{f}") for f in meta_fields])
