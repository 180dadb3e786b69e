"""The weather and stock warehouse: bronze -> silver -> quality gate -> gold.

Pure functions over DataFrames plus one function that runs the layers over
paths. Each layer is written once; row counts come from the writes
(``Observation``), never from extra ``count()`` passes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import exact_avg
from strata.operators.aggregate import group_profile
from strata.operators.clean import dedup_latest, require, stamp
from strata.operators.dimension import dimension
from strata.operators.flatten import flatten
from strata.operators.quality import null_rates
from strata.operators.rules import gate, null_threshold_check, route
from strata.operators.series import explode_series, map_value
from strata.operators.window import latest
from strata.schemas import (COUNTRY_CODE_LENGTH, NULL_THRESHOLDS, STOCK_BAR_FIELDS, STOCK_BRONZE, STOCK_META_REFRESHED,
                            STOCK_META_SYMBOL, VALUE_RANGES, WEATHER_BRONZE, WEATHER_CRITICAL, WEATHER_KEYS,
                            WEATHER_SILVER_SPEC)
from strata.session import scratch_path
from strata.sinks.files import write_layer
from strata.sources.files import read_bronze, read_partitions, stored_table
from strata.sources.payloads import split_payloads

SILVER_PARTITION = "measurement_date"
# Gold columns rounded to two digits.
GOLD_ROUNDED = ["avg_temperature", "min_temperature", "max_temperature", "avg_humidity", "avg_pressure",
                "avg_wind_speed"]


def newest_first(df: DataFrame) -> list[str]:
    """Total order of twins of one reading: newest ingestion, then all other columns;
    of rows alike but for the processing time the earlier one stays."""
    last = ["ingestion_timestamp", "processing_timestamp"]
    rest = [c for c in df.columns if c not in (*last, *WEATHER_KEYS)]
    return ["ingestion_timestamp desc", *rest, *(c for c in last[1:] if c in df.columns)]


def weather_silver(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Flatten the nested documents to the 17 typed silver columns, drop
    rows without id or temperature (NULL or NaN), keep the most recently
    ingested row per (city_id, measurement_timestamp), stamp processing time.

    The critical-field filter runs before the dedup, so a NULL-temperature
    twin can never win the dedup and take its good twin down with it.
    """
    flat = flatten(bronze, WEATHER_SILVER_SPEC)
    kept = require(flat, WEATHER_CRITICAL)
    unique = dedup_latest(kept, WEATHER_KEYS, newest_first(kept))
    return stamp(unique, processing_timestamp=processed_at if processed_at is not None else "now")


def weather_metrics(silver: DataFrame, keys=("city_name", "country_code"), daily: bool = False) -> DataFrame:
    """aggregated_weather_metrics: per city (optionally per day) averages,
    extremes, count and last update; rounded half-up to 2 digits."""
    keys = list(keys)
    df = silver
    if daily:
        df = df.withColumn("measurement_date", F.to_date(F.timestamp_seconds("measurement_timestamp")))
        keys.append("measurement_date")
    return group_profile(df, keys, {
        "avg_temperature": exact_avg("temperature_celsius"),
        "min_temperature": F.min("temp_min_celsius"),
        "max_temperature": F.max("temp_max_celsius"),
        "avg_humidity": F.avg("humidity_percent"),
        "avg_pressure": F.avg("pressure_hpa"),
        "avg_wind_speed": exact_avg("wind_speed_mps"),
        "measurement_count": F.count(F.lit(1)),
        "last_updated": F.max("processing_timestamp"),
    }, digits=2, round_cols=GOLD_ROUNDED)


def weather_trends(silver: DataFrame, keys=("city_name",)) -> DataFrame:
    """weather_trends: the latest reading per city (ties on time broken by
    the city id and country, then the reading values)."""
    last = latest(silver, list(keys), ["measurement_timestamp desc", "city_id", "country_code",
                                       "temperature_celsius desc"])
    return last.select("city_name", "country_code", F.col("temperature_celsius").alias("current_temp"),
                       F.col("humidity_percent").alias("current_humidity"), "weather_condition",
                       "measurement_timestamp")


def city_dimension(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """dim_city: one row per city_id (latest attributes) with a dense key
    that stays stable when ``existing`` is given."""
    ranked = silver.select("city_id", "city_name", "country_code", "latitude", "longitude",
                           "measurement_timestamp")
    newest = dedup_latest(ranked, ["city_id"], ["measurement_timestamp desc", "city_name", "country_code"])
    return dimension(newest, "city_id", ["city_name", "country_code", "latitude", "longitude"],
                     key_name="dim_city_key", existing=existing)


def stock_silver(bronze: DataFrame, processed_at: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stock payloads -> (document rows, daily bars, rejected payloads).

    Error and rate-limit payloads are split off first. Document rows are
    deduplicated on (stock_symbol, last_refreshed); the series map is
    exploded to one typed bar per (symbol, trade date).
    """
    good, rejected = split_payloads(bronze)
    now = processed_at if processed_at is not None else F.current_timestamp()
    docs = good.select(
        F.col("symbol").alias("stock_symbol"),
        map_value("Meta Data", STOCK_META_SYMBOL).alias("metadata_symbol"),
        F.to_date(map_value("Meta Data", STOCK_META_REFRESHED)).alias("last_refreshed"),
        F.col("ingestion_timestamp").try_cast("timestamp").alias("ingestion_timestamp"),
        F.col("`Time Series (Daily)`").alias("series"),
    )
    docs = dedup_latest(docs, ["stock_symbol", "last_refreshed"], ["ingestion_timestamp desc", "metadata_symbol"])
    age = ["last_refreshed", "ingestion_timestamp"]  # the newest document's bar wins; its values only break ties
    bars = explode_series(docs, "series", ["stock_symbol", *age], "trade_date", "date", STOCK_BAR_FIELDS)
    values = [alias for _, _, alias in STOCK_BAR_FIELDS]
    bars = dedup_latest(bars, ["stock_symbol", "trade_date"], [*(f"{c} desc" for c in [*age, *values])]).drop(*age)
    return docs.drop("series").withColumn("processing_timestamp", now), bars, rejected


@dataclass
class LayerResult:
    silver_rows: int
    quarantined_rows: int
    gold_rows: dict[str, int]


def _merged(spark: SparkSession, path: str, new: DataFrame, name: str) -> DataFrame:
    """``new`` merged with the stored rows of the dates it touches, written to the
    shared scratch folder: per reading the newest ingestion stays, so an older
    or repeated run changes nothing. The date follows from the reading's key, so
    no reading can be left behind in another partition. Only the touched stretch
    of dates is read (a pushed partition filter)."""
    ends = new.agg(F.min(SILVER_PARTITION).alias("lo"), F.max(SILVER_PARTITION).alias("hi"),
                   F.count_if(F.col(SILVER_PARTITION).isNull()).alias("undated")).first()
    stored = stored_table(spark, path, new.schema)
    both = new
    if stored is not None:
        dated = F.col(SILVER_PARTITION)
        touched = F.lit(False) if ends["lo"] is None else dated.between(F.lit(ends["lo"]), F.lit(ends["hi"]))
        if ends["undated"]:
            touched = touched | dated.isNull()
        days = new.select(dated.alias("_day")).distinct()
        near = stored.where(touched).join(days, F.col(SILVER_PARTITION).eqNullSafe(F.col("_day")), "left_semi")
        both = near.unionByName(new)
    out = scratch_path(spark, name)
    dedup_latest(both, WEATHER_KEYS, newest_first(both)).write.parquet(out)
    return spark.read.schema(new.schema).parquet(out)


def build_layers(spark: SparkSession, bronze_root: str, silver_path: str, gold_root: str,
                 day: dt.date | None = None, processed_at: Column | None = None,
                 quarantine_path: str | None = None, multiline: bool = False) -> LayerResult:
    """Run the weather warehouse for one landed day (all days if None).

    bronze (partition-pruned read; ``multiline`` for files of one indented
    document or array each) -> rows routed by the range rules and staged once
    -> valid rows merged into silver by measurement date, the others into
    quarantine (``quarantine_path``, by default beside silver) -> gates
    (null rates of the merged silver dates, duplicates and null keys of gold)
    -> published. Nothing is overwritten before its gate has passed, and a rerun
    of any day leaves every table as it is. These are plain folders: each table is
    published by itself, and gold reads all of silver. ``strata.plans.daily``
    publishes all tables at once and reads only what a day touches.
    """
    lines = {"multiLine": "true"} if multiline else {}
    bronze = read_partitions(spark, bronze_root, "json", WEATHER_BRONZE, day=day, **lines) \
        if day is not None else read_bronze(spark, bronze_root, "json", WEATHER_BRONZE, **lines)
    dated = weather_silver(bronze, processed_at).withColumn(
        SILVER_PARTITION, F.to_date(F.timestamp_seconds("measurement_timestamp")))
    staged = scratch_path(spark, "routed")
    country = F.col("country_code")
    routed = route(dated, ranges=VALUE_RANGES, extra=[
        (f"country_code is not {COUNTRY_CODE_LENGTH} characters", country.isNull() | (F.length(country) == COUNTRY_CODE_LENGTH))])
    routed.write.partitionBy("dq_status").parquet(staged)
    routed = spark.read.schema(routed.schema).parquet(staged)
    good = routed.where(F.col("dq_status") == "valid").select(*dated.columns)
    bad = routed.where(F.col("dq_status") == "quarantine").select(*dated.columns, F.array_join("dq_reasons", "; ").alias("dq_reasons"))
    quarantine_path = quarantine_path or silver_path.rstrip("/") + "_quarantine"
    quarantined, silver = _merged(spark, quarantine_path, bad, "quarantine"), _merged(spark, silver_path, good, "silver")
    gate(null_threshold_check(spark, null_rates(silver), NULL_THRESHOLDS, "silver"), label="silver null rates")
    write_layer(quarantined, quarantine_path, [SILVER_PARTITION], cluster=True)
    write_layer(silver, silver_path, [SILVER_PARTITION], cluster=True)
    stored = spark.read.schema(silver.schema).parquet(silver_path)
    keys = {"aggregated_weather_metrics": ["city_name", "country_code"], "weather_trends": ["city_name"], "dim_city": ["city_id"]}
    gold = {}
    for name, df in {"aggregated_weather_metrics": weather_metrics(stored), "weather_trends": weather_trends(stored),
                     "dim_city": city_dimension(stored)}.items():
        path = scratch_path(spark, f"gold-{name}")
        df.write.parquet(path)
        gold[name] = spark.read.schema(df.schema).parquet(path)
        twins = gold[name].groupBy(*keys[name]).agg(F.count(F.lit(1)).alias("rows")).withColumn("passed", F.col("rows") == 1)
        gate(twins, label=f"gold {name} duplicates")
    counts = {name: write_layer(df, f"{gold_root}/{name}") for name, df in gold.items()}
    return LayerResult(good.count(), bad.count(), counts)


def read_stock_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_bronze(spark, path, "json", STOCK_BRONZE)
