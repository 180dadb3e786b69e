"""The warehouse layers built from the driver's tables.

Stand-in mapping (documented in the README):

* bronze readings  = ``events``: user_id -> city_id, ts -> measurement time,
  value -> temperature, props (JSON ``{"k": n}``) -> humidity, event_type ->
  weather condition;
* city master data = ``customer`` joined to ``nation``: c_custkey -> city_id,
  c_name -> city_name, n_name -> country_code, c_acctbal / c_mktsegment ->
  the dimension's attributes.

Every builder is lazy and reads the whole tables. Per-city results are
aggregated (or reduced to the latest row) *before* the names are joined, so
the join sees one row per city instead of one per reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import exact_avg
from strata.operators.aggregate import group_profile
from strata.operators.clean import dedup_latest, require, stamp
from strata.operators.dimension import dimension
from strata.operators.flatten import flatten
from strata.operators.window import latest, with_previous
from strata.session import scratch_path
from strata.tables import load

# Fixed clock for repeatable output: processing time of the silver build and
# the "now" of freshness reports.
RUN_TS = "2024-02-01 00:00:00"
AS_OF = "2024-02-03 07:30:00"

READINGS_SPEC = [
    ("event_id", "bigint", "event_id"),
    ("user_id", "bigint", "city_id"),
    ("ts", "timestamp_ntz", "measurement_ts"),
    ("value", "double", "temperature_celsius"),
    ("props.k", "int", "humidity_percent"),
    ("event_type", "string", "weather_condition"),
]
READINGS_KEYS = ["city_id", "measurement_ts"]
READINGS_CRITICAL = ["city_id", "temperature_celsius"]
DIM_ATTRS = ["account_balance", "market_segment"]

TEMP_COLS = ["avg_temperature", "min_temperature", "max_temperature", "avg_humidity"]


def fixed_ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze documents: events with the JSON payload parsed to a struct."""
    return load(spark, sf_dir, "events").withColumn("props", F.from_json("props", "k int"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver readings: flatten + typed casts, drop rows missing critical
    fields, then keep one row per (city, measurement time) - the newest
    event - and stamp the processing time."""
    flat = flatten(bronze_events(spark, sf_dir), READINGS_SPEC)
    kept = require(flat, READINGS_CRITICAL)
    unique = dedup_latest(kept, READINGS_KEYS, ["event_id desc"])
    return stamp(unique, processing_timestamp=fixed_ts(RUN_TS))


def city_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City master data: one row per city with names and attributes. The
    nation side is the fixed 25-row table; the planner broadcasts it."""
    customer = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("city_id"), F.col("c_name").alias("city_name"),
        F.col("n_name").alias("country_code"), F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("market_segment"),
    )


def city_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_master(spark, sf_dir).select("city_id", "city_name", "country_code")


def city_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_city: dense surrogate key over the natural key city_id."""
    return dimension(city_master(spark, sf_dir), "city_id", ["city_name", "country_code", *DIM_ATTRS],
                     key_name="dim_city_key")


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver readings with city name and country (one row per reading)."""
    return readings(spark, sf_dir).join(city_names(spark, sf_dir), "city_id", "left")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there, for
    queries that use it more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gold_metrics(spark: SparkSession, sf_dir: str, daily: bool = False, silver: DataFrame | None = None) -> DataFrame:
    """Aggregated metrics per city (all-time) or per city and day.

    avg / min / max are rounded half-up to 2 digits after aggregation (the
    temperature mean is summed exactly as DECIMAL, so it is repeatable);
    last_updated is the latest processing time. Aggregated by city_id first
    (map-side partial aggregation), names joined afterwards.
    """
    r = readings(spark, sf_dir) if silver is None else silver
    keys: list = ["city_id"]
    if daily:
        r = r.withColumn("measurement_date", F.to_date("measurement_ts"))
        keys.append("measurement_date")
    agg = group_profile(r, keys, {
        "avg_temperature": exact_avg("temperature_celsius"),
        "min_temperature": F.min("temperature_celsius"),
        "max_temperature": F.max("temperature_celsius"),
        "avg_humidity": F.avg("humidity_percent"),
        "measurement_count": F.count(F.lit(1)),
        "last_updated": F.max("processing_timestamp"),
    }, digits=2, round_cols=TEMP_COLS)
    named = agg.join(city_names(spark, sf_dir), "city_id", "left")
    return named.select("city_name", "country_code", *keys[1:], *TEMP_COLS, "measurement_count",
                        "last_updated")


def weather_trends(spark: SparkSession, sf_dir: str, silver: DataFrame | None = None) -> DataFrame:
    """Latest reading per city (ties on time broken by the newest event)."""
    silver = readings(spark, sf_dir) if silver is None else silver
    last = latest(silver, ["city_id"], ["measurement_ts desc", "event_id desc"])
    return last.join(city_names(spark, sf_dir), "city_id", "left").select(
        "city_name", "country_code", F.col("temperature_celsius").alias("current_temp"),
        F.col("humidity_percent").alias("current_humidity"), "weather_condition",
        F.col("measurement_ts").alias("measurement_timestamp"),
    )


def weather_trend_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest and previous reading per city with the temperature change."""
    two = with_previous(readings(spark, sf_dir), ["city_id"], ["measurement_ts desc", "event_id desc"],
                        ["temperature_celsius"])
    return two.join(city_names(spark, sf_dir), "city_id", "left").select(
        "city_name", "country_code", F.col("temperature_celsius").alias("current_temp"),
        F.col("previous_temperature_celsius").alias("previous_temp"),
        F.round(F.col("delta_temperature_celsius"), 2).alias("temp_change"),
        F.col("measurement_ts").alias("measurement_timestamp"),
    )


def partition_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-city partial sums of the silver readings, with the country."""
    part = readings(spark, sf_dir).groupBy("city_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("temperature_celsius").alias("sum_temp"), F.count("temperature_celsius").alias("n_temp"),
        F.sum("humidity_percent").alias("sum_hum"), F.count("humidity_percent").alias("n_hum"),
    )
    return part.join(city_names(spark, sf_dir), "city_id", "left")
