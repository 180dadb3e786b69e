"""The weather warehouse run day by day over a lake: only what a day touches is read and made anew.

A run merges the landed day into the measurement dates it has readings of,
then keeps two tables of partials by date: ``city_days`` (sums, counts and extremes
per city and date) and ``city_spells`` (stretches of unchanged attributes per city id
and date, with the values of their last reading). Both merge exactly, so gold is made from
partials alone; silver of other dates is not read. Metrics and trends add up
before their rows move (a row per city and task), the history is rebuilt for the
touched cities. Surrogate keys come from the registry ``city_keys``, which only grows. All tables are
published in one commit after the gates; a failing gate leaves every table as it was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.clean import dedup_latest
from strata.operators.dimension import dense_index
from strata.operators.quality import null_rates
from strata.operators.rules import gate, null_threshold_check, route
from strata.operators.spells import LAST, merge_spells, spells, validity
from strata.plans.warehouse import GOLD_ROUNDED, SILVER_PARTITION, LayerResult, newest_first, weather_silver
from strata.schemas import COUNTRY_CODE_LENGTH, NULL_THRESHOLDS, VALUE_RANGES, WEATHER_BRONZE, WEATHER_KEYS
from strata.session import scratch_path
from strata.sinks.snapshots import Change, Lake, Snapshot, together
from strata.sources.files import read_bronze, read_partitions

CITY = ["city_name", "country_code"]
ATTRS = ["city_name", "country_code", "latitude", "longitude"]
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Means summed exactly as DECIMAL with this many digits, as ``exact_avg`` does.
_SCALE, _LIMIT = 12, 1e15
_EXACT = {"avg_temperature": "temperature_celsius", "avg_wind_speed": "wind_speed_mps"}
_WHOLE = {"avg_humidity": "humidity_percent", "avg_pressure": "pressure_hpa"}
_LATEST = ["temperature_celsius", "humidity_percent", "weather_condition"]


def city_days(silver: DataFrame) -> DataFrame:
    """Mergeable partials per city and measurement date."""
    parts = {}
    for c in _EXACT.values():
        x = F.col(c).cast("double")
        plain = F.isnan(x) | (F.abs(x) >= _LIMIT)
        parts |= {f"{c}_exact": F.sum(F.when(~plain, x).cast(f"decimal({16 + _SCALE},{_SCALE})")), f"{c}_sum": F.sum(x),
                  f"{c}_plain": F.count_if(plain), f"{c}_n": F.count(x)}
    for c in _WHOLE.values():
        parts |= {f"{c}_sum": F.sum(F.col(c).cast("long")), f"{c}_n": F.count(c)}
    parts |= {"min_temperature": F.min("temp_min_celsius"), "max_temperature": F.max("temp_max_celsius"),
              "measurement_count": F.count(F.lit(1)), "last_updated": F.max("processing_timestamp")}
    return silver.groupBy(*CITY, SILVER_PARTITION).agg(*[v.alias(k) for k, v in parts.items()])


def merged_metrics(days: DataFrame) -> DataFrame:
    """aggregated_weather_metrics from the partials of any dates."""
    out = {}
    for name, c in _EXACT.items():
        n, exact = F.sum(f"{c}_n"), F.sum(f"{c}_exact")
        mean = (exact.cast(f"decimal(38,{_SCALE})") / n).cast("double")
        out[name] = F.when(F.sum(f"{c}_plain") > 0, F.sum(f"{c}_sum") / n).otherwise(mean)
    for name, c in _WHOLE.items():
        out[name] = F.sum(f"{c}_sum").cast("double") / F.sum(f"{c}_n")
    out |= {"min_temperature": F.min("min_temperature"), "max_temperature": F.max("max_temperature"),
            "measurement_count": F.sum("measurement_count"), "last_updated": F.max("last_updated")}
    merged = days.groupBy(*CITY).agg(*[v.alias(k) for k, v in out.items()])
    merged = merged.withColumns({c: F.round(F.col(c), 2).cast("double") for c in GOLD_ROUNDED})
    return merged.select(*CITY, *GOLD_ROUNDED, "measurement_count", "last_updated")


def city_spells(silver: DataFrame) -> DataFrame:
    """Mergeable spells per city id and measurement date, each with the values of its last reading."""
    by_day = spells(silver.withColumn("day", F.col(SILVER_PARTITION)), ["city_id", "day"], "measurement_timestamp", ATTRS, _LATEST)
    return by_day.withColumnRenamed("day", SILVER_PARTITION)


def merged_trends(parts: DataFrame) -> DataFrame:
    """weather_trends (latest reading per city name) from the spells of any dates: a name's latest reading ends a
    spell, as the city's next reading of that date, if any, has another name. Ties as in ``weather_trends``."""
    last = lambda c: [F.col(c).isNull(), F.col(c)]
    desc = lambda c: [F.col(c).isNull(), -F.col(c)]
    order = [*desc(LAST), *last("city_id"), *last("country_code"), *desc("temperature_celsius")]
    first = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *_LATEST, LAST, "country_code"))
    rows = parts.groupBy("city_name").agg(first.alias("r"))
    return rows.select("city_name", "r.country_code", F.col("r.temperature_celsius").alias("current_temp"),
                       F.col("r.humidity_percent").alias("current_humidity"), "r.weather_condition",
                       F.col(f"r.{LAST}").alias("measurement_timestamp"))


def history(parts: DataFrame, keys: DataFrame) -> DataFrame:
    """Spells of every city over all its dates, with its surrogate key and the time each holds."""
    held = validity(merge_spells(parts, ["city_id"], ATTRS), ["city_id"])
    stamped = held.withColumns({c: F.timestamp_seconds(F.col(c)) for c in ("valid_from", "valid_to", "last_seen")})
    return stamped.join(keys, "city_id").select("dim_city_key", "city_id", *ATTRS, "valid_from", "valid_to", "last_seen")


def _parts(df: DataFrame) -> list[str]:
    """The partition folders that the rows of ``df`` belong to: as many as dates."""
    return [f"{SILVER_PARTITION}={_NO_DATE if r[0] is None else r[0]}" for r in df.select(SILVER_PARTITION).distinct().collect()]


def _merge(change: Change, table: str, new: DataFrame, touched: Sequence[str]) -> None:
    """``new`` (one row per reading) merged into the touched dates of ``table``: per reading the newest ingestion stays."""
    if not set(touched).isdisjoint(change.base.parts(table)):
        new = new.unionByName(change.base.table(table, touched))
        new = dedup_latest(new, WEATHER_KEYS, newest_first(new))
    change.replace(table, new, SILVER_PARTITION)


def _of(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` with (``left_semi``) or without (``left_anti``) one of the city ids, which silver requires: an
    equality of plain columns, so windows per city need no second shuffle."""
    return df.join(ids.select("city_id"), "city_id", how)


def _register(change: Change, ids: DataFrame) -> None:
    """New city ids get the next surrogate keys, in id order; known ones keep theirs."""
    base: Snapshot = change.base
    top = 0
    if base.has("city_keys"):
        known = base.table("city_keys")
        top = known.agg(F.coalesce(F.max("dim_city_key"), F.lit(0))).first()[0]
        ids = _of(ids, known, "left_anti")
    numbered = dense_index(ids, ["city_id"], "dim_city_key")
    change.append("city_keys", numbered.select((F.col("dim_city_key") + top).alias("dim_city_key"), "city_id"))


def _rebuild_metrics(change: Change, silver: DataFrame) -> None:
    change.replace("city_days", city_days(silver), SILVER_PARTITION)
    change.replace("aggregated_weather_metrics", merged_metrics(change.staged("city_days")))


def _rebuild_cities(change: Change, silver: DataFrame, touched: Sequence[str]) -> None:
    change.replace("city_spells", city_spells(silver), SILVER_PARTITION)
    together(lambda: change.replace("weather_trends", merged_trends(change.staged("city_spells"))),
             lambda: _rebuild_history(change, touched))


def _rebuild_history(change: Change, touched: Sequence[str]) -> None:
    old = change.base
    ids = change.staged("city_spells", own=True).select("city_id")
    if old.has("city_spells"):
        ids = ids.unionByName(old.table("city_spells", touched).select("city_id"))
    ids = ids.distinct().checkpoint(eager=True)  # the cities that had or have rows on the touched dates
    _register(change, ids)
    spans = history(_of(change.staged("city_spells"), ids, "left_semi"), change.staged("city_keys"))
    if old.has("city_history"):
        spans = spans.unionByName(_of(old.table("city_history"), ids, "left_anti"))
    now = change.replace("city_history", spans).staged("city_history").where(F.col("valid_to").isNull())
    change.replace("dim_city", now.select("dim_city_key", "city_id", *ATTRS))


GOLD_KEYS = {"aggregated_weather_metrics": CITY, "weather_trends": ["city_name"], "dim_city": ["dim_city_key"]}


def run_day(lake: Lake, bronze_root: str, day: dt.date | None = None, processed_at: Column | None = None,
            multiline: bool = False) -> LayerResult:
    """Run one landed day (all days if None) and publish the next version of all tables.

    Tables: silver, silver_quarantine, city_days, city_spells (by measurement date), city_keys,
    aggregated_weather_metrics, weather_trends, city_history and dim_city (its current rows).
    Rerunning a day changes nothing; days may come in any order.
    """
    spark = lake.spark
    change = lake.begin()
    lines = {"multiLine": "true"} if multiline else {}
    bronze = read_partitions(spark, bronze_root, "json", WEATHER_BRONZE, day=day, **lines) \
        if day is not None else read_bronze(spark, bronze_root, "json", WEATHER_BRONZE, **lines)
    dated = weather_silver(bronze, processed_at).withColumn(SILVER_PARTITION, F.to_date(F.timestamp_seconds("measurement_timestamp")))
    country = F.col("country_code")
    routed = route(dated, ranges=VALUE_RANGES, extra=[
        (f"country_code is not {COUNTRY_CODE_LENGTH} characters", country.isNull() | (F.length(country) == COUNTRY_CODE_LENGTH))])
    path, seen = scratch_path(spark, "routed"), Observation("routed")
    counts = [F.count_if(F.col("dq_status") == s).alias(s) for s in ("valid", "quarantine")]
    routed.observe(seen, *counts).write.partitionBy("dq_status").parquet(path)
    routed = spark.read.schema(routed.schema).parquet(path)
    good = routed.where(F.col("dq_status") == "valid").select(*dated.columns)
    bad = routed.where(F.col("dq_status") == "quarantine").select(*dated.columns, F.array_join("dq_reasons", "; ").alias("dq_reasons"))
    n_good, n_bad = seen.get["valid"], seen.get["quarantine"]
    quarantine = lambda: _merge(change, "silver_quarantine", bad, _parts(bad))
    if not n_good:
        quarantine()
        change.commit()
        return LayerResult(0, n_bad, {})
    touched = _parts(good)
    together(quarantine, lambda: _merge(change, "silver", good, touched))
    silver = change.staged("silver", own=True)
    # Three chains of small jobs that only share the merged dates.
    together(lambda: gate(null_threshold_check(spark, null_rates(silver), NULL_THRESHOLDS, "silver"), label="silver null rates"),
              lambda: _rebuild_metrics(change, silver), lambda: _rebuild_cities(change, silver, touched))

    twins = [change.staged(t).groupBy(*k).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
             for t, k in GOLD_KEYS.items()]
    found = twins[0].unionByName(twins[1]).unionByName(twins[2]).withColumn("passed", F.col("rows") == 1)
    gate(found, label="gold duplicates")
    change.commit()
    return LayerResult(n_good, n_bad, {t: change.rows[t] for t in GOLD_KEYS})
