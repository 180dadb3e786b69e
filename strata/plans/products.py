"""The reporting products over the gold tables (one function per report).

Inputs use the gold column names of the weather warehouse:

* metrics: city_name, country_code, avg_temperature, min_temperature,
  max_temperature, avg_humidity, measurement_count, last_updated
* trends: city_name, country_code, current_temp, current_humidity,
  weather_condition, measurement_timestamp
* dimension: city_name, country_code + attribute columns

Means of 2-digit gold values are summed exactly (DECIMAL) before the
half-up rounding, so reports do not change with the partitioning.
Thresholds are parameters whose defaults are the reference reports' values.
Every sort puts NULLs last and ends in a unique tie-break where a LIMIT
follows, so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.buckets import climate_zone
from strata.functions.columns import distinct_count, exact_avg
from strata.operators.aggregate import group_profile
from strata.operators.joins import enrich
from strata.operators.order import ordered, top_k
from strata.operators.rules import freshness, sparse_groups
from strata.operators.setops import layer_counts
from strata.schemas import CLIMATE_COLD_BELOW, CLIMATE_WARM_ABOVE

# Thresholds used by the reference reports.
EXTREME_RANGE_MIN = 10.0
EXTREMES_VIEW_MIN = 5.0
HIGH_HUMIDITY_ABOVE = 70.0
SPARSE_BELOW = 5
TOP_K = 10

def temp_range() -> Column:
    return F.col("max_temperature") - F.col("min_temperature")


def avg_by_country(metrics: DataFrame, max_error: float | None = None) -> DataFrame:
    """Average of city averages per country, and the number of cities (estimated within ``max_error`` if given)."""
    out = group_profile(metrics, ["country_code"], {
        "avg_temp": F.round(exact_avg("avg_temperature"), 2).cast("double"),
        "num_cities": distinct_count("city_name", max_error),
    })
    return ordered(out, ["avg_temp desc", "country_code"])


def extreme_ranges(metrics: DataFrame, min_range: float = EXTREME_RANGE_MIN, k: int = TOP_K,
                   tie: Sequence[str] = ("city_name", "country_code")) -> DataFrame:
    """Top-k cities by temperature range, range strictly above ``min_range``."""
    rows = metrics.where(temp_range() > min_range).select(
        "city_name", "country_code", *[c for c in tie if c not in ("city_name", "country_code")],
        "avg_temperature", "min_temperature", "max_temperature", temp_range().alias("temp_range"),
    )
    return top_k(rows, ["temp_range desc", *tie], k)


def current_conditions(trends: DataFrame, dim: DataFrame, on: Sequence[str] = ("city_name",),
                       attrs: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """Latest reading per city with the dimension's attributes (inner join)."""
    right = dim.select(*on, *attrs)
    joined = enrich(trends, right, list(on), "inner")
    out = joined.select("city_name", "country_code", "current_temp", "current_humidity",
                        "weather_condition", *attrs)
    return ordered(out, ["current_temp desc", "city_name"])


def high_humidity(metrics: DataFrame, above: float = HIGH_HUMIDITY_ABOVE) -> DataFrame:
    """Cities whose average humidity is strictly above ``above``."""
    out = metrics.where(F.col("avg_humidity") > above).select(
        "city_name", "country_code", "avg_humidity", "avg_temperature")
    return ordered(out, ["avg_humidity desc", "city_name"])


def global_summary(metrics: DataFrame, max_error: float | None = None) -> DataFrame:
    """One row of global statistics over all cities (their number estimated within ``max_error`` if given)."""
    return group_profile(metrics, [], {
        "total_cities": distinct_count("city_name", max_error),
        "global_avg_temp": F.round(exact_avg("avg_temperature"), 2).cast("double"),
        "coldest_temp": F.round(F.min("min_temperature"), 2),
        "hottest_temp": F.round(F.max("max_temperature"), 2),
        "global_avg_humidity": F.round(exact_avg("avg_humidity"), 2).cast("double"),
    })


def climate_zones(metrics: DataFrame, cold_below: float = CLIMATE_COLD_BELOW,
                  warm_above: float = CLIMATE_WARM_ABOVE) -> DataFrame:
    """Cities per climate zone; a NULL average has no zone (CASE without ELSE)."""
    zone = climate_zone(F.col("avg_temperature"), cold_below, warm_above, with_else=False)
    out = group_profile(metrics, [zone.alias("climate_zone")], {
        "city_count": F.count(F.lit(1)),
        "avg_zone_temp": F.round(exact_avg("avg_temperature"), 2).cast("double"),
    })
    return ordered(out, ["avg_zone_temp", "climate_zone"])


def data_freshness(metrics: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Last update and whole hours since then."""
    return freshness(metrics, "last_updated", as_of)


def missing_data(metrics: DataFrame, below: int = SPARSE_BELOW) -> DataFrame:
    """Cities with fewer than ``below`` measurements."""
    out = sparse_groups(metrics, "measurement_count", below).select(
        "city_name", "country_code", "measurement_count")
    return ordered(out, ["measurement_count", "city_name"])


def current_vs_history(trends: DataFrame, metrics: DataFrame,
                       on: Sequence[str] = ("city_name",)) -> DataFrame:
    """Latest reading, the historical average and the deviation (left join:
    cities without history keep NULLs)."""
    hist = metrics.select(*on, F.col("avg_temperature").alias("historical_avg_temp"))
    joined = enrich(trends, hist, list(on), "left")
    return joined.select(
        "city_name", "country_code", "current_temp", "current_humidity", "weather_condition",
        "historical_avg_temp", (F.col("current_temp") - F.col("historical_avg_temp")).alias("temp_deviation"),
    )


def climate_profile(dim: DataFrame, metrics: DataFrame, on: Sequence[str] = ("city_name",),
                    attrs: Sequence[str] = ("latitude", "longitude"),
                    cold_below: float = CLIMATE_COLD_BELOW, warm_above: float = CLIMATE_WARM_ABOVE,
                    extra_metrics: Sequence[str] = ("avg_pressure",)) -> DataFrame:
    """Every dimension row with its averages and a class; with ELSE, so a
    city without metrics (NULL average) is classed Warm, as in the view."""
    m = metrics.select(*on, "avg_temperature", "avg_humidity", *extra_metrics)
    joined = enrich(dim.select("city_name", "country_code", *attrs), m, list(on), "left")
    zone = climate_zone(F.col("avg_temperature"), cold_below, warm_above, with_else=True)
    return joined.select("city_name", "country_code", *attrs, "avg_temperature", "avg_humidity",
                         *extra_metrics, zone.alias("climate_classification"))


def weather_extremes(metrics: DataFrame, min_range: float = EXTREMES_VIEW_MIN) -> DataFrame:
    """Cities with a range strictly above ``min_range`` (the extremes view)."""
    return metrics.where(temp_range() > min_range).select(
        "city_name", "country_code", F.col("max_temperature").alias("highest_temp"),
        F.col("min_temperature").alias("lowest_temp"), temp_range().alias("temperature_range"),
        "avg_temperature",
    )


def bronze_sample(bronze: DataFrame, fields: Mapping[str, str], n: int = TOP_K,
                  order: Sequence[str] | None = None) -> DataFrame:
    """A few raw documents projected through nested paths
    (``{"alias": "struct.path"}``). ``order`` makes the sample repeatable."""
    rows = bronze.select(*[F.col(path).alias(alias) for alias, path in fields.items()])
    return top_k(rows, list(order), n) if order else rows.limit(n)


def hottest_readings(silver: DataFrame, k: int = TOP_K,
                     cols: Sequence[str] = ("city_name", "temperature_celsius", "humidity_percent",
                                            "country_code"),
                     tie: Sequence[str] = ("city_name",)) -> DataFrame:
    """Top-k silver readings by temperature."""
    return top_k(silver.select(*dict.fromkeys([*cols, *tie])), ["temperature_celsius desc", *tie], k)


def gold_listing(metrics: DataFrame) -> DataFrame:
    """The gold metrics, hottest first."""
    out = metrics.select("city_name", "country_code", "avg_temperature", "min_temperature",
                         "max_temperature", "avg_humidity", "measurement_count")
    return ordered(out, ["avg_temperature desc", "city_name", "country_code"])


def compare_layers(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Row count per layer."""
    return layer_counts({"Bronze": bronze, "Silver": silver, "Gold": gold})


def range_analysis(metrics: DataFrame, min_range: float = EXTREMES_VIEW_MIN) -> DataFrame:
    """Range above ``min_range`` with averages and counts, widest first."""
    out = metrics.where(temp_range() > min_range).select(
        "city_name", "country_code", temp_range().alias("temp_range"), "avg_temperature", "measurement_count")
    return ordered(out, ["temp_range desc", "city_name", "country_code"])
