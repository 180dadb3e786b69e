"""Registered queries over the driver tables: one per operator / product of
the inventory, each with its oracle SQL (omitted only where no SQL engine
can express the operator, e.g. streaming state).

Every callable takes ``(spark, sf_dir)``, reads whole tables and returns a
lazy DataFrame (a few round-trip queries write to the shared scratch
folder first and return the read-back).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.buckets import climate_zone
from strata.functions.columns import first_of
from strata.operators.aggregate import decomposed_avg, group_profile
from strata.operators.clean import dedup_latest, require
from strata.operators.flatten import flatten
from strata.operators.joins import apply_defaults, insert_absent
from strata.operators.order import ordered
from strata.operators.quality import duplicate_stats, null_rates, profile, range_stats
from strata.operators.rules import null_threshold_check, route, violation_counts
from strata.operators.series import explode_series, map_value
from strata.plans import oracle as O
from strata.plans import products as P
from strata.plans import standin as S
from strata.schemas import NULL_THRESHOLDS, VALUE_RANGES
from strata.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def _round_doubles(df: DataFrame, digits: int, cols) -> DataFrame:
    """Round float results whose last bits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# ---------------------------------------------------------------------------
# Bronze -> silver
# ---------------------------------------------------------------------------

@query("flatten_events", f"""
SELECT event_id, user_id AS city_id, ts AS measurement_ts, value AS temperature_celsius,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity_percent,
       event_type AS weather_condition
FROM events""")
def flatten_events(spark, sf_dir):
    return flatten(S.bronze_events(spark, sf_dir), S.READINGS_SPEC)


@query("array_head", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word,
       string_split(p_name, ' ')[6] AS sixth_word
FROM part""")
def array_head(spark, sf_dir):
    words = F.split(F.col("p_name"), " ")
    return load(spark, sf_dir, "part").select(
        "p_partkey", first_of(words).alias("first_word"), F.get(words, 5).alias("sixth_word"))


@query("critical_not_null", """
SELECT event_id, user_id, event_type, value FROM events
WHERE nullif(event_type, 'error') IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)""")
def critical_not_null(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value")
    return require(ev, ["event_type", "value"])


@query("dedup_lineitem", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1""")
def dedup_lineitem(spark, sf_dir):
    return dedup_latest(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                        ["l_shipdate desc", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                         "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@query("silver_readings", O.with_(O.SILVER) + "SELECT * FROM silver")
def silver_readings(spark, sf_dir):
    return S.readings(spark, sf_dir)


# ---------------------------------------------------------------------------
# Gold builds
# ---------------------------------------------------------------------------

@query("group_profile", O.with_(O.SILVER, O.NAMES, O.GOLD) + "SELECT * FROM gold")
def group_profile_q(spark, sf_dir):
    return S.gold_metrics(spark, sf_dir)


@query("gold_daily", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + "SELECT * FROM gold_daily")
def gold_daily(spark, sf_dir):
    return S.gold_metrics(spark, sf_dir, daily=True)


@query("latest_reading", O.with_(O.SILVER, O.NAMES, O.TRENDS) + "SELECT * FROM trends")
def latest_reading(spark, sf_dir):
    return S.weather_trends(spark, sf_dir)


@query("current_vs_previous", O.with_(O.SILVER, O.NAMES) + f"""
SELECT n.city_name, n.country_code, s.temperature_celsius AS current_temp, s.previous_temp,
       {O.r('s.temperature_celsius - s.previous_temp')} AS temp_change,
       s.measurement_ts AS measurement_timestamp
FROM (SELECT *, lead(temperature_celsius) OVER w AS previous_temp,
             row_number() OVER w AS rn
      FROM silver WINDOW w AS (PARTITION BY city_id ORDER BY measurement_ts DESC, event_id DESC)) s
LEFT JOIN names n ON s.city_id = n.city_id
WHERE s.rn = 1""")
def current_vs_previous(spark, sf_dir):
    return S.weather_trend_deltas(spark, sf_dir)


@query("dimension_build", O.with_(O.NAMES, O.DIM) + "SELECT * FROM dim")
def dimension_build(spark, sf_dir):
    return S.city_dimension(spark, sf_dir)


# ---------------------------------------------------------------------------
# Reporting products
# ---------------------------------------------------------------------------

@query("avg_by_country", O.with_(O.SILVER, O.NAMES, O.GOLD) + f"""
SELECT country_code, {O.ravg('avg_temperature')} AS avg_temp, count(DISTINCT city_name) AS num_cities
FROM gold GROUP BY country_code""")
def avg_by_country(spark, sf_dir):
    return P.avg_by_country(S.gold_metrics(spark, sf_dir))


@query("extreme_range_topk", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + """
SELECT city_name, country_code, measurement_date, avg_temperature, min_temperature, max_temperature,
       max_temperature - min_temperature AS temp_range
FROM gold_daily WHERE max_temperature - min_temperature > 10
ORDER BY temp_range DESC, city_name, country_code, measurement_date LIMIT 10""")
def extreme_range_topk(spark, sf_dir):
    return P.extreme_ranges(S.gold_metrics(spark, sf_dir, daily=True),
                            tie=("city_name", "country_code", "measurement_date"))


@query("current_with_dimension", O.with_(O.SILVER, O.NAMES, O.TRENDS, O.DIM) + """
SELECT t.city_name, t.country_code, t.current_temp, t.current_humidity, t.weather_condition,
       d.account_balance, d.market_segment
FROM trends t JOIN dim d ON t.city_name = d.city_name""")
def current_with_dimension(spark, sf_dir):
    return P.current_conditions(S.weather_trends(spark, sf_dir), S.city_master(spark, sf_dir),
                                attrs=S.DIM_ATTRS)


@query("high_humidity", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + """
SELECT city_name, country_code, avg_humidity, avg_temperature
FROM gold_daily WHERE avg_humidity > 70""")
def high_humidity(spark, sf_dir):
    return P.high_humidity(S.gold_metrics(spark, sf_dir, daily=True))


@query("global_summary", O.with_(O.SILVER, O.NAMES, O.GOLD) + f"""
SELECT count(DISTINCT city_name) AS total_cities, {O.ravg('avg_temperature')} AS global_avg_temp,
       {O.r('min(min_temperature)')} AS coldest_temp, {O.r('max(max_temperature)')} AS hottest_temp,
       {O.ravg('avg_humidity')} AS global_avg_humidity
FROM gold""")
def global_summary(spark, sf_dir):
    return P.global_summary(S.gold_metrics(spark, sf_dir))


@query("climate_zones", O.with_(O.SILVER, O.NAMES, O.GOLD) + f"""
SELECT CASE WHEN avg_temperature < 10 THEN 'Cold'
            WHEN avg_temperature BETWEEN 10 AND 20 THEN 'Temperate'
            WHEN avg_temperature > 20 THEN 'Warm' END AS climate_zone,
       count(*) AS city_count, {O.ravg('avg_temperature')} AS avg_zone_temp
FROM gold GROUP BY 1""")
def climate_zones(spark, sf_dir):
    return P.climate_zones(S.gold_metrics(spark, sf_dir))


@query("data_freshness", O.with_(O.SILVER, O.NAMES, O.GOLD) + f"""
SELECT max(last_updated) AS last_data_update,
       datesub('hour', max(last_updated), {O.AS_OF}) AS hours_since_update
FROM gold""")
def data_freshness(spark, sf_dir):
    return P.data_freshness(S.gold_metrics(spark, sf_dir), S.fixed_ts(S.AS_OF))


@query("missing_data", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + """
SELECT city_name, country_code, measurement_count FROM gold_daily WHERE measurement_count < 5""")
def missing_data(spark, sf_dir):
    return P.missing_data(S.gold_metrics(spark, sf_dir, daily=True))


@query("current_vs_history", O.with_(O.SILVER, O.NAMES, O.TRENDS, O.GOLD) + f"""
SELECT t.city_name, t.country_code, t.current_temp, t.current_humidity, t.weather_condition,
       g.avg_temperature AS historical_avg_temp,
       t.current_temp - g.avg_temperature AS temp_deviation
FROM trends t LEFT JOIN gold g ON t.city_name = g.city_name""")
def current_vs_history(spark, sf_dir):
    silver = S.stored(S.readings(spark, sf_dir), "silver")
    return P.current_vs_history(S.weather_trends(spark, sf_dir, silver), S.gold_metrics(spark, sf_dir, silver=silver))


@query("climate_profile", O.with_(O.SILVER, O.NAMES, O.GOLD, O.DIM) + """
SELECT d.city_name, d.country_code, d.account_balance, d.market_segment,
       g.avg_temperature, g.avg_humidity,
       CASE WHEN g.avg_temperature < 10 THEN 'Cold'
            WHEN g.avg_temperature BETWEEN 10 AND 20 THEN 'Temperate'
            ELSE 'Warm' END AS climate_classification
FROM dim d LEFT JOIN gold g ON d.city_name = g.city_name""")
def climate_profile(spark, sf_dir):
    return P.climate_profile(S.city_master(spark, sf_dir), S.gold_metrics(spark, sf_dir),
                             attrs=S.DIM_ATTRS, extra_metrics=())


@query("weather_extremes", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + """
SELECT city_name, country_code, max_temperature AS highest_temp, min_temperature AS lowest_temp,
       max_temperature - min_temperature AS temperature_range, avg_temperature
FROM gold_daily WHERE max_temperature - min_temperature > 5""")
def weather_extremes(spark, sf_dir):
    return P.weather_extremes(S.gold_metrics(spark, sf_dir, daily=True))


@query("nested_sample", """
SELECT event_id, user_id AS city, CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
       event_type AS condition
FROM events ORDER BY event_id LIMIT 10""")
def nested_sample(spark, sf_dir):
    return P.bronze_sample(S.bronze_events(spark, sf_dir),
                           {"event_id": "event_id", "city": "user_id", "humidity": "props.k",
                            "condition": "event_type"}, order=["event_id"])


@query("top_readings", O.with_(O.SILVER, O.NAMES) + """
SELECT n.city_name, s.temperature_celsius, s.humidity_percent, n.country_code, s.event_id
FROM silver s LEFT JOIN names n ON s.city_id = n.city_id
ORDER BY s.temperature_celsius DESC, s.event_id LIMIT 10""")
def top_readings(spark, sf_dir):
    # Top-k first (k rows per task), names joined to the 10 survivors only.
    top = P.hottest_readings(S.readings(spark, sf_dir),
                             cols=("city_id", "temperature_celsius", "humidity_percent"), tie=("event_id",))
    return top.join(S.city_names(spark, sf_dir), "city_id", "left").select(
        "city_name", "temperature_celsius", "humidity_percent", "country_code", "event_id")


@query("gold_listing", O.with_(O.SILVER, O.NAMES, O.GOLD) + """
SELECT city_name, country_code, avg_temperature, min_temperature, max_temperature, avg_humidity,
       measurement_count FROM gold""")
def gold_listing(spark, sf_dir):
    return P.gold_listing(S.gold_metrics(spark, sf_dir))


@query("layer_counts", O.with_(O.SILVER, O.NAMES, O.GOLD) + """
SELECT 'Bronze' AS layer, count(*) AS record_count FROM events
UNION ALL SELECT 'Silver', count(*) FROM silver
UNION ALL SELECT 'Gold', count(*) FROM gold""")
def layer_counts(spark, sf_dir):
    silver = S.stored(S.readings(spark, sf_dir), "silver")
    return P.compare_layers(load(spark, sf_dir, "events"), silver, S.gold_metrics(spark, sf_dir, silver=silver))


@query("range_analysis", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + """
SELECT city_name, country_code, max_temperature - min_temperature AS temp_range, avg_temperature,
       measurement_count
FROM gold_daily WHERE max_temperature - min_temperature > 5""")
def range_analysis(spark, sf_dir):
    return P.range_analysis(S.gold_metrics(spark, sf_dir, daily=True))


@query("partition_profile", O.with_(O.SILVER, O.NAMES) + f"""
SELECT n.country_code, count(*) AS records, {O.r('avg(s.temperature_celsius)', 6)} AS avg_temp,
       {O.r('avg(s.humidity_percent)', 6)} AS avg_humidity
FROM silver s LEFT JOIN names n ON s.city_id = n.city_id GROUP BY n.country_code""")
def partition_profile(spark, sf_dir):
    # Per-city partial sums first; only one row per city meets the join.
    parts = S.partition_partials(spark, sf_dir)
    out = group_profile(parts, ["country_code"], {
        "records": F.sum("n"),
        "avg_temp": decomposed_avg("sum_temp", "n_temp"),
        "avg_humidity": decomposed_avg("sum_hum", "n_hum"),
    }, digits=6, round_cols=["avg_temp", "avg_humidity"])
    return ordered(out, ["records desc", "country_code"])


@query("zone_buckets", """
SELECT CASE WHEN b < 0 THEN 'Cold' WHEN b BETWEEN 0 AND 5000 THEN 'Temperate'
            WHEN b > 5000 THEN 'Warm' END AS zone,
       CASE WHEN b < 0 THEN 'Cold' WHEN b BETWEEN 0 AND 5000 THEN 'Temperate'
            ELSE 'Warm' END AS zone_else,
       count(*) AS customers
FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS b FROM customer)
GROUP BY 1, 2""")
def zone_buckets(spark, sf_dir):
    bal = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_acctbal"))
    c = load(spark, sf_dir, "customer").select(bal.alias("b"))
    return group_profile(c, [climate_zone(F.col("b"), 0, 5000).alias("zone"),
                             climate_zone(F.col("b"), 0, 5000, with_else=True).alias("zone_else")],
                         {"customers": F.count(F.lit(1))})


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

def _events_with_nulls(spark, sf_dir):
    """events with the 'error' condition turned into NULL (no NULLs exist
    in the driver tables; this makes the null checks non-trivial)."""
    ev = load(spark, sf_dir, "events")
    return ev.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))


_EV_NULL_CTE = """e AS (SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props
            FROM events)"""
_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _pct_sql(n: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN {O.r(f'100.0::DOUBLE * {n} / {total}')} ELSE 0.0 END"


@query("null_rates", "WITH " + _EV_NULL_CTE + ", t AS (SELECT count(*) AS total_rows, "
       + ", ".join(f"count_if({c} IS NULL) AS n_{c}" for c in _EV_COLS) + " FROM e)\n"
       + "\nUNION ALL\n".join(
           f"SELECT '{c}' AS column_name, total_rows, n_{c} AS null_count, "
           f"{_pct_sql(f'n_{c}', 'total_rows')} AS null_rate FROM t" for c in _EV_COLS))
def null_rates_q(spark, sf_dir):
    return null_rates(_events_with_nulls(spark, sf_dir))


@query("duplicate_stats", f"""
WITH t AS (SELECT (SELECT count(*) FROM lineitem) AS total_rows,
                  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_rows)
SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_count,
       {_pct_sql('(total_rows - distinct_rows)', 'total_rows')} AS duplicate_rate
FROM t""")
def duplicate_stats_q(spark, sf_dir):
    return duplicate_stats(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax"]


@query("range_stats", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, "
    f"{O.r(f'avg({c}::DOUBLE)', 4)} AS avg_value, {O.r(f'stddev_samp({c}::DOUBLE)', 4)} AS stddev_value, "
    f"count({c}) AS value_count FROM lineitem" for c in _LI_NUMERIC))
def range_stats_q(spark, sf_dir):
    # Mean and deviation rounded to 4 digits: their last bits depend on the
    # summation order, which differs between engines and partitionings.
    return _round_doubles(range_stats(load(spark, sf_dir, "lineitem")), 4, ["avg_value", "stddev_value"])


def _profile_sql() -> str:
    cols = _EV_COLS
    numeric = ["event_id", "user_id", "value"]
    aggs = ["count(*) AS total"] + [f"count_if({c} IS NULL) AS n_{c}" for c in cols]
    aggs.append("(SELECT count(*) FROM (SELECT DISTINCT user_id, ts FROM e)) AS distinct_keys")
    for c in numeric:
        aggs += [f"min({c}::DOUBLE) AS mn_{c}", f"max({c}::DOUBLE) AS mx_{c}", f"avg({c}::DOUBLE) AS av_{c}",
                 f"stddev_samp({c}::DOUBLE) AS sd_{c}", f"count({c})::DOUBLE AS ct_{c}"]
    rows = [("*", "row_count", "total::DOUBLE"), ("*", "column_count", f"{len(cols)}::DOUBLE")]
    rows += [(c, "null_rate", _pct_sql(f"n_{c}", "total")) for c in cols]
    rows += [("user_id,ts", "duplicate_count", "(total - distinct_keys)::DOUBLE"),
             ("user_id,ts", "duplicate_rate", _pct_sql("(total - distinct_keys)", "total"))]
    for c in numeric:
        rows += [(c, "min", f"mn_{c}"), (c, "max", f"mx_{c}"), (c, "avg", f"av_{c}"),
                 (c, "stddev", f"sd_{c}"), (c, "count", f"ct_{c}")]
    long_rows = "\nUNION ALL\n".join(
        f"SELECT '{col}' AS column_name, '{metric}' AS metric, {expr} AS value FROM a"
        for col, metric, expr in rows)
    return ("WITH " + _EV_NULL_CTE + ", a AS (SELECT " + ", ".join(aggs) + " FROM e),\n"
            f"p AS ({long_rows})\n"
            f"SELECT 'events' AS dataset, column_name, metric, {O.r('value', 4)} AS value FROM p")


@query("quality_profile", _profile_sql())
def quality_profile(spark, sf_dir):
    rep = profile(_events_with_nulls(spark, sf_dir), "events", keys=["user_id", "ts"])
    return _round_doubles(rep, 4, ["value"])


_SILVER_RULE_COLS = ["city_id", "event_id", "measurement_ts", "temperature_celsius", "humidity_percent",
                     "weather_condition", "processing_timestamp", "city_name", "country_code"]


@query("null_thresholds", O.with_(O.SILVER, O.NAMES) + """,
sw AS (SELECT s.* REPLACE (nullif(s.humidity_percent, 0) AS humidity_percent), n.city_name,
              CASE WHEN s.weather_condition <> 'error' THEN n.country_code END AS country_code
       FROM silver s LEFT JOIN names n ON s.city_id = n.city_id),
t AS (SELECT count(*) AS total, """ + ", ".join(f"count_if({c} IS NULL) AS n_{c}" for c in _SILVER_RULE_COLS)
       + """ FROM sw),
rates AS (""" + "\nUNION ALL\n".join(
           f"SELECT '{c}' AS column_name, {_pct_sql(f'n_{c}', 'total')} AS null_rate FROM t"
           for c in _SILVER_RULE_COLS) + """),
rules AS (SELECT * FROM (VALUES """ + ", ".join(
           f"('{layer}', '{c}', {m})" for layer, c, m in NULL_THRESHOLDS) + """) v(layer, column_name, max_null_rate)),
limits AS (SELECT l.layer, r.column_name, r.null_rate, coalesce(
             (SELECT max_null_rate FROM rules u WHERE u.layer = l.layer AND u.column_name = r.column_name),
             (SELECT max_null_rate FROM rules u WHERE u.layer = l.layer AND u.column_name = '*'))::DOUBLE AS max_null_rate
           FROM rates r CROSS JOIN (SELECT DISTINCT layer FROM rules) l)
SELECT layer, column_name, null_rate, max_null_rate, (max_null_rate IS NULL OR null_rate <= max_null_rate) AS passed
FROM limits""")
def null_thresholds(spark, sf_dir):
    # Some countries and humidities are turned into NULL, so rules of both layers fail as well as pass.
    silver = S.silver_weather(spark, sf_dir).select(*_SILVER_RULE_COLS).withColumns({
        "country_code": F.when(F.col("weather_condition") != "error", F.col("country_code")),
        "humidity_percent": F.nullif(F.col("humidity_percent"), F.lit(0))})
    rates = null_rates(silver)
    checks = [null_threshold_check(spark, rates, NULL_THRESHOLDS, layer).select(
        F.lit(layer).alias("layer"), "column_name", "null_rate", "max_null_rate", "passed") for layer in ("silver", "gold")]
    return checks[0].unionByName(checks[1])


def _reading_ranges():
    return [r for r in VALUE_RANGES if r[0] in ("temperature_celsius", "humidity_percent")]


def _violation_cases_sql():
    cases = [(f"{c} is null", f"{c} IS NULL") for c in S.READINGS_CRITICAL]
    cases += [(f"{c} not in [{lo:g}, {hi:g}]", f"NOT ({c} BETWEEN {lo} AND {hi})") for c, lo, hi in _reading_ranges()]
    return cases


@query("value_constraints", O.with_(O.SILVER) + ", a AS (SELECT count(*) AS checked_rows, " + ", ".join(
    [f"count_if({c} IS NULL) AS v_nn_{c}" for c in S.READINGS_CRITICAL]
    + [f"count_if(NOT ({c} BETWEEN {lo} AND {hi})) AS v_rg_{c}" for c, lo, hi in VALUE_RANGES
       if c in ("temperature_celsius", "humidity_percent")]) + " FROM silver)\n" + "\nUNION ALL\n".join(
    [f"SELECT 'not_null' AS rule, '{c}' AS column_name, checked_rows, v_nn_{c} AS violations FROM a"
     for c in S.READINGS_CRITICAL]
    + [f"SELECT 'range[{lo:g},{hi:g}]' AS rule, '{c}' AS column_name, checked_rows, v_rg_{c} AS violations FROM a"
       for c, lo, hi in VALUE_RANGES if c in ("temperature_celsius", "humidity_percent")]))
def value_constraints(spark, sf_dir):
    return violation_counts(S.readings(spark, sf_dir), _reading_ranges(), S.READINGS_CRITICAL)


@query("quarantine_split", O.with_(O.SILVER) + """,
tagged AS (SELECT event_id, concat_ws('; ', """ + ", ".join(
    f"CASE WHEN {cond} THEN '{label}' END" for label, cond in _violation_cases_sql()) + """) AS dq_reasons
           FROM silver)
SELECT event_id, CASE WHEN dq_reasons = '' THEN 'valid' ELSE 'quarantine' END AS dq_status, dq_reasons
FROM tagged""")
def quarantine_split(spark, sf_dir):
    tagged = route(S.readings(spark, sf_dir), _reading_ranges(), S.READINGS_CRITICAL)
    return tagged.select("event_id", "dq_status", F.array_join("dq_reasons", "; ").alias("dq_reasons"))


@query("gold_uniqueness", O.with_(O.SILVER, O.NAMES, O.GOLD_DAILY) + f""",
t AS (SELECT (SELECT count(*) FROM gold_daily) AS total_rows,
             (SELECT count(*) FROM (SELECT DISTINCT city_name, country_code FROM gold_daily))
             AS distinct_rows)
SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_count,
       {_pct_sql('(total_rows - distinct_rows)', 'total_rows')} AS duplicate_rate FROM t""")
def gold_uniqueness(spark, sf_dir):
    # The daily grain held against the key of the all-time one: every further day of a city repeats it.
    return duplicate_stats(S.gold_metrics(spark, sf_dir, daily=True), ["city_name", "country_code"])


@query("freshness", O.with_(O.SILVER) + f"""
SELECT max(measurement_ts) AS last_data_update,
       datesub('hour', max(measurement_ts), {O.AS_OF}) AS hours_since_update FROM silver""")
def freshness_q(spark, sf_dir):
    from strata.operators.rules import freshness
    return freshness(S.readings(spark, sf_dir), "measurement_ts", S.fixed_ts(S.AS_OF))


# ---------------------------------------------------------------------------
# Merge, defaults, map-shaped documents, increments
# ---------------------------------------------------------------------------

def _parties(df, key, name, nation, balance):
    return df.select(F.col(key).alias("party_key"), F.col(name).alias("party_name"),
                     F.col(nation).alias("nation_key"), F.col(balance).alias("balance"))


@query("insert_if_absent", f"""
WITH existing AS (
  SELECT s_suppkey AS party_key, s_name AS party_name, s_nationkey AS nation_key, s_acctbal AS balance,
         TRUE AS is_active, {O.RUN_TS} AS created_at FROM supplier),
batch AS (
  SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key, c_acctbal AS balance
  FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier),
firsts AS (SELECT * FROM batch
           QUALIFY row_number() OVER (PARTITION BY party_key ORDER BY balance DESC, party_name) = 1)
SELECT * FROM existing
UNION ALL
SELECT party_key, party_name, nation_key, balance, TRUE AS is_active, {O.RUN_TS} AS created_at
FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.party_key = f.party_key)""")
def insert_if_absent(spark, sf_dir):
    now = S.fixed_ts(S.RUN_TS)
    existing = _parties(load(spark, sf_dir, "supplier"), "s_suppkey", "s_name", "s_nationkey", "s_acctbal") \
        .withColumns({"is_active": F.lit(True), "created_at": now})
    batch = _parties(load(spark, sf_dir, "customer"), "c_custkey", "c_name", "c_nationkey", "c_acctbal") \
        .unionByName(_parties(load(spark, sf_dir, "supplier"), "s_suppkey", "s_name", "s_nationkey",
                              "s_acctbal"))
    batch = batch.withColumns({"is_active": F.lit(None).cast("boolean"),
                               "created_at": F.lit(None).cast("timestamp_ntz")})
    batch = apply_defaults(batch, {"is_active": True, "created_at": "now"}, now=now)
    return insert_absent(existing, batch, ["party_key"], ["balance desc", "party_name"])


@query("column_defaults", f"""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNSPECIFIED') AS market_segment,
       TRUE AS is_active, {O.RUN_TS} AS registered_at
FROM customer""")
def column_defaults(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("market_segment"),
        F.lit(None).cast("boolean").alias("is_active"), F.lit(None).cast("timestamp_ntz").alias("registered_at"))
    return apply_defaults(c, {"market_segment": "UNSPECIFIED", "is_active": True, "registered_at": "now"},
                          now=S.fixed_ts(S.RUN_TS))


@query("stock_series", """
WITH docs AS (
  SELECT user_id AS stock_symbol, CAST(ts AS DATE) AS last_refreshed, ts AS ingestion_timestamp, event_id, props
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)
SELECT stock_symbol, last_refreshed, key AS series_key,
       CAST(json_extract_string(props, '$."' || key || '"') AS INTEGER) AS series_value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS meta_k
FROM (SELECT *, unnest(json_keys(props)) AS key FROM docs)""")
def stock_series(spark, sf_dir):
    docs = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("stock_symbol"), F.to_date("ts").alias("last_refreshed"),
        F.col("ts").alias("ingestion_timestamp"), "event_id",
        F.from_json("props", "map<string,string>").alias("series"))
    latest_docs = dedup_latest(docs, ["stock_symbol", "last_refreshed"],
                               ["ingestion_timestamp desc", "event_id desc"])
    with_meta = latest_docs.withColumn("meta_k", map_value("series", "k").try_cast("int"))
    return explode_series(with_meta, "series", ["stock_symbol", "last_refreshed", "meta_k"], "series_key",
                          value_alias="series_value").withColumn(
        "series_value", F.col("series_value").try_cast("int"))


@query("incremental_extract", """
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'""")
def incremental_extract(spark, sf_dir):
    from strata.sources.files import read_increment
    return read_increment(load(spark, sf_dir, "orders"), "o_orderdate", "2000-01-01 00:00:00")


# ---------------------------------------------------------------------------
# Write / read round trips (A1-A5, A11-A14, B1-B8): written to a fresh folder
# below the shared checkpoint folder, read back with explicit schemas.
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    from strata.session import scratch_path
    return scratch_path(spark, name)


@query("partitioned_write", O.with_(O.SILVER, O.NAMES) + """
SELECT n.country_code, count(*) AS records FROM silver s LEFT JOIN names n ON s.city_id = n.city_id
GROUP BY n.country_code""")
def partitioned_write(spark, sf_dir):
    from strata.sinks.files import read_back, write_layer
    path = _scratch(spark, "silver_weather")
    written = write_layer(S.silver_weather(spark, sf_dir), path, ["country_code"], cluster=True)
    counts = read_back(spark, path, "country_code")
    # Read-back verification: the files hold exactly what the write observed.
    total = counts.agg(F.sum("records")).first()[0]
    if total != written:
        raise RuntimeError(f"read-back {total} rows, wrote {written}")
    return counts


_DAY = "2024-01-15"


@query("date_partition_scan", f"""
SELECT event_id, ts, user_id, event_type, value, props,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM events WHERE CAST(ts AS DATE) = DATE '{_DAY}'""")
def date_partition_scan(spark, sf_dir):
    import datetime as dt

    from strata.sinks.files import write_landing
    from strata.sources.files import read_partitions
    events = load(spark, sf_dir, "events")
    root = _scratch(spark, "landing_events")
    write_landing(events, root, "ts", fmt="json")
    return read_partitions(spark, root, "json", events.schema, day=dt.date.fromisoformat(_DAY))


@query("csv_roundtrip", f"""
SELECT *, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' two' || chr(10) || 'lines, "q" \\n \\\\ end ' WHEN 2 THEN chr(13) || o_orderpriority
       END AS note, 'orders_extract' AS source, 'orders.csv' AS original_filename,
       DATE '2024-02-01' AS ingestion_date, '2024' AS year, '02' AS month, '01' AS day
FROM orders""")
def csv_roundtrip(spark, sf_dir):
    from pyspark.sql import types as T

    from strata.sinks.files import land_csv
    from strata.sources.files import read_landed_csv
    turn = F.pmod(F.col("o_orderkey"), F.lit(4))
    orders = load(spark, sf_dir, "orders").withColumn(
        "note", F.when(turn == 0, "").when(turn == 1, ' two\nlines, "q" \\n \\\\ end ')
        .when(turn == 2, F.concat(F.lit("\r"), F.col("o_orderpriority"))))
    root = _scratch(spark, "landing_orders")
    land_csv(orders, root, "orders_extract", "orders.csv", F.to_date(F.lit("2024-02-01")), "ingestion_date")
    schema = T.StructType([*orders.schema.fields, T.StructField("source", T.StringType()),
                           T.StructField("original_filename", T.StringType()),
                           T.StructField("ingestion_date", T.DateType())])
    return read_landed_csv(spark, root, schema)


@query("csv_by_header", """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
       o_orderpriority, NULL::VARCHAR AS o_clerk, o_orderkey % 50 = 0 AS corrupt
FROM orders""")
def csv_by_header(spark, sf_dir):
    """Columns in another order, one unknown, one missing, some values of another type."""
    from pyspark.sql import types as T

    from strata.sources.files import read_csv
    orders = load(spark, sf_dir, "orders")
    path = _scratch(spark, "orders_csv")
    price = F.when(F.pmod("o_orderkey", F.lit(50)) == 0, "unknown").otherwise(F.col("o_totalprice").cast("string"))
    orders.select("o_orderpriority", price.alias("o_totalprice"), F.lit("x").alias("other"), "o_orderdate", "o_custkey",
                  "o_orderkey", "o_orderstatus").write.option("header", "true").csv(path)
    schema = T.StructType([*orders.schema.fields, T.StructField("o_clerk", T.StringType())])
    out = read_csv(spark, path, schema, required=["o_orderkey", "o_totalprice"])
    return out.withColumn("corrupt", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


@query("envelope_roundtrip", """
SELECT *, '2024-02-01T00:00:00.000000' AS meta_extraction_timestamp FROM orders""")
def envelope_roundtrip(spark, sf_dir):
    from pyspark.sql import types as T

    from strata.sinks.files import write_envelopes
    from strata.sources.files import read_json_lines
    from strata.sources.payloads import read_envelope
    orders = load(spark, sf_dir, "orders")
    path = _scratch(spark, "orders_envelope")
    write_envelopes(orders, path, S.fixed_ts(S.RUN_TS), chunk_rows=1000)
    schema = T.StructType([
        T.StructField("data", T.ArrayType(orders.schema)),
        T.StructField("metadata", T.StructType([
            T.StructField("row_count", T.LongType()), T.StructField("columns", T.ArrayType(T.StringType())),
            T.StructField("extraction_timestamp", T.StringType())])),
    ])
    rows = read_envelope(read_json_lines(spark, path, schema))
    return rows.drop("meta_row_count", "meta_columns")


@query("catalog_views", O.with_(O.SILVER, O.NAMES, O.GOLD) + """
SELECT city_name, country_code, max_temperature AS highest_temp, min_temperature AS lowest_temp,
       max_temperature - min_temperature AS temperature_range, avg_temperature
FROM gold WHERE max_temperature - min_temperature > 5""")
def catalog_views(spark, sf_dir):
    from strata.sinks.files import write_layer
    from strata.sources.catalog import create_namespace, register_product_views, register_table, repair
    base = _scratch(spark, "warehouse")
    gold_path = base + "/gold/aggregated_weather_metrics"
    write_layer(S.gold_metrics(spark, sf_dir), gold_path)
    previous = spark.catalog.currentDatabase()
    try:
        create_namespace(spark, "strata_wh", location=base + "/db")
        table = register_table(spark, "strata_wh.aggregated_weather_metrics", gold_path)
        repair(spark, "strata_wh.aggregated_weather_metrics")
        register_product_views(spark, table)
        return spark.sql("SELECT * FROM v_weather_extremes")
    finally:
        spark.sql(f"USE `{previous}`")


# ---------------------------------------------------------------------------
# Structured Streaming (S1-S3): availableNow runs over the table files
# ---------------------------------------------------------------------------

@query("stream_incremental", "SELECT * FROM events")
def stream_incremental(spark, sf_dir):
    from strata.streaming.incremental import stream_land
    schema = load(spark, sf_dir, "events").schema
    out = _scratch(spark, "stream_land")
    for _ in range(2):
        # The second run over the same checkpoint finds nothing new: no repeats.
        stream_land(spark, sf_dir, schema, out + "/data", out + "/_checkpoint", pathGlobFilter="events.parquet")
    return spark.read.schema(schema).parquet(out + "/data")


@query("stream_dedup", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def stream_dedup_q(spark, sf_dir):
    from strata.streaming.incremental import read_deduped, stream_dedup
    keys = ["l_orderkey", "l_linenumber"]
    out = _scratch(spark, "stream_dedup")
    # Every row in two of four parts, a micro-batch each and two runs: all keys come again, some of them with an earlier
    # time, and ship dates span years. A part has as many files as the scan has tasks, so no task grows with the table.
    shipped = F.col("l_shipdate").cast("timestamp")
    part = F.pmod(F.xxhash64(*keys), F.lit(4)).cast("int")
    copies = F.explode(F.array(F.struct(part.alias("part"), shipped.alias("event_time")),
                               F.struct(((part + 1) % 4).alias("part"), F.date_sub(shipped, 400).cast("timestamp").alias("event_time"))))
    rows = load(spark, sf_dir, "lineitem").select(*keys, copies.alias("c")).select(*keys, "c.event_time", "c.part")
    schema, source = rows.drop("part").schema, out + "/source"
    for run in range(2):
        sizes = []
        for i in (2 * run, 2 * run + 1):  # one after the other: files are taken by age
            rows.where(F.col("part") == i).drop("part").write.mode("append").parquet(source)
            sizes.append(len(spark.read.schema(schema).parquet(source).inputFiles()))
        stream_dedup(spark, source, schema, keys, "event_time", None, out + "/data", out + "/_checkpoint",
                     buckets=8, max_files_per_trigger=max(sizes[1] - sizes[0], 1))
    return read_deduped(spark, out + "/data", schema).select(*keys)


@query("stream_merge", """
SELECT *, CAST(ts AS DATE) AS event_date FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1""")
def stream_merge_q(spark, sf_dir):
    from strata.streaming.incremental import stream_merge
    schema = load(spark, sf_dir, "events").schema
    out = _scratch(spark, "stream_merge")
    stream_merge(spark, sf_dir, schema, ["user_id", "ts", "event_date"], ["event_id desc"], "event_date", F.to_date("ts"),
                 out + "/table", out + "/_checkpoint", pathGlobFilter="events.parquet")
    return spark.read.parquet(out + "/table")


@query("json_array_scan", "SELECT * FROM events")
def json_array_scan(spark, sf_dir):
    """Bronze objects as one-line JSON arrays of documents, read back over
    the whole prefix (each array line unwraps to one row per document)."""
    from strata.sinks.files import write_json_arrays
    from strata.sources.files import read_json_lines
    events = load(spark, sf_dir, "events")
    path = _scratch(spark, "json_arrays")
    write_json_arrays(events, path, chunk_rows=500)
    return read_json_lines(spark, path, events.schema)


@query("payload_triage", """
SELECT CASE WHEN event_type = 'error' THEN 'Error Message'
            WHEN value > 100 THEN 'Note' END AS reject_reason,
       count(*) AS payloads
FROM events GROUP BY 1""")
def payload_triage(spark, sf_dir):
    from strata.sources.payloads import triage
    # error events stand in for error payloads, extreme values for rate-limit notes
    payloads = load(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit("bad request")).alias("Error Message"),
        F.when(F.col("value") > 100, F.lit("call frequency")).alias("Note"))
    return group_profile(triage(payloads), ["reject_reason"], {"payloads": F.count(F.lit(1))})


@query("distinct_partitions", O.with_(O.SILVER, O.NAMES) + """
SELECT DISTINCT n.country_code FROM silver s LEFT JOIN names n ON s.city_id = n.city_id""")
def distinct_partitions(spark, sf_dir):
    # distinct cities first (partial dedup), then their countries
    cities = S.readings(spark, sf_dir).select("city_id").distinct()
    return cities.join(S.city_names(spark, sf_dir), "city_id", "left").select("country_code").distinct()


# ---------------------------------------------------------------------------
# The warehouse day by day, typed stock bars, table constraints, report files
# ---------------------------------------------------------------------------

_WEATHER_RAW = """
WITH raw AS (
  SELECT event_id, event_id % 3 AS d, user_id AS city_id, 'City ' || user_id AS city_name,
         list_value('NO', 'SE', 'FR')[user_id % 3 + 1] AS country_code, value / 7 AS t, value / 7 - 1 AS t_min,
         value / 7 + 1 AS t_max, value / 11 AS wind, 900 + event_id % 100 AS pressure,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
         datesub('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS dt
  FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
daily AS (SELECT *, t BETWEEN -50 AND 60 AND wind BETWEEN 0 AND 100 AND humidity BETWEEN 0 AND 100 AS valid FROM raw
          QUALIFY row_number() OVER (PARTITION BY d, city_id, dt ORDER BY event_id DESC) = 1),
merged AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY valid, city_id, dt ORDER BY d DESC, event_id DESC) = 1)"""


def _land_weather(spark, sf_dir, root, day_of, name=None):
    """Events landed as nested JSON lines of weather documents, on the day ``day_of`` (a number) of March 2024."""
    import datetime as dt

    from strata.sinks.files import write_landing
    from strata.sources.files import TS_FORMAT
    n, city, value = F.col("event_id"), F.col("user_id"), F.col("value")
    landed = F.timestamp_micros(F.unix_micros(F.date_add(F.lit(dt.date(2024, 3, 1)), day_of.cast("int")).cast("timestamp")) + n)
    docs = S.bronze_events(spark, sf_dir).select(
        city.alias("id"), (F.concat(F.lit("City "), city.cast("string")) if name is None else name).alias("name"),
        F.struct((value / 7).alias("temp"), (value / 7 - 1).alias("temp_min"), (value / 7 + 1).alias("temp_max"),
                 (900 + n % 100).alias("pressure"), F.col("props.k").alias("humidity")).alias("main"),
        F.struct((value / 11).alias("speed")).alias("wind"), F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("dt"),
        F.struct(F.element_at(F.array(F.lit("NO"), F.lit("SE"), F.lit("FR")), (city % 3 + 1).cast("int")).alias("country")).alias("sys"),
        F.date_format(landed, TS_FORMAT).alias("ingestion_timestamp"), landed.alias("landed_at"))
    write_landing(docs, root, "landed_at")


def _run_days(spark, base, days):
    import datetime as dt

    from strata.plans.daily import run_day
    from strata.sinks.snapshots import Lake
    lake = Lake(spark, base + "/lake")
    for i in range(days):
        run_day(lake, base + "/bronze", dt.date(2024, 3, 1 + i), F.lit(S.RUN_TS).cast("timestamp"))
    return lake


@query("weather_days", _WEATHER_RAW + f""",
first AS (SELECT city_id, min(d) AS d FROM merged WHERE valid GROUP BY city_id),
keys AS (SELECT city_id, row_number() OVER (ORDER BY d, city_id) AS dim_city_key FROM first)
SELECT city_name, country_code, {O.r('avg(t) FILTER (valid)')} AS avg_temperature,
       {O.r('min(t_min) FILTER (valid)')} AS min_temperature, {O.r('max(t_max) FILTER (valid)')} AS max_temperature,
       {O.r('avg(humidity) FILTER (valid)')} AS avg_humidity, {O.r('avg(pressure) FILTER (valid)')} AS avg_pressure,
       {O.r('avg(wind) FILTER (valid)')} AS avg_wind_speed, count(*) FILTER (valid) AS measurement_count,
       count(*) FILTER (NOT valid) AS quarantined, max(dim_city_key) AS dim_city_key,
       arg_max(t, dt) FILTER (valid) AS current_temp, arg_max(humidity, dt) FILTER (valid) AS current_humidity,
       max(dt) FILTER (valid) AS measurement_timestamp
FROM merged LEFT JOIN keys USING (city_id) GROUP BY city_name, country_code HAVING count(*) FILTER (valid) > 0""")
def weather_days(spark, sf_dir):
    """Events landed over three days; the layers built day by day from what each day touches."""
    base = _scratch(spark, "weather_days")
    _land_weather(spark, sf_dir, base + "/bronze", F.pmod("event_id", F.lit(3)))
    now = _run_days(spark, base, 3).snapshot()
    bad = now.table("silver_quarantine").groupBy("city_name").agg(F.count(F.lit(1)).alias("quarantined"))
    keys = now.table("dim_city").select("city_name", "dim_city_key")
    trends = now.table("weather_trends").drop("country_code", "weather_condition")
    gold = now.table("aggregated_weather_metrics").drop("last_updated").join(trends, "city_name", "left")
    gold = gold.join(keys, "city_name", "left").join(bad, "city_name", "left")
    return gold.withColumn("quarantined", F.coalesce("quarantined", F.lit(0)))


@query("city_renames", """
WITH raw AS (
  SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 1 ELSE event_id % 2 END AS d, user_id AS city_id,
         CASE WHEN user_id % 3 = 0 AND ts >= TIMESTAMP '2024-01-12 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'
              THEN 'Town ' ELSE 'City ' END || user_id AS city_name,
         value / 7 BETWEEN -50 AND 60 AND value / 11 BETWEEN 0 AND 100
           AND CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 0 AND 100 AS valid,
         datesub('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS dt
  FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
daily AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY d, city_id, dt ORDER BY event_id DESC) = 1),
seen AS (SELECT * FROM daily WHERE valid QUALIFY row_number() OVER (PARTITION BY city_id, dt ORDER BY d DESC, event_id DESC) = 1),
keys AS (SELECT city_id, row_number() OVER (ORDER BY min(d), city_id) AS dim_city_key FROM seen GROUP BY city_id),
marked AS (SELECT *, CASE WHEN lag(city_name) OVER w = city_name THEN 0 ELSE 1 END AS begins FROM seen WINDOW w AS (PARTITION BY city_id ORDER BY dt)),
runs AS (SELECT *, sum(begins) OVER (PARTITION BY city_id ORDER BY dt) AS run FROM marked),
spells AS (SELECT city_id, city_name, run, min(dt) AS lo, max(dt) AS hi FROM runs GROUP BY ALL)
SELECT dim_city_key, city_id, city_name, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(lo) AS valid_from,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds(lead(lo) OVER (PARTITION BY city_id ORDER BY lo)) AS valid_to,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds(hi) AS last_seen
FROM spells JOIN keys USING (city_id)""")
def city_renames(spark, sf_dir):
    """Two landed days: some (smaller) city ids arrive on the second only, some cities are renamed for ten days and
    back, and the second day's readings lie between those of the first. Keys stay; the history has every spell."""
    base = _scratch(spark, "city_renames")
    day = F.when(F.col("user_id") % 5 == 0, 1).otherwise(F.pmod("event_id", F.lit(2)))
    renamed = (F.col("user_id") % 3 == 0) & (F.col("ts") >= "2024-01-12") & (F.col("ts") < "2024-01-22")
    name = F.concat(F.when(renamed, "Town ").otherwise("City "), F.col("user_id").cast("string"))
    _land_weather(spark, sf_dir, base + "/bronze", day, name)
    spans = _run_days(spark, base, 2).snapshot().table("city_history")
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to", "last_seen")}
    return spans.withColumns(ntz).drop("country_code", "latitude", "longitude")


@query("lake_rollback", """
SELECT o_orderkey, o_custkey, o_totalprice, 1 AS version FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 2 FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 3 FROM orders WHERE o_orderkey % 2 = 0""")
def lake_rollback(spark, sf_dir):
    """Two loads, a third one that its gate stops, and a rollback to the first: all versions can be read."""
    from strata.operators.rules import QualityGateError, gate
    from strata.sinks.snapshots import Lake
    lake = Lake(spark, _scratch(spark, "lake_rollback"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    even = F.col("o_orderkey") % 2 == 0
    lake.begin().replace("orders", orders.where(even)).commit()
    lake.begin().append("orders", orders.where(~even)).commit()
    change = lake.begin().replace("orders", orders.withColumn("o_custkey", F.lit(None).cast("long")))
    try:
        gate(null_threshold_check(spark, null_rates(change.staged("orders")), [("silver", "o_custkey", 0.0)], "silver"))
        change.commit()
    except QualityGateError:
        lake.rollback(1)
    return reduce(DataFrame.unionByName, [lake.snapshot(v).table("orders").withColumn("version", F.lit(v)) for v in lake.versions()])


def stock_payloads(spark, sf_dir):
    """Events as landed stock payloads."""
    from strata.schemas import STOCK_BAR_FIELDS, STOCK_META_REFRESHED, STOCK_META_SYMBOL
    day, text = F.to_date("ts"), lambda c: c.cast("string")

    def bar(v):
        values = (v, v + 1, v - 1, v, F.col("event_id"))
        return F.create_map(*[x for (key, _, _), c in zip(STOCK_BAR_FIELDS, values) for x in (F.lit(key), text(c))])

    return load(spark, sf_dir, "events").select(
        F.create_map(F.lit(STOCK_META_SYMBOL), text(F.col("event_id")), F.lit(STOCK_META_REFRESHED), text(day)).alias("Meta Data"),
        F.create_map(text(day), bar(F.col("value")), text(F.date_sub(day, 1)), bar(F.col("value") + 0.5)).alias("Time Series (Daily)"),
        text(F.col("user_id")).alias("symbol"), text(F.col("ts")).alias("ingestion_timestamp"),
        F.when(F.col("event_type") == "error", F.lit("bad request")).alias("Error Message"),
        F.when(F.col("value") > 100, F.lit("call frequency")).alias("Note"))


@query("stock_bars", """
WITH docs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS stock_symbol, CAST(ts AS DATE) AS day, ts, value,
         CASE WHEN event_type = 'error' THEN 'Error Message' WHEN value > 100 THEN 'Note' END AS reject_reason
  FROM events),
kept AS (SELECT * FROM docs WHERE reject_reason IS NULL
         QUALIFY row_number() OVER (PARTITION BY stock_symbol, day ORDER BY ts DESC, CAST(event_id AS VARCHAR)) = 1),
bars AS (SELECT stock_symbol, day AS trade_date, day, event_id, value AS v FROM kept
         UNION ALL SELECT stock_symbol, CAST(day - 1 AS DATE), day, event_id, value + 0.5 FROM kept)
SELECT stock_symbol, trade_date, v AS open, v + 1 AS high, v - 1 AS low, v AS close, event_id AS volume, NULL::VARCHAR AS reject_reason
FROM bars QUALIFY row_number() OVER (PARTITION BY stock_symbol, trade_date ORDER BY day DESC) = 1
UNION ALL
SELECT stock_symbol, NULL, NULL, NULL, NULL, NULL, NULL, reject_reason FROM docs WHERE reject_reason IS NOT NULL""")
def stock_bars(spark, sf_dir):
    """Documents of two days each: a day's bar is corrected by the next day's document."""
    from strata.plans.warehouse import stock_silver
    docs = stock_payloads(spark, sf_dir)
    _, bars, rejected = stock_silver(docs, S.fixed_ts(S.RUN_TS))
    bars, rejected = S.stored(bars, "stock_bars"), S.stored(
        rejected.select(F.col("symbol").alias("stock_symbol"), "reject_reason"), "stock_rejected")
    return bars.unionByName(rejected, allowMissingColumns=True)


@query("insert_constraints", """
WITH c AS (SELECT c_custkey, c_nationkey, nullif(c_mktsegment, 'BUILDING') AS market_segment FROM customer),
g AS (SELECT count(*) - 1 AS n FROM c WHERE market_segment IS NOT NULL GROUP BY c_nationkey, market_segment)
SELECT 'not_null' AS rule, 'c_custkey' AS columns, count_if(c_custkey IS NULL)::BIGINT AS violations FROM c
UNION ALL SELECT 'not_null', 'market_segment', count_if(market_segment IS NULL)::BIGINT FROM c
UNION ALL SELECT 'unique', 'c_custkey', (count(*) - count(DISTINCT c_custkey))::BIGINT FROM c
UNION ALL SELECT 'unique', 'c_nationkey,market_segment', coalesce(sum(n), 0)::BIGINT FROM g""")
def insert_constraints(spark, sf_dir):
    from strata.operators.joins import constraint_violations
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("market_segment"))
    return constraint_violations(c, ["c_custkey", "market_segment"], [["c_custkey"], ["c_nationkey", "market_segment"]])


@query("report_write", f"SELECT *, 'run-1' AS run_id FROM ({_profile_sql()}) AS report")
def report_write(spark, sf_dir):
    from strata.sinks.files import write_report
    path = _scratch(spark, "reports")
    write_report(quality_profile(spark, sf_dir), path, "run-1")
    return spark.read.schema("dataset string, column_name string, metric string, value double, run_id string").json(path)


from strata.plans import lake_queries  # noqa: E402,F401 - registers its queries
