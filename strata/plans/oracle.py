"""Independent SQL (DuckDB dialect) for the registered queries.

The CTEs restate the stand-in layers of ``strata.plans.standin`` in plain
SQL so every Spark result can be checked against a second engine.

Rounding: Spark rounds a double half-up on its shortest decimal text
(33.714999999999996 -> 33.71); DuckDB's ``round(double)`` works on the
scaled binary value. ``r(x, d)`` rounds the shortest text as a DECIMAL,
which is Spark's rule.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "TIMESTAMP '2024-02-03 07:30:00'"


def r(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


SILVER = f"""
silver AS (
  SELECT event_id, user_id AS city_id, ts AS measurement_ts, value AS temperature_celsius,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity_percent,
         event_type AS weather_condition, {RUN_TS} AS processing_timestamp
  FROM events
  WHERE user_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1
)"""

NAMES = """
names AS (
  SELECT c_custkey AS city_id, c_name AS city_name, n_name AS country_code,
         c_acctbal AS account_balance, c_mktsegment AS market_segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def _gold(daily: bool) -> str:
    day_sel = "CAST(s.measurement_ts AS DATE) AS measurement_date," if daily else ""
    day_grp = ", CAST(s.measurement_ts AS DATE)" if daily else ""
    name = "gold_daily" if daily else "gold"
    return f"""
{name} AS (
  SELECT n.city_name, n.country_code, {day_sel}
         {r('avg(CAST(s.temperature_celsius AS DECIMAL(18,2)))')} AS avg_temperature,
         {r('min(s.temperature_celsius)')} AS min_temperature,
         {r('max(s.temperature_celsius)')} AS max_temperature,
         {r('avg(s.humidity_percent)')} AS avg_humidity,
         count(*) AS measurement_count,
         max(s.processing_timestamp) AS last_updated
  FROM silver s LEFT JOIN names n ON s.city_id = n.city_id
  GROUP BY s.city_id, n.city_name, n.country_code{day_grp}
)"""


GOLD = _gold(False)
GOLD_DAILY = _gold(True)

TRENDS = """
trends AS (
  SELECT n.city_name, n.country_code, s.temperature_celsius AS current_temp,
         s.humidity_percent AS current_humidity, s.weather_condition,
         s.measurement_ts AS measurement_timestamp
  FROM (SELECT * FROM silver
        QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY measurement_ts DESC, event_id DESC) = 1) s
  LEFT JOIN names n ON s.city_id = n.city_id
)"""

DIM = """
dim AS (
  SELECT row_number() OVER (ORDER BY city_id) AS dim_city_key, city_id, city_name, country_code,
         account_balance, market_segment
  FROM names
)"""


def ravg(col: str, digits: int = 2) -> str:
    """Exact (DECIMAL) mean of a 2-digit column, rounded half-up."""
    return r(f"avg(CAST({col} AS DECIMAL(18,2)))", digits)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
