"""Explicit schemas and declarative specs for the weather / stock / users domain.

Bronze is read with these schemas instead of inference: inference costs a
full extra pass over the data and types whole-number longitudes as bigint.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Bronze weather document (nested JSON)
# Field names of the weather API document and of the silver
# columns they map to (the names the reports and catalog tables use).
# ---------------------------------------------------------------------------
WEATHER_BRONZE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField(
            "coord",
            T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]),
        ),
        T.StructField(
            "weather",
            T.ArrayType(
                T.StructType(
                    [T.StructField("main", T.StringType()), T.StructField("description", T.StringType())]
                )
            ),
        ),
        T.StructField(
            "main",
            T.StructType(
                [
                    T.StructField("temp", T.DoubleType()),
                    T.StructField("feels_like", T.DoubleType()),
                    T.StructField("temp_min", T.DoubleType()),
                    T.StructField("temp_max", T.DoubleType()),
                    T.StructField("pressure", T.LongType()),
                    T.StructField("humidity", T.LongType()),
                ]
            ),
        ),
        T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
        T.StructField("clouds", T.StructType([T.StructField("all", T.LongType())])),
        T.StructField("dt", T.LongType()),
        T.StructField("sys", T.StructType([T.StructField("country", T.StringType())])),
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("city_search", T.StringType()),
    ]
)

# Flatten spec: (source path, target type, alias). A path of the form
# "array[0].field" takes the field of the first array element (NULL when the
# array is NULL or empty).
WEATHER_SILVER_SPEC: list[tuple[str, str, str]] = [
    ("id", "int", "city_id"),
    ("name", "string", "city_name"),
    ("coord.lat", "double", "latitude"),
    ("coord.lon", "double", "longitude"),
    ("main.temp", "double", "temperature_celsius"),
    ("main.feels_like", "double", "feels_like_celsius"),
    ("main.temp_min", "double", "temp_min_celsius"),
    ("main.temp_max", "double", "temp_max_celsius"),
    ("main.pressure", "int", "pressure_hpa"),
    ("main.humidity", "int", "humidity_percent"),
    ("wind.speed", "double", "wind_speed_mps"),
    ("clouds.all", "int", "cloudiness_percent"),
    ("weather[0].main", "string", "weather_condition"),
    ("weather[0].description", "string", "weather_description"),
    ("dt", "int", "measurement_timestamp"),
    ("sys.country", "string", "country_code"),
    ("ingestion_timestamp", "timestamp", "ingestion_timestamp"),
]

WEATHER_KEYS = ["city_id", "measurement_timestamp"]
WEATHER_CRITICAL = ["city_id", "temperature_celsius"]

# ---------------------------------------------------------------------------
# Bronze stock document (map-shaped; names contain dots and spaces)
# ---------------------------------------------------------------------------
STOCK_BRONZE = T.StructType(
    [
        T.StructField("Meta Data", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "Time Series (Daily)",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())),
        ),
        T.StructField("symbol", T.StringType()),
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("Error Message", T.StringType()),
        T.StructField("Note", T.StringType()),
    ]
)

# Key names of the stock API's metadata map and daily bar map.
STOCK_META_SYMBOL = "2. Symbol"
STOCK_META_REFRESHED = "3. Last Refreshed"
STOCK_BAR_FIELDS: list[tuple[str, str, str]] = [
    ("1. open", "double", "open"),
    ("2. high", "double", "high"),
    ("3. low", "double", "low"),
    ("4. close", "double", "close"),
    ("5. volume", "bigint", "volume"),
]

# ---------------------------------------------------------------------------
# CSV transactions and relational users
# Column names and types of both sources.
# ---------------------------------------------------------------------------
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("category", T.StringType()),
    ]
)
# Columns a transactions file must carry.
TRANSACTIONS_REQUIRED = ["transaction_id", "customer_id", "product", "amount", "timestamp"]

USERS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), False),
        T.StructField("username", T.StringType(), False),
        T.StructField("email", T.StringType(), False),
        T.StructField("full_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("registration_date", T.TimestampType()),
        T.StructField("last_login", T.TimestampType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
# Insert-time defaults of the users table ("now" = current timestamp).
USERS_DEFAULTS = {
    "registration_date": "now",
    "is_active": True,
    "created_at": "now",
    "updated_at": "now",
}

# ---------------------------------------------------------------------------
# Quality rules of the silver / gold weather tables
# ---------------------------------------------------------------------------
# Maximum null percentage per (layer, column); "*" = all columns.
NULL_THRESHOLDS: list[tuple[str, str, float]] = [
    ("silver", "city_id", 0.0),
    ("silver", "temperature_celsius", 0.0),
    ("silver", "country_code", 5.0),
    ("gold", "*", 0.0),
]

# Inclusive value ranges per column.
VALUE_RANGES: list[tuple[str, float, float]] = [
    ("temperature_celsius", -50.0, 60.0),
    ("humidity_percent", 0.0, 100.0),
    ("pressure_hpa", 800.0, 1100.0),
    ("wind_speed_mps", 0.0, 100.0),
    ("latitude", -90.0, 90.0),
    ("longitude", -180.0, 180.0),
    ("cloudiness_percent", 0.0, 100.0),
]
# Fixed value: characters of a country code.
COUNTRY_CODE_LENGTH = 2

# Climate classes by average temperature (lower bound inclusive
# ranges as in the SQL: < 10 cold, BETWEEN 10 AND 20 temperate, > 20 warm).
CLIMATE_COLD_BELOW = 10.0
CLIMATE_WARM_ABOVE = 20.0

# Numeric type names profiled by default (others are skipped).
PROFILED_TYPES = ("int", "bigint", "double", "float")
