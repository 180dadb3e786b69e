"""The weather warehouse end to end on a literal bronze fixture."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import QualityGateError

from strata.plans import products as P
from strata.plans.warehouse import build_layers, city_dimension, weather_metrics, weather_silver, weather_trends
from strata.schemas import WEATHER_BRONZE
from strata.sources import read_bronze

T0 = 1_704_067_200  # 2024-01-01T00:00:00Z


def doc(id_, name, country, temp, dt_, ingested="2024-01-01T01:00:00.000001", **extra):
    d = {
        "id": id_, "name": name, "coord": {"lat": 59.91, "lon": 10.75},
        "weather": [{"main": "Clouds", "description": "overcast"}],
        "main": {"temp": temp, "feels_like": temp, "temp_min": None if temp is None else temp - 1,
                 "temp_max": None if temp is None else temp + 1, "pressure": 1012, "humidity": 70},
        "wind": {"speed": 3.5}, "clouds": {"all": 75}, "dt": dt_, "sys": {"country": country},
        "ingestion_timestamp": ingested,
    }
    d.update(extra)
    return d


def fixture_docs():
    return [
        doc(1, "Oslo", "NO", 5.0, T0),
        doc(1, "Oslo", "NO", 6.0, T0 + 3600),
        doc(1, "Oslo", "NO", 9.0, T0 + 3600, ingested="2024-01-01T02:00:00"),  # newer twin wins
        doc(2, "Bergen", "NO", 20.0, T0, weather=[]),                          # empty array -> NULL condition
        {k: v for k, v in doc(3, "Paris", "FR", 15.0, T0).items() if k != "weather"},
        {k: v for k, v in doc(4, "Lyon", "FR", 12.0, T0).items() if k != "coord"},
        doc(5, "Rome", "IT", None, T0),                                        # NULL temp -> dropped
        doc(None, "Nowhere", "XX", 10.0, T0),                                  # NULL id -> dropped
        doc(6, "Null Country", None, 25.0, T0),
        doc(7, "Turin", "IT", 30.0, T0, ingested="2024-01-01T05:00:00"),
        doc(7, "Turin", "IT", None, T0, ingested="2024-01-01T06:00:00"),       # NULL twin must not win
        doc(3_000_000_000, "Overflow", "US", 10.0, T0),                        # id above int range -> NULL
        doc(8, "Paris", "US", 28.0, T0),                                       # same name, other country
        doc(9, "Kyiv", "UA", 65.0, T0, ingested="not a time"),                 # out of range, bad timestamp
    ]


def write_fixture(tmp, null_country=True):
    root = os.path.join(tmp, "bronze", "weather", "year=2024", "month=01", "day=01")
    os.makedirs(root)
    docs = [d for d in fixture_docs() if null_country or d["sys"]["country"] is not None]
    with open(os.path.join(root, "weather_1.json"), "w") as fh:
        fh.write(json.dumps(docs))  # one-line array, as landed
    with open(os.path.join(root, "weather_2.json"), "w") as fh:
        fh.write(json.dumps([doc(10, "Oslo", "SE", 10.0, T0)], indent=2))  # indented array
    return os.path.join(tmp, "bronze", "weather")


def test_weather_silver_rules(spark, tmp):
    root = write_fixture(tmp)
    bronze = read_bronze(spark, root, "json", WEATHER_BRONZE, multiLine="true")
    silver = weather_silver(bronze, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    rows = {(r.city_id, r.measurement_timestamp): r for r in silver.collect()}
    assert (1, T0 + 3600) in rows and rows[(1, T0 + 3600)].temperature_celsius == 9.0
    assert rows[(2, T0)].weather_condition is None
    assert rows[(3, T0)].weather_condition is None and rows[(4, T0)].latitude is None
    assert all(k[0] not in (5, None) for k in rows)
    assert rows[(7, T0)].temperature_celsius == 30.0
    assert rows[(6, T0)].country_code is None
    assert rows[(9, T0)].ingestion_timestamp is None
    assert len(rows) == 10  # the over-range id became NULL and was dropped


def test_gold_tables(spark, tmp):
    root = write_fixture(tmp)
    silver = weather_silver(read_bronze(spark, root, "json", WEATHER_BRONZE, multiLine="true"),
                            F.lit("2024-01-02 00:00:00").cast("timestamp"))
    metrics = {(r.city_name, r.country_code): r for r in weather_metrics(silver).collect()}
    oslo = metrics[("Oslo", "NO")]
    assert (oslo.avg_temperature, oslo.min_temperature, oslo.max_temperature, oslo.measurement_count) == (7.0, 4.0, 10.0, 2)
    assert ("Paris", "FR") in metrics and ("Paris", "US") in metrics
    trends = {r.city_name: r for r in weather_trends(silver).collect()}
    assert trends["Oslo"].measurement_timestamp == T0 + 3600
    dim = city_dimension(silver).collect()
    assert sorted(r.dim_city_key for r in dim) == list(range(1, len(dim) + 1))
    assert len({r.city_id for r in dim}) == len(dim)
    zones = {r.climate_zone: r.city_count for r in P.climate_zones(weather_metrics(silver)).collect()}
    assert zones["Cold"] >= 1 and zones["Warm"] >= 1


def test_gate_stops_on_null_country_rate(spark, tmp):
    root = write_fixture(tmp)
    with pytest.raises(QualityGateError, match="country_code"):  # 1 of 9 rows = 11.11 % > 5 %
        build_layers(spark, root, os.path.join(tmp, "silver"), os.path.join(tmp, "gold"),
                     day=dt.date(2024, 1, 1), processed_at=F.lit("2024-01-02 00:00:00").cast("timestamp"), multiline=True)
    assert not os.path.exists(os.path.join(tmp, "silver"))  # nothing is published before the gate


def test_build_layers_with_quarantine_and_gate(spark, tmp):
    root = write_fixture(tmp, null_country=False)
    res = build_layers(spark, root.rsplit("/weather", 1)[0] + "/weather", os.path.join(tmp, "silver"),
                       os.path.join(tmp, "gold"), day=dt.date(2024, 1, 1),
                       processed_at=F.lit("2024-01-02 00:00:00").cast("timestamp"),
                       quarantine_path=os.path.join(tmp, "quarantine"), multiline=True)
    assert res.quarantined_rows == 1  # Kyiv at 65 degrees
    assert res.silver_rows == 8
    assert res.gold_rows["dim_city"] == 7  # 8 readings, Oslo (id 1) twice
    gold = spark.read.parquet(os.path.join(tmp, "gold", "aggregated_weather_metrics"))
    assert gold.where("city_name = 'Oslo'").count() == 2  # NO and SE


def land(tmp, day, docs):
    root = os.path.join(tmp, "bronze", "weather")
    folder = os.path.join(root, "year=2024", "month=01", f"day={day:02d}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part.json"), "w") as fh:
        fh.writelines(json.dumps(d) + "\n" for d in docs)
    return root


def test_days_add_up_and_reruns_change_nothing(spark, tmp):
    """JSON lines over three days: silver, gold and quarantine equal one run over all days."""
    day = 86400
    land(tmp, 1, [doc(1, "Oslo", "NO", 5.0, T0), doc(2, "Bergen", "NO", 7.123456, T0), doc(3, "Paris", "FR", 9.0, T0),
                  doc(4, "Kyiv", "UA", 65.0, T0)])
    land(tmp, 2, [doc(1, "Oslo", "NO", 6.0, T0 + day, ingested="2024-01-02T01:00:00"),
                  doc(3, "Paris", "FR", 8.0, T0, ingested="2024-01-02T01:00:00")])  # late correction of day 1
    root = land(tmp, 3, [doc(1, "Oslo", "NO", 70.0, T0 + 2 * day, ingested="2024-01-03T01:00:00")])
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")

    def tables(name):
        read = lambda p: sorted(map(str, (r.asDict() for r in spark.read.parquet(os.path.join(tmp, name, p)).drop("dim_city_key").collect())))
        return {p: read(p) for p in ("silver", "silver_quarantine", "gold/aggregated_weather_metrics", "gold/weather_trends", "gold/dim_city")}

    run = lambda name, d=None: build_layers(spark, root, os.path.join(tmp, name, "silver"), os.path.join(tmp, name, "gold"), day=d, processed_at=at)
    first = run("daily", dt.date(2024, 1, 1))
    assert (first.silver_rows, first.quarantined_rows) == (3, 1)
    run("daily", dt.date(2024, 1, 2))
    run("daily", dt.date(2024, 1, 3))
    daily = tables("daily")
    assert len(daily["silver"]) == 4 and len(daily["silver_quarantine"]) == 2
    run("daily", dt.date(2024, 1, 1))
    run("daily", dt.date(2024, 1, 3))
    assert tables("daily") == daily
    run("whole")
    assert tables("whole") == daily


def test_newest_stock_document_wins(spark):
    from strata.plans.warehouse import stock_silver
    from strata.schemas import STOCK_BRONZE
    from strata.schemas import STOCK_META_REFRESHED as REFRESHED
    from strata.schemas import STOCK_META_SYMBOL as SYMBOL

    bar = lambda close: {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": close, "5. volume": "10"}
    docs = [{"symbol": "A", "Meta Data": {SYMBOL: "A", REFRESHED: f"2024-01-0{n}"}, "ingestion_timestamp": f"2024-01-0{n}T05:00:00",
             "Time Series (Daily)": {"2024-01-01": bar(close)}} for n, close in ((1, "11.0"), (2, "10.0"))]
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    bronze = lines.select(F.from_json("value", STOCK_BRONZE).alias("d")).select("d.*")
    bars = stock_silver(bronze)[1].collect()
    assert [b["close"] for b in bars] == [10.0]
