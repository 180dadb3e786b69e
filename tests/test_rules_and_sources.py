"""Rules, payload triage, map documents, envelopes, file sources, sinks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import QualityGateError, freshness, gate, null_threshold_check, route, split, violation_counts
from strata.schemas import STOCK_BAR_FIELDS, TRANSACTIONS, VALUE_RANGES
from strata.sinks import envelopes, read_back, write_landing, write_layer
from strata.sources import (read_bronze, read_csv, read_envelope, read_partitions, register_table, repair,
                            split_payloads, triage)
from strata.operators.series import explode_series, map_value


def test_route_null_passes_range_fails_not_null(spark):
    df = spark.createDataFrame([(1, 20.0), (2, 70.0), (None, None)], "id int, temperature_celsius double")
    out = route(df, ranges=[("temperature_celsius", -50.0, 60.0)], not_null=["id"])
    got = {r.id: (r.dq_status, list(r.dq_reasons)) for r in out.collect()}
    assert got[1] == ("valid", [])
    assert got[2] == ("quarantine", ["temperature_celsius not in [-50, 60]"])
    assert got[None] == ("quarantine", ["id is null"])
    valid, bad = split(df, ranges=VALUE_RANGES[:1], not_null=["id"])
    assert valid.count() == 1 and bad.count() == 2
    counts = {(r.rule, r.column_name): r.violations for r in
              violation_counts(df, ranges=VALUE_RANGES[:1], not_null=["id"]).collect()}
    assert counts == {("not_null", "id"): 1, ("range[-50,60]", "temperature_celsius"): 1}


def test_thresholds_and_gate(spark):
    rates = spark.createDataFrame([("city_id", 0.0), ("country_code", 6.0), ("other", 50.0)],
                                  "column_name string, null_rate double")
    rules = [("silver", "city_id", 0.0), ("silver", "country_code", 5.0), ("gold", "*", 0.0)]
    checks = {r.column_name: r.passed for r in null_threshold_check(spark, rates, rules, "silver").collect()}
    assert checks == {"city_id": True, "country_code": False, "other": True}
    with pytest.raises(QualityGateError):
        gate(null_threshold_check(spark, rates, rules, "silver"))
    gold = {r.column_name: r.passed for r in null_threshold_check(spark, rates, rules, "gold").collect()}
    assert gold == {"city_id": True, "country_code": False, "other": False}


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 30),), (dt.datetime(2024, 1, 1, 8, 45),)], "t timestamp")
    r = freshness(df, "t", F.lit("2024-01-01 11:44:00").cast("timestamp")).first()
    assert r.last_data_update == dt.datetime(2024, 1, 1, 8, 45) and r.hours_since_update == 2


def _stock_rows():
    bar = {"1. open": "10.0", "2. high": "11.5", "3. low": "9.5", "4. close": "11.0", "5. volume": "1200"}
    meta = {"1. Information": "Daily", "2. Symbol": "ABC", "3. Last Refreshed": "2024-01-03"}
    return [
        {"Meta Data": meta, "Time Series (Daily)": {"2024-01-02": bar, "2024-01-03": bar}, "symbol": "ABC",
         "ingestion_timestamp": "2024-01-03T10:00:00"},
        {"Meta Data": meta, "Time Series (Daily)": {"2024-01-03": bar}, "symbol": "ABC",
         "ingestion_timestamp": "2024-01-03T11:00:00"},
        {"Error Message": "Invalid API call", "symbol": "BAD", "ingestion_timestamp": "2024-01-03T10:00:00"},
        {"Note": "rate limit", "symbol": "XYZ", "ingestion_timestamp": "2024-01-03T10:00:00"},
        {"Meta Data": {**meta, "2. Symbol": "EMP"}, "Time Series (Daily)": {}, "symbol": "EMP",
         "ingestion_timestamp": "2024-01-03T10:00:00"},
    ]


def test_stock_documents(spark, tmp):
    path = os.path.join(tmp, "stocks.json")
    with open(path, "w") as fh:
        fh.write(json.dumps(_stock_rows()))  # one-line JSON array
    from strata.plans.warehouse import read_stock_bronze, stock_silver
    bronze = read_stock_bronze(spark, path)
    assert {r.reject_reason for r in triage(bronze).collect()} == {None, "Error Message", "Note"}
    good, rejected = split_payloads(bronze)
    assert good.count() == 3 and rejected.count() == 2
    assert bronze.select(map_value("Meta Data", "2. Symbol").alias("s")).where("s = 'ABC'").count() == 2
    docs, bars, bad = stock_silver(bronze, F.lit("2024-02-01").cast("timestamp"))
    assert sorted((r.stock_symbol, str(r.last_refreshed)) for r in docs.collect()) == [
        ("ABC", "2024-01-03"), ("EMP", "2024-01-03")]
    got = sorted((r.stock_symbol, str(r.trade_date), r.close, r.volume) for r in bars.collect())
    assert got == [("ABC", "2024-01-03", 11.0, 1200)]  # latest document wins the (symbol, last_refreshed) dedup
    assert bad.count() == 2


def test_explode_series_raw_values(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {})], "id int, m map<string,string>")
    out = explode_series(df, "m", ["id"], "key", value_alias="v")
    assert sorted((r.id, r.key, r.v) for r in out.collect()) == [(1, "a", "1"), (1, "b", "2")]
    assert STOCK_BAR_FIELDS[3] == ("4. close", "double", "close")


def test_envelope_round_trip_bounded_chunks(spark):
    df = spark.range(0, 2500).repartition(3).withColumn("name", F.concat(F.lit("u"), F.col("id").cast("string")))
    env = envelopes(df, F.lit("2024-02-01 00:00:00").cast("timestamp"), chunk_rows=400)
    sizes = [r.metadata.row_count for r in env.collect()]
    assert max(sizes) <= 400 and sum(sizes) == 2500
    rows = read_envelope(env)
    assert rows.count() == 2500 and "meta_extraction_timestamp" in rows.columns


def test_read_bronze_json_shapes(spark, tmp):
    from strata.schemas import WEATHER_BRONZE
    doc = {"id": 1, "name": "Oslo", "coord": {"lat": 59.9, "lon": 10}, "main": {"temp": 3.5}, "dt": 100}
    one_line = os.path.join(tmp, "a")
    os.makedirs(one_line)
    with open(os.path.join(one_line, "x.json"), "w") as fh:
        fh.write(json.dumps([doc, {**doc, "id": 2}]))
    indented = os.path.join(tmp, "b")
    os.makedirs(indented)
    with open(os.path.join(indented, "x.json"), "w") as fh:
        fh.write(json.dumps([doc, {**doc, "id": 2}], indent=2))
    single = os.path.join(tmp, "c")
    os.makedirs(single)
    with open(os.path.join(single, "x.json"), "w") as fh:
        fh.write(json.dumps(doc, indent=2))
    lines = os.path.join(tmp, "d")
    os.makedirs(lines)
    with open(os.path.join(lines, "x.json"), "w") as fh:
        fh.write("\n".join(json.dumps({**doc, "id": i}) for i in (1, 2, 3)))
    with pytest.raises(ValueError, match="several JSON documents"):
        read_bronze(spark, lines, "json", WEATHER_BRONZE, multiLine="true")
    for path, n, multi in [(one_line, 2, "false"), (one_line, 2, "true"), (indented, 2, "true"), (single, 1, "true"), (lines, 3, "false")]:
        df = read_bronze(spark, path, "json", WEATHER_BRONZE, multiLine=multi)
        rows = df.collect()
        assert len(rows) == n
        assert rows[0].coord.lon == 10.0  # whole-number longitude stays double with the explicit schema
    with pytest.raises(ValueError):
        read_bronze(spark, one_line, "xml")


def test_read_csv_malformed_and_na(spark, tmp):
    path = os.path.join(tmp, "tx.csv")
    with open(path, "w") as fh:
        fh.write("transaction_id,customer_id,product,amount,timestamp,category\n")
        fh.write("T1,C1,Pen,12.50,2024-01-01 10:00:00,Office\n")
        fh.write("T2,C2,Cup,NA,2024-01-01 11:00:00,NA\n")
        fh.write("T3,C3,Hat,notanumber,2024-01-01 12:00:00,Wear\n")
    df = read_csv(spark, path, TRANSACTIONS, timestampFormat="yyyy-MM-dd HH:mm:ss")
    rows = {r.transaction_id: r for r in df.collect()}
    assert str(rows["T1"].amount) == "12.50"
    assert rows["T2"].category is None and rows["T2"].amount is None
    assert rows["T3"]._corrupt_record is not None


def test_dynamic_overwrite_keeps_other_partitions_and_null_partition(spark, tmp):
    path = os.path.join(tmp, "silver")
    day1 = spark.createDataFrame([(1, "NO"), (2, "SE"), (3, None)], "id int, country_code string")
    assert write_layer(day1, path, ["country_code"]) == 3
    day2 = spark.createDataFrame([(4, "NO")], "id int, country_code string")
    write_layer(day2, path, ["country_code"])
    got = sorted((r.id, r.country_code) for r in spark.read.parquet(path).collect())
    assert got == [(2, "SE"), (3, None), (4, "NO")]
    counts = {r.country_code: r.records for r in read_back(spark, path, "country_code").collect()}
    assert counts == {"SE": 1, None: 1, "NO": 1}


def test_landing_partitions_are_pruned(spark, tmp):
    root = os.path.join(tmp, "landing")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 5, 1)), (2, dt.datetime(2024, 1, 6, 2))],
                               "id int, ts timestamp_ntz")
    write_landing(df, root, "ts")
    assert sorted(os.listdir(os.path.join(root, "year=2024", "month=01"))) == ["day=05", "day=06"]
    part = read_partitions(spark, root, "json", df.schema, day=dt.date(2024, 1, 6))
    assert [(r.id, r.day) for r in part.collect()] == [(2, "06")]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_catalog_registration(spark, tmp):
    path = os.path.join(tmp, "gold")
    write_layer(spark.createDataFrame([("Oslo", 3.0)], "city_name string, avg_temperature double"), path)
    t = register_table(spark, "gold_tbl", path)
    assert t.count() == 1
    assert repair(spark, "gold_tbl") is False  # unpartitioned: nothing to repair


def test_read_increment_is_strict_and_drops_null_times(spark):
    from strata.sources import read_increment
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, None)], "id int, ts timestamp")
    assert read_increment(df, "ts", None).count() == 3
    assert [r.id for r in read_increment(df, "ts", "2024-01-01 00:00:00").collect()] == [2]


def test_land_stamps_and_source_file(spark, tmp):
    from strata.sources import land, with_source_file
    path = os.path.join(tmp, "p")
    spark.createDataFrame([(1,)], "id int").write.parquet(path)
    df = land(with_source_file(spark.read.parquet(path)), F.lit("2024-01-01").cast("timestamp"),
              city_search="London")
    r = df.first()
    assert r.city_search == "London" and r.source_file.endswith(".parquet")
    assert r.ingestion_timestamp == dt.datetime(2024, 1, 1)


def test_shuffle_sizing():
    from strata.session import shuffle_sizing
    assert shuffle_sizing(10 << 20, 8)["spark.sql.shuffle.partitions"] == "8"
    assert int(shuffle_sizing(100 << 40, 8000)["spark.sql.shuffle.partitions"]) == 409600


def test_clustered_write_splits_a_hot_value_by_size(spark, tmp):
    path = os.path.join(tmp, "clustered")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    df = spark.range(0, 3000).repartition(12).select(
        F.col("id"), F.when(F.col("id") < 2000, F.lit("HOT")).otherwise(F.lit("COLD")).alias("country_code"))
    try:
        assert write_layer(df, path, ["country_code"], cluster=True) == 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda v: len([f for f in os.listdir(os.path.join(path, f"country_code={v}")) if f.endswith(".parquet")])
    assert files("HOT") > 1 and files("COLD") < 12  # writers by size, not one per task
    assert spark.read.parquet(path).count() == 3000


def test_csv_required_columns(spark, tmp):
    from strata.operators import missing_required
    from strata.schemas import TRANSACTIONS_REQUIRED
    ok = os.path.join(tmp, "ok.csv")
    with open(ok, "w") as fh:
        fh.write("transaction_id,customer_id,product,amount,timestamp\nT1,C1,Pen,1.00,2024-01-01 00:00:00\n")
    bad = os.path.join(tmp, "bad.csv")
    with open(bad, "w") as fh:
        fh.write("transaction_id,customer_id,product,timestamp,category\nT1,C1,Pen,2024-01-01 00:00:00,X\n")
    assert missing_required(read_bronze(spark, ok, "csv"), TRANSACTIONS_REQUIRED) == []
    assert missing_required(read_bronze(spark, bad, "csv"), TRANSACTIONS_REQUIRED) == ["amount"]


def test_read_csv_binds_by_header(spark, tmp):
    from strata.schemas import TRANSACTIONS_REQUIRED
    path = os.path.join(tmp, "reordered.csv")
    with open(path, "w") as fh:
        fh.write("amount,product,extra,timestamp,customer_id,transaction_id\n12.50,Pen,x,2024-01-01 10:00:00,C1,T1\n"
                 "bad,Cup,x,2024-01-01 10:00:00,C2,T2\n")
    one, two = read_csv(spark, path, TRANSACTIONS, required=TRANSACTIONS_REQUIRED).orderBy("transaction_id").collect()
    assert (one.product, str(one.amount), one.customer_id, one.category, one._corrupt_record) == ("Pen", "12.50", "C1", None, None)
    assert two.amount is None and two._corrupt_record.startswith("bad,Cup")
    with pytest.raises(ValueError, match="category"):
        read_csv(spark, path, TRANSACTIONS, required=["category"])


def test_landed_csv_gives_texts_back(spark, tmp):
    from strata.sinks import land_csv
    from strata.sources.files import read_landed_csv
    texts = ["a\nb", "", None, "\\N", "\\n", "\\\\\n", " x ", 'q"u,o', "\r\n", "NA", "\\", '\\"']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("at", F.lit("2024-01-05").cast("timestamp_ntz"))
    root = os.path.join(tmp, "csv")
    land_csv(df, root, "src", "f.csv", F.to_date("at"), "at")
    schema = spark.createDataFrame([], "id int, t string, at timestamp_ntz, source string, original_filename string, ingestion_date date").schema
    got = sorted((r.id, r.t) for r in read_landed_csv(spark, root, schema).collect())
    assert got == list(enumerate(texts))


def test_partitioned_table_and_all_views(spark, tmp):
    from strata.sources.catalog import register_product_views
    path = os.path.join(tmp, "part")
    write_layer(spark.createDataFrame([(1, "NO"), (2, "SE")], "id int, country_code string"), path, ["country_code"])
    assert register_table(spark, "part_tbl", path).count() == 2  # partitions are found
    write_layer(spark.createDataFrame([(3, "FR")], "id int, country_code string"), path, ["country_code"])
    assert repair(spark, "part_tbl") is True
    assert spark.table("part_tbl").count() == 3
    spark.sql("DROP TABLE part_tbl")
    metrics = spark.createDataFrame([("Oslo", "NO", 4.0, -3.0, 9.0, 60.0, 1000.0)],
                                    "city_name string, country_code string, avg_temperature double, min_temperature double, max_temperature double, avg_humidity double, avg_pressure double")
    trends = spark.createDataFrame([("Oslo", "NO", 5.0, 50, "Rain")], "city_name string, country_code string, current_temp double, current_humidity int, weather_condition string")
    dim = spark.createDataFrame([("Oslo", "NO", 59.9, 10.7), ("Rome", "IT", 41.9, 12.5)], "city_name string, country_code string, latitude double, longitude double")
    assert register_product_views(spark, metrics, trends, dim) == ["v_city_climate_profile", "v_current_weather_summary", "v_weather_extremes"]
    assert spark.sql("SELECT temp_deviation FROM v_current_weather_summary").first()[0] == 1.0
    assert {r.city_name: r.climate_classification for r in spark.table("v_city_climate_profile").collect()} == {"Oslo": "Cold", "Rome": "Warm"}
    assert spark.table("v_weather_extremes").first().temperature_range == 12.0


def test_one_events_scan_per_report(spark):
    from strata.plans.registry import QUERIES
    for name in ("current_with_dimension", "climate_profile", "current_vs_history", "layer_counts"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("/events.parquet") <= 1, name
