"""Versioned tables, key indexes, stored marks, appends, daily runs, drift, profiles and gaps on literal fixtures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import QualityGateError, dimension
from strata.operators.joins import ConstraintError
from strata.operators.keys import KeyIndex
from strata.operators.sketches import distinct_values, merge_distinct, merge_profiles, profile_parts
from strata.operators.spells import merge_spells, missing_days, spells, validity
from strata.plans.daily import city_days, run_day
from strata.plans.warehouse import weather_metrics, weather_trends
from strata.sinks.inserts import insert_new
from strata.sinks.snapshots import CommitConflict, Lake
from strata.sources.catalog import register_lake_table, sync_partitions
from strata.sources.drift import drift_report, read_rescued
from strata.sources.extract import extract_increment
from strata.streaming.incremental import read_deduped, stream_dedup, stream_gate
from test_warehouse import T0, doc, land

DAY = 86400


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions_pins_and_rollback(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    part = lambda p, v: spark.createDataFrame([(v, p)], "v int, p string")
    assert lake.versions() == [] and not lake.snapshot().has("t")
    first = lake.begin().replace("t", part("a", 1).unionByName(part(None, 2)), "p").commit()
    second = lake.begin().replace("t", part("a", 3), "p").append("t", part("b/ c", 4), "p").commit()
    assert rows(first.table("t")) == [(1, "a"), (2, None)]  # still what it was
    assert rows(second.table("t")) == [(2, None), (3, "a"), (4, "b/ c")]
    assert rows(second.table("t", ["p=a"])) == [(3, "a")]
    assert lake.versions() == [1, 2]
    assert rows(lake.rollback(1).table("t")) == [(1, "a"), (2, None)]
    assert rows(lake.snapshot().table("t")) == [(1, "a"), (2, None)] and lake.versions() == [1, 2, 3]
    empty = lake.begin().replace("t", part("a", 1).limit(0)).commit()
    assert rows(empty.table("t")) == []


def test_nothing_is_seen_before_the_commit(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    lake.begin().replace("t", spark.range(3)).commit()
    change = lake.begin().append("t", spark.range(5))
    assert change.rows["t"] == 5 and change.staged("t").count() == 8 and change.staged("t", own=True).count() == 5
    assert lake.snapshot().table("t").count() == 3
    other = lake.begin().replace("t", spark.range(1))
    change.commit()
    with pytest.raises(CommitConflict):
        other.commit()
    assert lake.snapshot().table("t").count() == 8
    with pytest.raises(ValueError, match="differ"):
        lake.begin().append("t", spark.range(1).withColumnRenamed("id", "x"))


def test_key_index_reads_touched_buckets_only(spark, tmp):
    index = KeyIndex("keys", ("a", "b"), buckets=16, max_folders=2)
    lake = Lake(spark, tmp + "/lake", options={"keys": index.write_options})
    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b string")
    for i in range(4):  # the third folder of a bucket has it merged
        change = lake.begin()
        index.remember(change, index.unseen(change.base, frame([(n, "x") for n in range(i * 50, i * 50 + 50)] + [(i, None)])))
        change.commit()
    now = lake.snapshot()
    assert max(sum(p == q for q, _ in now.folders["keys"]) for p in now.parts("keys")) <= 3
    assert now.table("keys").count() == 204
    asked = frame([(7, "x"), (2, None), (9, None), (None, None), (1000, "x")])
    assert rows(index.unseen(now, asked)) == [(1000, "x"), (9, None), (None, None)]
    few = index.known(now, frame([(7, "x")]))
    assert len({os.path.basename(os.path.dirname(f)) for f in few.inputFiles()}) == 1
    assert "key_hash" in few._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_stream_dedup_is_exact_over_three_runs(spark, tmp):
    schema = spark.createDataFrame([], "k int, ts timestamp").schema
    at = lambda month, day: dt.datetime(2024, month, day)
    for run in ([(1, at(6, 1)), (3, at(6, 1))], [(2, at(1, 1))], [(2, at(6, 5)), (1, at(1, 1)), (None, at(6, 5))], [(None, at(7, 1))]):
        spark.createDataFrame(run, schema).coalesce(1).write.mode("append").parquet(tmp + "/src")
        stream_dedup(spark, tmp + "/src", schema, ["k"], "ts", "1 day", tmp + "/out", tmp + "/ck", buckets=4)
    assert rows(read_deduped(spark, tmp + "/out", schema)) == [(1, at(6, 1)), (2, at(1, 1)), (3, at(6, 1)), (None, at(6, 5))]


def test_a_replayed_batch_changes_nothing(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    step = lambda change: change.append("t", spark.range(2))
    assert lake.once("batch", "0", step) is not None
    assert lake.once("batch", "0", step) is None
    assert lake.snapshot().table("t").count() == 2
    with pytest.raises(RuntimeError):
        lake.once("batch", "1", lambda change: (step(change), (_ for _ in ()).throw(RuntimeError())))
    assert lake.snapshot().table("t").count() == 2
    lake.once("batch", "1", step)  # the folder of the broken attempt is replaced
    assert lake.snapshot().table("t").count() == 4


def test_stream_gate_stops_and_leaves_the_tables(spark, tmp):
    schema = spark.createDataFrame([], "id int, v double").schema
    put = lambda values: spark.createDataFrame(list(enumerate(values)), schema).coalesce(1).write.mode("append").parquet(tmp + "/src")
    lake = Lake(spark, tmp + "/lake")
    run = lambda: stream_gate(spark, tmp + "/src", schema, lake, "t", {"ranges": [("v", 0, 10)]}, 0.5, tmp + "/ck")
    put([1.0, 2.0, 99.0])
    run()
    put([-1.0, -2.0, 3.0])
    with pytest.raises(Exception, match="2 of 3 rows break a rule"):
        run()
    now = lake.snapshot()
    assert rows(now.table("t")) == [(0, 1.0), (1, 2.0)]
    assert [r.dq_reasons for r in now.table("t_quarantine").collect()] == [["v not in [0, 10]"]]


def test_extract_keeps_ties_and_survives_a_crash(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    source = lambda data: spark.createDataFrame(data, "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    data = [(1, "2024-01-01"), (2, "2024-01-02"), (9, None)]
    assert extract_increment(lake, source(data), "ts", "t", ["id"]) == 3
    data += [(3, "2024-01-02"), (4, "2024-01-03"), (5, "2023-01-01"), (10, None)]
    lake.begin().append("t", source(data))  # read and written, then the driver is lost
    assert extract_increment(lake, source(data), "ts", "t", ["id"]) == 2
    assert extract_increment(lake, source(data), "ts", "t", ["id"]) == 0
    assert sorted(r.id for r in lake.snapshot().table("t").collect()) == [1, 2, 3, 4, 9]
    assert lake.snapshot().marks["t"].startswith("2024-01-03")


def test_insert_new_writes_new_rows_only(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    frame = lambda data: spark.createDataFrame(data, "email string, name string, n int")
    kw = dict(key=["email"], order=["n"], not_null=["name"], unique=[["name"]], buckets=4)
    assert insert_new(lake, "users", frame([("a", "ann", 1), ("b", "bob", 1), ("b", "bo", 2)]), **kw) == 2
    assert insert_new(lake, "users", frame([("a", "other", 0), ("c", "cy", 3)]), **kw) == 1
    with pytest.raises(ConstraintError, match="not_null"):
        insert_new(lake, "users", frame([("d", None, 1)]), **kw)
    with pytest.raises(ConstraintError, match="repeat a stored value"):
        insert_new(lake, "users", frame([("d", "ann", 1)]), **kw)
    with pytest.raises(ConstraintError, match="unique"):
        insert_new(lake, "users", frame([("d", "dee", 1), ("e", "dee", 1)]), **kw)
    assert rows(lake.snapshot().table("users")) == [("a", "ann", 1), ("b", "bob", 1), ("c", "cy", 3)]


def test_dimension_takes_the_newer_attributes(spark):
    old = dimension(spark.createDataFrame([(1, "Old"), (2, "Two")], "id int, name string"), "id", ["name"], key_name="k")
    new = dimension(spark.createDataFrame([(1, "New"), (0, "Zero"), (2, None)], "id int, name string"), "id", ["name"], key_name="k", existing=old)
    assert rows(new) == [(1, 1, "New"), (2, 2, None), (3, 0, "Zero")]


def test_spells_merge_like_one_pass(spark):
    data = [(1, 10, "a"), (1, 20, "a"), (1, 30, "b"), (1, 110, "b"), (1, 120, "a"), (1, 210, None), (1, 220, None), (2, 5, "x")]
    df = spark.createDataFrame(data, "id int, t int, name string")
    whole = spells(df, ["id"], "t", ["name"])
    parts = spells(df.withColumn("day", F.floor(F.col("t") / 100)), ["id", "day"], "t", ["name"])
    assert rows(merge_spells(parts, ["id"], ["name"])) == rows(whole)
    held = validity(whole, ["id"]).select("id", "name", "valid_from", "valid_to")
    assert rows(held) == [(1, "a", 10, 30), (1, "a", 120, 210), (1, "b", 30, 120), (1, None, 210, None), (2, "x", 5, None)]


def test_missing_days(spark):
    d = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame([("a", d(1)), ("a", d(2)), ("a", d(5)), ("b", d(3)), ("b", d(3)), ("c", None), (None, d(6))], "k string, day date")
    want = [("a", d(3), d(4), 2), ("a", d(6), d(6), 1), ("b", d(1), d(2), 2), ("b", d(4), d(6), 3), ("c", d(1), d(6), 6), (None, d(1), d(5), 5)]
    assert rows(missing_days(df, ["k"], "day")) == want
    inside = missing_days(df, ["k"], "day", F.lit(d(2)), F.lit(d(3)))
    assert rows(inside) == [("a", d(3), d(3), 1), ("b", d(2), d(2), 1), ("c", d(2), d(3), 2), (None, d(2), d(3), 2)]
    assert rows(missing_days(df.limit(0), ["k"], "day")) == []


def test_profiles_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 4).alias("day"), (F.col("id") % 5000).alias("n"),
                                    F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("s"),
                                    F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 2).alias("x"))
    whole = {r.column_name: r for r in merge_profiles(profile_parts(df, "day"), [0.25, 0.5]).collect()}
    assert (whole["n"].rows, whole["n"].null_rate, whole["s"].null_rate) == (20_000, 0.0, 50.0)
    assert (whole["n"].min_value, whole["n"].max_value, whole["n"].mean_value) == (0.0, 4999.0, 2499.5)
    assert whole["s"].q50 is None and abs(whole["n"].q25 - 1250) < 150 and whole["x"].max_value == 9999.5
    exact = {r.column_name: r.distinct_count for r in merge_distinct(distinct_values(df, "day")).collect()}
    assert exact["n"] == 5000 and exact["s"] == 10_000
    assert all(abs(whole[c].distinct_estimate - exact[c]) <= 0.02 * exact[c] for c in ("n", "s"))
    nothing = df.where("false")
    assert merge_profiles(profile_parts(nothing, "day")).collect() == []


def test_drifting_documents(spark):
    docs = ['{"k":1,"u":{"a":"x"}}', '{"k":"1","it\'s\\"q":null}', "bad", None, "[1]", "{}", '{"k":1,"k":2}', '{"k":null}', '{"k":9999999999}', '{"k":1.5}']
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    got = {r.id: (r.k, r.rescued, r.corrupt) for r in read_rescued(df, "doc", {"k": "int"}).collect()}
    assert got == {0: (1, {"u": '{"a":"x"}'}, None), 1: (None, {"k": '"1"', 'it\'s"q': "null"}, None), 2: (None, None, "bad"), 3: (None, None, None),
                   4: (None, None, "[1]"), 5: (None, None, None), 6: (None, None, '{"k":1,"k":2}'), 7: (None, None, None),
                   8: (None, {"k": "9999999999"}, None), 9: (None, {"k": "1.5"}, None)}
    report = {(r.path, r.found_type, r.status): r.documents for r in drift_report(df, "doc", {"k": "int"}).collect()}
    assert report == {("k", "BIGINT", "ok"): 2, ("k", "STRING", "mismatch"): 1, ("k", "DECIMAL(2,1)", "mismatch"): 1, ("k", "VOID", "null"): 1,
                      ("k", None, "absent"): 1, ("u", "OBJECT<a: STRING>", "unknown"): 1, ('it\'s"q', "VOID", "unknown"): 1, (None, None, "corrupt"): 3}


def test_catalog_follows_the_versions(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    frame = lambda data: spark.createDataFrame(data, "v int, p string")
    first = lake.begin().replace("t", frame([(1, "a"), (2, "b"), (3, "it's")]), "p").commit()
    register_lake_table(spark, "lake_parts", first, "t")
    second = lake.begin().replace("t", frame([(9, "a"), (4, "c")]), "p").commit()
    assert sync_partitions(spark, "lake_parts", first, second, "t") == (1, 2)
    assert rows(spark.table("lake_parts")) == [(2, "b"), (3, "it's"), (4, "c"), (9, "a")]
    spark.sql("DROP TABLE lake_parts")


def daily_fixture(tmp):
    land(tmp, 1, [doc(5, "Oslo", "NO", 5.0, T0), doc(5, "Oslo", "NO", 6.25, T0 + 2 * DAY), doc(2, "Bergen", "NO", 7.123456, T0),
                  doc(9, "Kyiv", "UA", 65.0, T0)])
    land(tmp, 2, [doc(1, "Paris", "FR", 9.0, T0 + DAY, ingested="2024-01-02T01:00:00"),          # a smaller id comes later
                  doc(5, "Kristiania", "NO", 4.0, T0 + DAY, ingested="2024-01-02T01:00:00"),     # renamed, between two readings
                  doc(2, "Bergen", "NO", 8.0, T0, ingested="2024-01-02T01:00:00")])              # late correction
    return land(tmp, 3, [doc(2, "Bergen", "SE", 1.0, T0 + 3 * DAY, ingested="2024-01-03T01:00:00")])


def tables(lake):
    now = lake.snapshot()
    return {t: rows(now.table(t)) for t in now.schemas}


def test_days_equal_a_rebuild_and_keys_stay(spark, tmp):
    root, at = daily_fixture(tmp), F.lit("2024-02-01 00:00:00").cast("timestamp")
    lake = Lake(spark, tmp + "/daily")
    for day in (1, 2, 3):
        run_day(lake, root, dt.date(2024, 1, day), at)
    now, daily = lake.snapshot(), tables(lake)
    keys = {r.city_id: r.dim_city_key for r in now.table("city_keys").collect()}
    assert keys == {2: 1, 5: 2, 1: 3}
    assert {(r.city_id, r.city_name, r.country_code) for r in now.table("dim_city").collect()} == {(1, "Paris", "FR"), (2, "Bergen", "SE"), (5, "Oslo", "NO")}
    spans = [(r.city_name, r.valid_from.day, r.valid_to and r.valid_to.day) for r in now.table("city_history").where("city_id = 5").orderBy("valid_from").collect()]
    assert spans == [("Oslo", 1, 2), ("Kristiania", 2, 3), ("Oslo", 3, None)]
    silver = now.table("silver")
    assert daily["aggregated_weather_metrics"] == rows(weather_metrics(silver).select(*now.table("aggregated_weather_metrics").columns))
    assert daily["weather_trends"] == rows(weather_trends(silver).select(*now.table("weather_trends").columns))
    run_day(lake, root, dt.date(2024, 1, 1), at)  # an old day again
    assert tables(lake) == daily
    whole = Lake(spark, tmp + "/whole")
    run_day(whole, root, None, at)
    once = tables(whole)
    for t in ("silver", "silver_quarantine", "city_days", "city_spells", "aggregated_weather_metrics", "weather_trends"):
        assert once[t] == daily[t], t


def test_spells_carry_the_last_reading_and_days_add_up_without_a_sort(spark, tmp):
    data = [(1, None, "a", "p"), (1, 10, "a", "q"), (1, 20, "a", "r"), (1, 30, "b", None), (1, 40, "a", "s"), (2, None, None, "t")]
    df = spark.createDataFrame(data, "id int, t int, name string, v string")
    assert rows(spells(df, ["id"], "t", ["name"], ["v"])) == [(1, "a", 10, 20, "r"), (1, "a", 40, 40, "s"), (1, "b", 30, 30, None), (2, None, None, None, "t")]
    lake = Lake(spark, tmp + "/lake")
    run_day(lake, daily_fixture(tmp), None, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    days = city_days(lake.snapshot().table("silver"))
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_day_reads_and_replaces_only_what_it_touches(spark, tmp):
    root, at = daily_fixture(tmp), F.lit("2024-02-01 00:00:00").cast("timestamp")
    lake = Lake(spark, tmp + "/daily")
    run_day(lake, root, dt.date(2024, 1, 1), at)
    first = dict(lake.snapshot().folders["silver"])
    run_day(lake, root, dt.date(2024, 1, 3), at)
    third = dict(lake.snapshot().folders["silver"])
    assert {p: third[p] for p in first} == first and set(third) - set(first) == {"measurement_date=2024-01-04"}


def test_a_failing_gate_leaves_every_table(spark, tmp):
    root, at = daily_fixture(tmp), F.lit("2024-02-01 00:00:00").cast("timestamp")
    lake = Lake(spark, tmp + "/daily")
    run_day(lake, root, dt.date(2024, 1, 1), at)
    before = tables(lake)
    land(tmp, 4, [doc(7, "Nowhere", None, 1.0, T0 + 5 * DAY), doc(8, "Lima", "PE", 99.0, T0)])
    with pytest.raises(QualityGateError, match="country_code"):
        run_day(lake, root, dt.date(2024, 1, 4), at)
    assert tables(lake) == before and lake.versions() == [1]
