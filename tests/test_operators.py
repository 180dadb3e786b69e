"""Operator semantics on literal fixtures (edge cases of the inventory)."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from strata.functions import bucket, climate_zone, exact_avg, first_of, hours_between, path_col
from strata.operators import (ConstraintError, FanOutError, constraint_violations, schema_holds, schema_report, apply_defaults, bounded_broadcast, check_schema, dedup_latest,
                              dense_index, dimension, duplicate_stats, enrich, flatten, group_profile,
                              insert_absent, latest, layer_counts, null_rates, profile, range_stats, require,
                              top_k, with_previous)


def test_path_col_and_first_of(spark):
    df = spark.createDataFrame(
        [(1, [Row(main="Rain", description="light")]), (2, []), (3, None)],
        "id int, weather array<struct<main:string,description:string>>")
    out = df.select("id", path_col("weather[0].main").alias("m"), first_of("weather", "description").alias("d"))
    got = {r.id: (r.m, r.d) for r in out.collect()}
    assert got == {1: ("Rain", "light"), 2: (None, None), 3: (None, None)}


def test_flatten_try_cast_never_throws(spark):
    df = spark.createDataFrame(
        [(3_000_000_000, "2024-01-02T03:04:05.123456", 12.0), (7, "not a time", None)],
        "id bigint, ts string, lon double")
    out = flatten(df, [("id", "int", "city_id"), ("ts", "timestamp", "ts"), ("lon", "double", "longitude")])
    rows = out.collect()
    assert rows[0].city_id is None  # above int range -> NULL, not an error
    assert rows[0].ts == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert rows[0].longitude == 12.0
    assert rows[1].city_id == 7 and rows[1].ts is None


def test_require_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 4.0)], "id int, t double")
    assert sorted(r.id for r in require(df, ["id", "t"]).collect()) == [1]


def test_dedup_latest_deterministic_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 10, "a", 1), (1, 10, "b", 3), (1, 10, "c", 2), (None, 10, "x", 1), (None, 10, "y", 2)],
        "k int, t int, v string, ingested int")
    out = dedup_latest(df, ["k", "t"], ["ingested desc"])
    got = {r.k: r.v for r in out.collect()}
    assert got == {None: "y", 1: "b"}


def test_filter_before_dedup_keeps_good_twin(spark):
    # the newest twin has a NULL temperature: filtering first keeps the good one
    df = spark.createDataFrame([(1, 100, None, 2), (1, 100, 20.5, 1)], "id int, dt int, temp double, ing int")
    out = dedup_latest(require(df, ["id", "temp"]), ["id", "dt"], ["ing desc"])
    assert [r.temp for r in out.collect()] == [20.5]


def test_group_profile_null_key_and_half_up(spark):
    df = spark.createDataFrame([("a", 0.125), ("a", 0.125), (None, 1.0)], "k string, v double")
    out = group_profile(df, ["k"], {"avg_v": F.avg("v"), "n": F.count(F.lit(1))}, digits=2, round_cols=["avg_v"])
    got = {r.k: (r.avg_v, r.n) for r in out.collect()}
    assert got == {"a": (0.13, 2), None: (1.0, 1)}


def test_exact_avg_is_order_independent(spark):
    vals = [28.95, 38.48]  # mean 33.715 exactly in decimal
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = df.agg(F.round(exact_avg("v"), 2).cast("double").alias("m")).first().m
    assert out == 33.72


def test_global_aggregate_without_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    assert group_profile(df, [], {"s": F.sum("v")}).first().s == 3


def test_latest_and_with_previous(spark):
    df = spark.createDataFrame(
        [("x", 1, 10.0), ("x", 2, 12.5), ("x", 3, 11.0), ("y", 5, 7.0)], "c string, ts int, temp double")
    last = {r.c: r.temp for r in latest(df, ["c"], ["ts desc"]).collect()}
    assert last == {"x": 11.0, "y": 7.0}
    prev = {r.c: (r.temp, r.previous_temp, r.delta_temp)
            for r in with_previous(df, ["c"], ["ts desc"], ["temp"]).collect()}
    assert prev == {"x": (11.0, 12.5, -1.5), "y": (7.0, None, None)}


def test_dense_index_spans_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    out = dense_index(df, ["k"], "idx", partitions=5).collect()
    assert sorted((r.k, r.idx) for r in out) == [(k, k + 1) for k in range(1000)]


def test_dimension_stable_keys(spark):
    first = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "city_id int, name string")
    dim1 = dimension(first, "city_id", ["name"], key_name="dim_key")
    assert sorted((r.city_id, r.dim_key) for r in dim1.collect()) == [(10, 1), (20, 2), (30, 3)]
    second = spark.createDataFrame([(20, "b"), (5, "e"), (40, "d"), (40, "d")], "city_id int, name string")
    dim2 = dimension(second, "city_id", ["name"], key_name="dim_key", existing=dim1)
    got = sorted((r.city_id, r.dim_key) for r in dim2.collect())
    assert got == [(5, 4), (10, 1), (20, 2), (30, 3), (40, 5)]


def test_enrich_guard_and_bounded_broadcast(spark):
    fact = spark.createDataFrame([("x", 1), ("y", 2)], "city string, v int")
    dim = spark.createDataFrame([("x", "A"), ("x", "B")], "city string, country string")
    with pytest.raises(FanOutError):
        enrich(fact, dim, ["city"], guard=True)
    ok = spark.createDataFrame([("x", "A")], "city string, country string")
    assert enrich(fact, ok, ["city"], how="left", guard=True, broadcast_rows=10).count() == 2
    plan = fact.join(bounded_broadcast(ok, 10), "city")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_insert_absent_conflicts(spark):
    stored = spark.createDataFrame([("a@x", "ann")], "email string, name string")
    batch = spark.createDataFrame([("a@x", "other"), ("b@x", "bob2"), ("b@x", "bob1")], "email string, name string")
    out = insert_absent(stored, batch, ["email"], ["name"])
    assert sorted(tuple(r) for r in out.collect()) == [("a@x", "ann"), ("b@x", "bob1")]


def test_apply_defaults(spark):
    df = spark.createDataFrame([(1, None, None), (2, False, dt.datetime(2024, 1, 1))],
                               "id int, is_active boolean, created_at timestamp")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    got = {r.id: (r.is_active, r.created_at) for r in
           apply_defaults(df, {"is_active": True, "created_at": "now"}, now=now).collect()}
    assert got == {1: (True, dt.datetime(2024, 2, 1)), 2: (False, dt.datetime(2024, 1, 1))}


def test_top_k_nulls_last_and_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None), ("c", 5.0), ("d", 9.0)], "c string, v double")
    assert [r.c for r in top_k(df, ["v desc", "c"], 3).collect()] == ["d", "a", "c"]


def test_bucket_null_rules(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (20.0,), (20.01,), (None,)], "t double")
    out = df.select("t", climate_zone(F.col("t"), 10, 20).alias("z"),
                    climate_zone(F.col("t"), 10, 20, with_else=True).alias("ze")).collect()
    got = {r.t: (r.z, r.ze) for r in out}
    assert got == {9.99: ("Cold", "Cold"), 10.0: ("Temperate", "Temperate"), 20.0: ("Temperate", "Temperate"),
                   20.01: ("Warm", "Warm"), None: (None, "Warm")}
    with pytest.raises(ValueError):
        bucket([])


def test_layer_counts(spark):
    a = spark.range(3)
    b = spark.range(5)
    got = {r.layer: r.record_count for r in layer_counts({"Bronze": a, "Silver": b}).collect()}
    assert got == {"Bronze": 3, "Silver": 5}


def test_hours_between_counts_whole_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 12, 0))], "a timestamp, b timestamp")
    assert df.select(hours_between(F.col("a"), F.col("b")).alias("h")).first().h == 1


def test_null_rates_one_scan_and_empty_input(spark, tmp):
    path = tmp + "/t"
    spark.createDataFrame([(1, None), (2, "x"), (None, None), (4, "y")], "a int, b string") \
        .write.parquet(path)
    df = spark.read.parquet(path)
    out = null_rates(df)
    rates = {r.column_name: (r.null_count, r.null_rate) for r in out.collect()}
    assert rates == {"a": (1, 25.0), "b": (2, 50.0)}
    # all columns in one aggregate: the source is scanned once
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    empty = spark.createDataFrame([], "a int")
    assert [(r.null_count, r.null_rate) for r in null_rates(empty).collect()] == [(0, 0.0)]


def test_duplicate_stats_counts_null_tuples(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, 3)], "a int, b int")
    r = duplicate_stats(df, ["a", "b"]).first()
    assert (r.total_rows, r.distinct_rows, r.duplicate_count, r.duplicate_rate) == (4, 3, 1, 25.0)


def test_range_stats_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, 4.0, "b"), (None, 6.0, None)], "i int, d double, s string")
    stats = {r.column_name: r for r in range_stats(df).collect()}
    assert set(stats) == {"i", "d"}
    assert stats["d"].min_value == 2.0 and stats["d"].max_value == 6.0 and stats["d"].value_count == 3
    assert math.isclose(stats["d"].stddev_value, 2.0)
    rep = {(r.column_name, r.metric): r.value for r in profile(df, "t", keys=["s"]).collect()}
    assert rep[("*", "row_count")] == 3 and rep[("s", "null_rate")] == 33.33
    assert rep[("s", "duplicate_count")] == 0 and rep[("i", "avg")] == 2.0


def test_check_schema(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, d string")
    found = check_schema(df, {"a": "bigint", "c": "string", "b": "double"})
    assert [(f.column_name, f.status) for f in found] == [("a", "mismatch"), ("b", "ok"), ("c", "missing"), ("d", "extra")]
    assert not schema_holds(found) and schema_holds(check_schema(df, {"a": "int"}))
    assert {r.status for r in schema_report(spark, df, {"a": "int"}).collect()} == {"ok", "extra"}


def test_lazy_guard_raises_in_the_plan(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "city string, v int")
    good = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0)], "city string, x double")
    got = {r.v: r.x for r in enrich(fact, good, ["city"], "left").collect()}
    assert got == {1: 1.0, 2: None, 3: None}
    with pytest.raises(Exception, match="not unique"):
        enrich(fact, good.unionByName(good), ["city"]).collect()
    assert enrich(fact, good.unionByName(good), ["city"], guard=False).count() == 2


def test_constraints_before_the_insert(spark):
    table = spark.createDataFrame([(1, "a", "a@x")], "id int, username string, email string")
    new = spark.createDataFrame([(1, "z", "z@x"), (2, "b", None), (3, "b", "b@x")], table.schema)
    found = {(r.rule, r.columns): r.violations for r in
             constraint_violations(new, ["id", "email"], [["username"], ["email"]]).collect()}
    assert found == {("not_null", "id"): 0, ("not_null", "email"): 1, ("unique", "username"): 1, ("unique", "email"): 0}
    assert insert_absent(table, new, ["id"], ["username"], not_null=["id"]).count() == 3
    for rules in ({"not_null": ["email"]}, {"unique": [["username"]]}):
        with pytest.raises(ConstraintError):
            insert_absent(table, new, ["id"], ["username"], **rules)



def test_exact_avg_keeps_digits_nan_and_large_values(spark):
    rows = [("a", 1.006), ("a", 1.006), ("a", 1.001), ("b", float("nan")), ("b", 1.0), ("c", 1e17), ("c", 3e17), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_avg("v").alias("m"))
    out = {r["k"]: r["m"] for r in df.collect()}
    assert abs(out["a"] - 3.013 / 3) < 1e-12 and out["b"] != out["b"] and out["c"] == 2e17 and out["d"] is None


def test_distinct_counts_may_be_estimated(spark):
    from strata.operators.quality import duplicate_stats
    from strata.plans import products as P
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id") % 10).alias("v"))
    exact, near = duplicate_stats(df, ["k", "v"]).first(), duplicate_stats(df, ["k", "v"], max_error=0.01).first()
    assert exact.distinct_rows == 20_000 and abs(near.distinct_rows - 20_000) <= 800 and near.total_rows == 60_000
    metrics = df.select(F.col("k").cast("string").alias("city_name"), F.lit("NO").alias("country_code"),
                        *[F.lit(1.0).alias(c) for c in ("avg_temperature", "min_temperature", "max_temperature", "avg_humidity")])
    assert P.global_summary(metrics).first().total_cities == 20_000
    assert abs(P.avg_by_country(metrics, 0.01).first().num_cities - 20_000) <= 800
    assert "count(distinct" not in P.global_summary(metrics, 0.01)._jdf.queryExecution().executedPlan().toString().lower()
