"""Streaming runs equal the batch result, across runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.streaming import stream_dedup, stream_land, stream_merge
from strata.streaming.incremental import merge_into_partitions, read_deduped, touched_rows

SCHEMA = "user_id bigint, ts timestamp, event_id bigint, value double"


def _batch(spark, rows, folder, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def _rows(start, n, day=1):
    return [(i % 3, dt.datetime(2024, 1, day, 0, i), start + i, float(i)) for i in range(n)]


def test_stream_land_only_new_files(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    _batch(spark, _rows(0, 5), src, "b1")
    stream_land(spark, src + "/*", schema, out + "/data", out + "/ck")
    _batch(spark, _rows(100, 3), src, "b2")
    stream_land(spark, src + "/*", schema, out + "/data", out + "/ck")
    stream_land(spark, src + "/*", schema, out + "/data", out + "/ck")
    assert spark.read.parquet(out + "/data").count() == 8


def test_stream_dedup_within_and_across_runs(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    first = _rows(0, 6)
    _batch(spark, first + first[:2], src, "b1")                  # repeats inside the run
    stream_dedup(spark, src + "/*", schema, ["user_id", "ts"], "ts", "1 day", out + "/data", out + "/ck")
    _batch(spark, first[2:4] + _rows(50, 2, day=1)[:0] + [(9, dt.datetime(2024, 1, 1, 5), 99, 1.0)], src, "b2")
    stream_dedup(spark, src + "/*", schema, ["user_id", "ts"], "ts", "1 day", out + "/data", out + "/ck")
    got = spark.read.parquet(out + "/data").select("user_id", "ts")
    assert got.count() == 7 and got.distinct().count() == 7


def test_stream_merge_idempotent_and_keeps_old_partitions(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    _batch(spark, _rows(0, 4, day=1), src, "b1")
    kw = dict(keys=["user_id", "ts", "day"], order=["event_id desc"], partition_col="day",
              partition_expr=F.to_date("ts"), target=out + "/table", checkpoint=out + "/ck")
    stream_merge(spark, src + "/*", schema, **kw)
    # second run: an update of one day-1 key (newer event id) and a new day
    _batch(spark, [(0, dt.datetime(2024, 1, 1, 0, 0), 500, -1.0)] + _rows(10, 2, day=2), src, "b2")
    stream_merge(spark, src + "/*", schema, **kw)
    table = spark.read.parquet(out + "/table")
    assert table.count() == 6
    assert table.where("user_id = 0 AND ts = '2024-01-01 00:00:00'").first().event_id == 500
    assert {str(r.day) for r in table.select("day").distinct().collect()} == {"2024-01-01", "2024-01-02"}


def test_stream_dedup_keeps_late_first_rows(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    at = lambda day: dt.datetime(2024, 1, day)
    run = lambda: stream_dedup(spark, src + "/*", schema, ["user_id"], "ts", "1 day", out + "/data", out + "/ck")
    _batch(spark, [(1, at(20), 1, 1.0)], src, "b1")
    run()
    _batch(spark, [(2, at(2), 2, 1.0), (2, at(2), 3, 1.0), (1, at(20), 4, 1.0)], src, "b2")  # key 2: new, but far behind
    run()
    _batch(spark, [(2, at(3), 5, 1.0), (3, at(21), 6, 1.0)], src, "b3")
    run()
    run()
    got = sorted((r.user_id, r.event_id) for r in read_deduped(spark, out + "/data", schema).collect())
    assert got == [(1, 1), (2, 2), (3, 6)]


def test_merge_prunes_the_target_and_refuses_moving_keys(spark, tmp):
    target = os.path.join(tmp, "table")
    rows = lambda first, n: spark.range(first, first + n).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.lit(first).alias("v"))
    spark.sparkContext.setCheckpointDir(os.path.join(tmp, "ckpt"))
    merge_into_partitions(rows(0, 10), target, ["id", "day"], ["v desc"], "day")
    batch = rows(4, 2)
    near = touched_rows(batch, spark.read.schema(batch.schema).parquet(target), "day")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2024-01-05" in plan
    assert near.count() == 2
    merge_into_partitions(batch, target, ["id", "day"], ["v desc"], "day")
    assert spark.read.parquet(target).groupBy("v").count().orderBy("v").collect() == [(0, 8), (4, 2)]
    with pytest.raises(ValueError, match="partition column"):
        merge_into_partitions(batch, target, ["id"], ["v desc"], "day")


def test_dedup_query_spreads_its_input_over_files(spark, tmp_path, monkeypatch):
    from strata.plans import registry
    lines = spark.range(0, 600, 1, 6).selectExpr("id div 3 AS l_orderkey", "cast(id % 3 AS int) AS l_linenumber", "date'2024-01-01' + cast(id % 90 AS int) AS l_shipdate")
    lines.unionByName(lines.limit(10)).repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(registry, "_scratch", lambda spark, name: str(tmp_path / name))
    scan = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # a task a file
    try:
        found = registry.QUERIES["stream_dedup"](spark, str(tmp_path))
        assert sorted(map(tuple, found.collect())) == [(i // 3, i % 3) for i in range(600)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", scan)
    files = len(list((tmp_path / "stream_dedup" / "source").glob("*.parquet")))
    versions = list((tmp_path / "stream_dedup" / "data_state" / "_versions").glob("version=*"))
    assert files >= 4 * 6 and len(versions) == 4  # a micro-batch per part, each of several files
