"""Registered queries of the incremental parts: stored marks, key indexes, mergeable profiles, drifting
schemas, missing days, gates on streams, partition registration. Registered by ``strata.plans.registry``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import standin as S
from strata.plans.registry import _scratch, query
from strata.schemas import VALUE_RANGES
from strata.tables import load


def _lake(spark, name):
    from strata.sinks.snapshots import Lake
    return Lake(spark, _scratch(spark, name))


@query("extract_marks", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def extract_marks(spark, sf_dir):
    """A source that grows over three extracts, some rows of the last date coming later than others; the second extract
    dies once before its commit. Every order comes once."""
    from strata.sources.extract import extract_increment
    lake = _lake(spark, "extract_marks")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    ends = orders.agg(*[F.percentile_approx("o_orderdate", p).alias(f"p{i}") for i, p in enumerate((0.3, 0.6))]).first()
    date, late = F.col("o_orderdate"), F.col("o_orderkey") % 2 == 1
    for i, end in enumerate([*ends, None]):
        source = orders if end is None else orders.where((date < F.lit(end)) | ((date == F.lit(end)) & ~late))
        if i == 1:
            lake.begin().append("orders", source)  # written, never published
        extract_increment(lake, source, "o_orderdate", "orders", ["o_orderkey"])
    return lake.snapshot().table("orders")


@query("insert_append", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 15 THEN 1 ELSE 2 END AS batch FROM customer""")
def insert_append(spark, sf_dir):
    """Customers offered three times, with other values and several rows per key: only absent keys are written."""
    from strata.sinks.inserts import insert_new
    lake = _lake(spark, "insert_append")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    offer = lambda batch: customer.withColumn("batch", F.lit(batch))
    offers = [offer(1).where("c_nationkey < 15"), offer(2).unionByName(offer(3)), offer(4)]
    for rows in offers:
        insert_new(lake, "customer", rows, ["c_custkey"], ["batch"], not_null=["c_name"], unique=[["c_name"]], buckets=8)
    return lake.snapshot().table("customer")


def _profile_sql() -> str:
    parts = []
    for c in ("event_id", "event_type", "user_id", "value"):
        numeric = c != "event_type"
        lo, hi, mean = (f"min({c})::DOUBLE", f"max({c})::DOUBLE", f"round(avg({c}::DECIMAL(38,9)), 4)::DOUBLE") if numeric else ("NULL::DOUBLE",) * 3
        parts.append(f"SELECT '{c}' AS column_name, count(*)::BIGINT AS rows, count_if({c} IS NULL)::BIGINT AS nulls, {lo} AS min_value, {hi} AS max_value, "
                     f"{mean} AS mean_value, count(DISTINCT {c}) AS distinct_count, TRUE AS distinct_close, "
                     f"{'TRUE' if numeric else 'NULL::BOOLEAN'} AS median_close FROM e")
    return "WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type, user_id, value FROM events)\n" + "\nUNION ALL\n".join(parts)


@query("profile_merge", _profile_sql())
def profile_merge(spark, sf_dir):
    """Profiles stored per day, in two runs, and merged without a second look at the events; the sketches are held
    against the exact mode and against the ranks of the data."""
    from strata.operators.sketches import distinct_values, merge_distinct, merge_profiles, profile_parts
    lake = _lake(spark, "profile_merge")
    events = load(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "user_id", "value", F.to_date("ts").alias("day"))
    for run in (events.where(F.dayofmonth("day") <= 15), events.where(F.dayofmonth("day") > 15)):
        change = lake.begin()
        change.append("profiles", profile_parts(run, "day")).append("values", distinct_values(run, "day")).commit()
    now = lake.snapshot()
    merged = merge_profiles(now.table("profiles")).join(merge_distinct(now.table("values")), "column_name")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.02 * F.col("distinct_count")
    medians = {r["column_name"]: r["q50"] for r in merged.where("q50 IS NOT NULL").select("column_name", "q50").collect()}
    ranks = events.agg(*[F.struct((F.count_if(F.col(c) < m) / F.count(c)).alias("below"), (F.count_if(F.col(c) <= m) / F.count(c)).alias("upto")).alias(c)
                         for c, m in medians.items()])
    close = ranks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), ((F.col(f"{c}.below") <= 0.53) & (F.col(f"{c}.upto") >= 0.47))
                                                     .alias("median_close")) for c in medians])))
    return merged.join(close, "column_name", "left").select(
        "column_name", "rows", "nulls", "min_value", "max_value", F.round("mean_value", 4).alias("mean_value"), "distinct_count",
        near.alias("distinct_close"), "median_close")


_DRIFT = """
docs AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n, event_id % 8 AS m FROM events)"""


def _drifting(spark, sf_dir):
    n, m = F.get_json_object("props", "$.k"), F.pmod("event_id", F.lit(8))
    doc = F.when(m == 0, F.concat(F.lit('{"k": '), n, F.lit(', "unit": {"name": "C"}}'))).when(m == 1, F.concat(F.lit('{"k": "'), n, F.lit('"}'))) \
        .when(m == 2, "{}").when(m == 3, F.concat(F.lit("k="), n)).when(m == 4, '{"k": null}').when(m == 5, F.concat(F.lit('{"k": '), n, F.lit(".5}"))) \
        .when(m == 6, F.concat(F.lit('{"k": '), n, F.lit(', "it\'s": [1, '), n, F.lit("]}"))).otherwise(F.concat(F.lit('{"k": '), n, F.lit("}")))
    return load(spark, sf_dir, "events").select("event_id", doc.alias("doc"))


@query("drift_rescued", "WITH" + _DRIFT + """
SELECT event_id, CASE WHEN m IN (0, 6, 7) THEN n END AS k,
       CASE m WHEN 0 THEN '{"unit":{"name":"C"}}' WHEN 1 THEN '{"k":"' || n || '"}' WHEN 5 THEN '{"k":' || n || '.5}'
              WHEN 6 THEN '{"it''s":[1,' || n || ']}' END AS rescued, CASE m WHEN 3 THEN 'k=' || n END AS corrupt
FROM docs""")
def drift_rescued(spark, sf_dir):
    """Documents with unknown fields, other types, nulls, no fields and no JSON: all of it comes out somewhere."""
    from strata.sources.drift import read_rescued
    out = read_rescued(_drifting(spark, sf_dir), "doc", {"k": "int"})
    texts = F.transform(F.map_entries("rescued"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return out.withColumn("rescued", F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")))


@query("drift_report", "WITH" + _DRIFT + """
SELECT 'k' AS path, CASE WHEN m IN (0, 6, 7) THEN 'BIGINT' WHEN m = 1 THEN 'STRING' WHEN m = 5 THEN 'DECIMAL' WHEN m = 4 THEN 'VOID' END AS found_type,
       CASE WHEN m IN (0, 6, 7) THEN 'ok' WHEN m IN (1, 5) THEN 'mismatch' WHEN m = 4 THEN 'null' ELSE 'absent' END AS status, count(*) AS documents
FROM docs WHERE m <> 3 GROUP BY ALL
UNION ALL SELECT 'unit', 'OBJECT', 'unknown', count(*) FROM docs WHERE m = 0 HAVING count(*) > 0
UNION ALL SELECT 'it''s', 'ARRAY', 'unknown', count(*) FROM docs WHERE m = 6 HAVING count(*) > 0
UNION ALL SELECT NULL, NULL, 'corrupt', count(*) FROM docs WHERE m = 3 HAVING count(*) > 0""")
def drift_report_q(spark, sf_dir):
    from strata.sources.drift import drift_report
    found = drift_report(_drifting(spark, sf_dir), "doc", {"k": "int"})
    kind = F.regexp_extract("found_type", "^[A-Z]+", 0)
    return found.groupBy("path", F.when(F.col("found_type").isNotNull(), kind).alias("found_type"), "status").agg(F.sum("documents").alias("documents"))


@query("missing_city_days", """
WITH seen AS (SELECT DISTINCT user_id AS city_id, CAST(ts AS DATE) AS day FROM events WHERE user_id % 4 <> 0 OR CAST(ts AS DATE) <> DATE '2024-01-10'),
ends AS (SELECT min(day) AS lo, max(day) AS hi FROM seen),
calendar AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
missing AS (SELECT city_id, day FROM (SELECT DISTINCT city_id FROM seen) CROSS JOIN calendar
            EXCEPT SELECT city_id, day FROM seen),
runs AS (SELECT city_id, day, day - CAST(row_number() OVER (PARTITION BY city_id ORDER BY day) AS INTEGER) AS run FROM missing)
SELECT city_id, min(day) AS gap_start, max(day) AS gap_end, count(*)::INTEGER AS gap_days FROM runs GROUP BY city_id, run""")
def missing_city_days(spark, sf_dir):
    """Days without any reading, per city (a day's rows of some cities are taken out first)."""
    from strata.operators.spells import missing_days
    day = F.to_date("ts")
    seen = load(spark, sf_dir, "events").where((F.col("user_id") % 4 != 0) | (day != F.lit("2024-01-10").cast("date")))
    return missing_days(seen.select(F.col("user_id").alias("city_id"), "ts"), ["city_id"], "ts")


@query("stream_gate", """
SELECT event_id, user_id, value, CASE WHEN NOT value BETWEEN 0 AND 60 THEN 'value not in [0, 60]' END AS dq_reasons FROM events""")
def stream_gate_q(spark, sf_dir):
    """Events streamed through range rules: valid rows and quarantined ones, published together per micro-batch."""
    from strata.streaming.incremental import stream_gate
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "value")
    base = _scratch(spark, "stream_gate")
    events.repartition(3, "event_id").write.parquet(base + "/source")
    lake = _lake(spark, "stream_gate_tables")
    for _ in range(2):  # the second run finds nothing new
        stream_gate(spark, base + "/source", events.schema, lake, "events", {"ranges": [("value", 0, 60)]}, 1.0,
                    base + "/_checkpoint", maxFilesPerTrigger="2")
    now = lake.snapshot()
    bad = now.table("events_quarantine").withColumn("dq_reasons", F.array_join("dq_reasons", "; "))
    return now.table("events").withColumn("dq_reasons", F.lit(None).cast("string")).unionByName(bad)


@query("catalog_partitions", """
SELECT CAST(ts AS DATE) AS day, count(*) AS events, sum(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN 1 ELSE 0 END)::BIGINT AS renewed
FROM events GROUP BY 1""")
def catalog_partitions(spark, sf_dir):
    """A partitioned table in the catalog that follows its versions: a change of one day swaps one partition."""
    from strata.sources.catalog import create_namespace, register_lake_table, sync_partitions
    lake = _lake(spark, "catalog_partitions")
    events = load(spark, sf_dir, "events").select("event_id", F.lit(0).alias("renewed"), F.to_date("ts").alias("day"))
    first = lake.begin().replace("events", events, "day").commit()
    previous = spark.catalog.currentDatabase()
    try:
        create_namespace(spark, "strata_parts", location=lake.root + "/db")
        register_lake_table(spark, "strata_parts.events", first, "events")
        change = lake.begin().replace("events", events.where("day = DATE '2024-01-10'").withColumn("renewed", F.lit(1)), "day")
        second = change.commit()
        touched = len(set(second.folders["events"]) - set(first.folders["events"]))
        if sync_partitions(spark, "strata_parts.events", first, second, "events") != (touched, touched):
            raise RuntimeError("more partitions were registered than the change has touched")
        return spark.table("strata_parts.events").groupBy("day").agg(F.count(F.lit(1)).alias("events"), F.sum("renewed").alias("renewed"))
    finally:
        spark.sql(f"USE `{previous}`")


@query("schema_findings", """
SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS expected,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS actual,
       CASE column_type WHEN 'TIMESTAMP' THEN 'mismatch' ELSE 'ok' END AS status
FROM (DESCRIBE SELECT * FROM events) WHERE column_name <> 'props'
UNION ALL SELECT 'props', NULL, 'string', 'extra' UNION ALL SELECT 'station', 'string', NULL, 'missing'""")
def schema_findings(spark, sf_dir):
    from strata.operators.quality import schema_report
    expected = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string", "value": "double", "station": "string"}
    return schema_report(spark, load(spark, sf_dir, "events"), expected)


@query("landed_payloads", f"""
SELECT event_id, user_id, props, TIMESTAMP '{S.RUN_TS}' AS ingestion_timestamp, 'Oslo' AS city_search FROM events""")
def landed_payloads(spark, sf_dir):
    """Documents stamped on landing, written as dated JSON and read back."""
    from strata.sinks.files import write_landing
    from strata.sources.files import read_partitions
    from strata.sources.payloads import land
    docs = land(load(spark, sf_dir, "events").select("event_id", "user_id", "props"), S.fixed_ts(S.RUN_TS), city_search="Oslo")
    root = _scratch(spark, "landed_payloads")
    write_landing(docs, root, "ingestion_timestamp")
    return read_partitions(spark, root, "json", docs.schema).drop("year", "month", "day")


@query("stock_documents", """
SELECT CAST(user_id AS VARCHAR) AS stock_symbol, CAST(event_id AS VARCHAR) AS metadata_symbol, CAST(ts AS DATE) AS last_refreshed, ts AS ingested
FROM events WHERE event_type <> 'error' AND value <= 100
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, CAST(event_id AS VARCHAR)) = 1""")
def stock_documents(spark, sf_dir):
    """The document rows of the stock layer: one per symbol and refresh date, the newest ingestion."""
    from strata.plans.registry import stock_payloads
    from strata.plans.warehouse import stock_silver
    docs = stock_silver(stock_payloads(spark, sf_dir), S.fixed_ts(S.RUN_TS))[0]
    return docs.select("stock_symbol", "metadata_symbol", "last_refreshed", F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingested"))


@query("stream_upsert", """
SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN -value ELSE value END AS value, CAST(ts AS DATE) AS event_date FROM events""")
def stream_upsert(spark, sf_dir):
    """A stream merged into a table that is already there: two runs, the second corrects a third of the rows."""
    from strata.streaming.incremental import stream_merge
    base = _scratch(spark, "stream_upsert")
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    runs = [events.withColumn("run", F.lit(1)), events.where("event_id % 3 = 0").withColumns({"value": -F.col("value"), "run": F.lit(2)})]
    for rows in runs:
        rows.write.mode("append").parquet(base + "/source")
        stream_merge(spark, base + "/source", rows.schema, ["event_id", "event_date"], ["run desc"], "event_date", F.to_date("ts"),
                     base + "/table", base + "/_checkpoint")
    return spark.read.parquet(base + "/table").drop("run")


def _range_sql() -> str:
    rows = [f"SELECT 'range[{lo:g},{hi:g}]' AS rule, '{c}' AS column_name, count(*) AS checked_rows, "
            f"count_if(NOT ({lo} + ({hi} - {lo}) * (value + event_id % 7 * 10 - 20) / 100 BETWEEN {lo} AND {hi})) AS violations FROM events"
            for c, lo, hi in VALUE_RANGES]
    return "\nUNION ALL\n".join(rows)


@query("value_ranges", _range_sql())
def value_ranges(spark, sf_dir):
    """All seven value ranges, with values inside, below and above each."""
    from strata.operators.rules import violation_counts
    at = (F.col("value") + F.col("event_id") % 7 * 10 - 20) / 100
    rows = load(spark, sf_dir, "events").select(*[(lo + (hi - lo) * (at * 100) / 100).alias(c) for c, lo, hi in VALUE_RANGES])
    return violation_counts(rows, VALUE_RANGES)
