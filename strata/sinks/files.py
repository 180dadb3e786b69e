"""Layer writers: Parquet layers with dynamic partition overwrite, dated
landing folders, bounded envelopes, quality reports, read-back checks.

Row counts come from an ``Observation`` attached to the write itself, so a
write never re-runs its plan just to log a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import LANDED_CSV, TS_FORMAT, escape_breaks

_LOCAL_BITS = (1 << 33) - 1


def _chunk_id(chunk_rows: int):
    """(partition, local position // chunk_rows): groups of at most
    ``chunk_rows`` rows that never span two input partitions."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    mid = F.monotonically_increasing_id()
    return F.struct(F.shiftrightunsigned(mid, 33).alias("p"),
                    F.floor(mid.bitwiseAND(F.lit(_LOCAL_BITS)) / chunk_rows).alias("c"))


def write_layer(df: DataFrame, path: str, partitions: Sequence[str] | None = None, mode: str = "overwrite",
                fmt: str = "parquet", compression: str = "snappy", dynamic: bool = True,
                max_records_per_file: int | None = 5_000_000, cluster: bool = False) -> int:
    """Write a layer and return the number of rows written.

    With partitions and ``dynamic=True`` an overwrite replaces only the
    partitions present in ``df`` and keeps the others (a daily run does not
    wipe earlier days). NULL partition values are written to the default
    partition and read back as NULL. Tasks write their rows straight into the
    partition folders (no shuffle by partition value, so a hot partition is
    spread over all tasks); ``max_records_per_file`` bounds file sizes.

    ``cluster=True`` first brings the rows of a partition value together by a
    rebalance, which AQE splits by size: small values are written by one task,
    a hot one by as many as its bytes ask for.
    """
    if partitions and cluster:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partitions])
    obs = Observation("strata_write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if fmt == "parquet":
        writer = writer.option("compression", compression)
    if fmt in ("json", "csv"):
        writer = writer.option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT + "XXX")
        if fmt == "csv":
            writer = writer.options(header="true", **LANDED_CSV)
    if partitions:
        writer = writer.partitionBy(*partitions)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return int(obs.get["rows"])


def date_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded ``year``/``month``/``day`` strings of a timestamp."""
    return {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd")}


def write_landing(df: DataFrame, root: str, ts_col: str, fmt: str = "json", mode: str = "append") -> int:
    """Land rows under ``root/year=YYYY/month=MM/day=DD/`` by ``ts_col``; the days
    are clustered, so a day's files are as many as its size asks for."""
    return write_layer(df.withColumns(date_parts(F.col(ts_col))), root, ["year", "month", "day"],
                       mode=mode, fmt=fmt, cluster=True)


def land_csv(df: DataFrame, root: str, source: str, original_filename: str, ingestion_date: Column,
             ts_col: str) -> int:
    """Raw CSV landing with file provenance columns, partitioned by date. Line
    breaks inside texts are escaped, so files stay one row a line (splittable);
    ``read_landed_csv`` gives the rows back as they were."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tagged = df.withColumns({**{c: escape_breaks(F.col(f"`{c}`")) for c in texts},
        "source": F.lit(source), "original_filename": F.lit(original_filename),
        "ingestion_date": ingestion_date,
    })
    return write_landing(tagged, root, ts_col, fmt="csv")


def envelopes(df: DataFrame, extraction_ts: Column, chunk_rows: int = 10_000) -> DataFrame:
    """Pack rows into ``{data: [...], metadata: {row_count, columns,
    extraction_timestamp}}`` documents of at most ``chunk_rows`` rows.

    Chunks never cross input partitions (they are numbered from the
    partition-local row position), so no document - and no group - is
    larger than ``chunk_rows`` however the data is distributed.
    """
    cols = df.columns
    grouped = df.withColumn("__chunk", _chunk_id(chunk_rows)).groupBy("__chunk").agg(
        F.collect_list(F.struct(*cols)).alias("data"))
    meta = F.struct(
        F.size("data").cast("bigint").alias("row_count"),
        F.array(*[F.lit(c) for c in cols]).alias("columns"),
        F.date_format(extraction_ts, TS_FORMAT).alias("extraction_timestamp"),
    )
    return grouped.select("data", meta.alias("metadata"))


def json_arrays(df: DataFrame, chunk_rows: int = 1_000) -> DataFrame:
    """One text line per chunk of at most ``chunk_rows`` rows holding a JSON
    array of the rows - the landed shape of API payload lists. Chunks are
    partition-local, so no group grows with the data."""
    grouped = df.withColumn("__chunk", _chunk_id(chunk_rows)).groupBy("__chunk").agg(
        F.collect_list(F.struct(*df.columns)).alias("docs"))
    return grouped.select(F.to_json("docs", {"timestampNTZFormat": TS_FORMAT}).alias("value"))


def write_json_arrays(df: DataFrame, path: str, chunk_rows: int = 1_000) -> None:
    json_arrays(df, chunk_rows).write.mode("overwrite").text(path)


def write_envelopes(df: DataFrame, path: str, extraction_ts: Column, chunk_rows: int = 10_000) -> int:
    """Write envelope documents as JSON lines; refuses an empty input.
    Returns the number of data rows written."""
    if df.isEmpty():
        raise ValueError("refusing to write an empty extract")
    env = envelopes(df, extraction_ts, chunk_rows)
    obs = Observation("strata_envelope")
    env.observe(obs, F.sum(F.col("metadata.row_count")).alias("rows")).write.mode("overwrite") \
        .option("timestampNTZFormat", TS_FORMAT).json(path)
    return int(obs.get["rows"] or 0)


def write_report(report: DataFrame, path: str, run_id: str) -> None:
    """Append a quality report (long metric rows) keyed by ``run_id``."""
    report.withColumn("run_id", F.lit(run_id)).write.mode("append").json(path)


def read_back(spark: SparkSession, path: str, partition_col: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Count rows per partition value of a written layer (or in total)."""
    df = spark.read.format(fmt).load(path)
    if partition_col:
        return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("records"))
    return df.agg(F.count(F.lit(1)).alias("records"))
