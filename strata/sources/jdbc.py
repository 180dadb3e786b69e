"""Relational extracts through Spark's JDBC source.

Reads are split over ``num_partitions`` range queries on a numeric or
timestamp column, so a large table is pulled in parallel. A row cap goes into
the source query itself (Spark's JDBC source does not push ``limit``), and the
incremental predicate is pushed as a WHERE clause.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def jdbc_reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None) -> DataFrameReader:
    reader = spark.read.format("jdbc").option("url", url)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader


def extract_table(spark: SparkSession, url: str, table: str, limit: int | None = None,
                  partition_column: str | None = None, lower_bound=None, upper_bound=None,
                  num_partitions: int | None = None, properties: Mapping[str, str] | None = None) -> DataFrame:
    """``SELECT * FROM table [FETCH FIRST n ROWS ONLY]`` as a DataFrame."""
    reader = jdbc_reader(spark, url, properties)
    if limit is not None:
        if limit < 0:
            raise ValueError("limit must be >= 0")
        return reader.option("query", f"SELECT * FROM {table} FETCH FIRST {int(limit)} ROWS ONLY").load()
    reader = reader.option("dbtable", table)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return reader.load()


def execute_query(spark: SparkSession, url: str, sql: str,
                  properties: Mapping[str, str] | None = None) -> DataFrame:
    """An arbitrary SELECT run by the database, returned as a DataFrame."""
    return jdbc_reader(spark, url, properties).option("query", sql).load()


def extract_incremental(spark: SparkSession, url: str, table: str, ts_col: str, last=None,
                        properties: Mapping[str, str] | None = None, **partitioning) -> DataFrame:
    """Rows with ``ts_col`` strictly after ``last`` (all rows if None); the
    filter is pushed to the database. The caller stores the new mark
    (e.g. ``max(ts_col)`` of what it wrote)."""
    df = extract_table(spark, url, table, properties=properties, **partitioning)
    if last is None:
        return df
    return df.where(F.col(ts_col) > F.lit(last).cast(df.schema[ts_col].dataType))
