"""Catalog registration: namespaces, external tables over written layers,
views, partition discovery. Everything goes through ``spark.sql``."""

from __future__ import annotations

import re
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    from strata.sinks.snapshots import Snapshot

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    parts = name.split(".")
    if not all(_IDENT.match(p) for p in parts):
        raise ValueError(f"bad identifier {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def create_namespace(spark: SparkSession, name: str, use: bool = True, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at a shared location) [+ ``USE``]."""
    where = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}{where}")
    if use:
        spark.sql(f"USE {_ident(name)}")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   replace: bool = True) -> DataFrame:
    """External table over files already written at ``path``; the schema,
    partition columns and partitions are discovered from the files."""
    if fmt not in ("parquet", "json", "csv"):
        raise ValueError(f"unsupported format {fmt!r}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")
    quoted = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} USING {fmt} LOCATION '{quoted}'")
    repair(spark, name)
    return spark.table(name)


def repair(spark: SparkSession, name: str) -> bool:
    """Pick up partitions added to a partitioned table's folder; a no-op
    (returns False) for an unpartitioned table."""
    if not any(c.isPartition for c in spark.catalog.listColumns(name)):
        return False
    spark.sql(f"MSCK REPAIR TABLE {_ident(name)}")
    return True


def _partition_spec(part: str) -> str:
    column, value = part.split("=", 1)
    value = unquote(value)
    return f"PARTITION (`{column}` = " + ("NULL" if value == "__HIVE_DEFAULT_PARTITION__" else "'" + value.replace("'", "\\'") + "'") + ")"


def register_lake_table(spark: SparkSession, name: str, snapshot: Snapshot, table: str) -> DataFrame:
    """Catalog table over a partitioned lake table: its partitions are the folders of ``snapshot``. Nothing is listed."""
    column = snapshot.parts(table)[0].split("=", 1)[0]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema(table).fields)
    where = snapshot.lake.path(table).replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")
    spark.sql(f"CREATE TABLE {_ident(name)} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{where}'")
    sync_partitions(spark, name, None, snapshot, table)
    return spark.table(name)


def sync_partitions(spark: SparkSession, name: str, old: Snapshot | None, new: Snapshot, table: str) -> tuple[int, int]:
    """Bring a table registered at ``old`` (None: just created) to ``new``: partitions dropped and added.

    The two manifests tell which partitions have changed, so a day's run costs as many statements as it
    touched dates, where a repair lists every folder of the table.
    """
    before = dict(old.folders.get(table, ())) if old is not None else {}
    now = dict(new.folders.get(table, ()))
    if len(now) != len(new.folders.get(table, ())):
        raise ValueError(f"{table}: a partition with several folders cannot be registered")
    changed = [p for p in now if before.get(p) != now[p]]
    gone = [p for p in before if before[p] != now.get(p)]
    for part in gone:
        spark.sql(f"ALTER TABLE {_ident(name)} DROP IF EXISTS {_partition_spec(part)}")
    for part in changed:
        folder = f"{new.lake.path(table)}/commit={now[part]}/{part}".replace("'", "\\'")
        spark.sql(f"ALTER TABLE {_ident(name)} ADD IF NOT EXISTS {_partition_spec(part)} LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return len(gone), len(changed)


def register_product_views(spark: SparkSession, metrics: DataFrame, trends: DataFrame | None = None,
                           dim: DataFrame | None = None, dim_attrs=("latitude", "longitude"),
                           extra_metrics=("avg_pressure",)) -> list[str]:
    """Expose the reporting views of the warehouse (built by
    ``strata.plans.products``) as temporary views for SQL users."""
    from strata.plans import products as P

    views = {"v_weather_extremes": P.weather_extremes(metrics)}
    if trends is not None:
        views["v_current_weather_summary"] = P.current_vs_history(trends, metrics)
    if dim is not None:
        views["v_city_climate_profile"] = P.climate_profile(dim, metrics, attrs=dim_attrs,
                                                            extra_metrics=extra_metrics)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
