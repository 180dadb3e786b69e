"""File sources of the bronze layer: JSON documents, CSV, Parquet, and
date-partitioned folders. All reads take an explicit schema (no inference
pass) and stay lazy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("json", "csv", "parquet")
PARTITION_COLS = ("year", "month", "day")

# Text formats for timestamps in landed JSON/CSV: microseconds are kept.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_bronze(spark: SparkSession, path: str | Sequence[str], fmt: str = "json",
                schema: T.StructType | None = None, **options) -> DataFrame:
    """Read a bronze location as json / csv / parquet; anything else raises.

    JSON defaults to JSON lines (one document or one array of documents per
    line; splittable). ``multiLine="true"`` reads files that hold one
    indented document or array each; Spark then takes the first document of
    a file only, so a file with a second one fails the read instead of losing
    rows. CSV defaults to a header row, and a header that does not match the
    schema fails. Without a schema the reader infers one (an extra pass).
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {FORMATS}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    defaults = {"json": {"multiLine": "false", "timestampNTZFormat": TS_FORMAT},
                "csv": {"header": "true", "enforceSchema": "false", "timestampNTZFormat": TS_FORMAT}}.get(fmt, {})
    options = {**defaults, **options}
    if fmt == "json" and str(options["multiLine"]).lower() == "true":
        _require_single_documents(spark, path)
    return reader.options(**options).load(path)


# One document ends and the next begins on a later line without a comma; a
# line break cannot stand inside a JSON string, so this is never within one.
_NEXT_DOCUMENT = r"[}\]][ \t\r]*\n\s*[{\[]"


def _require_single_documents(spark: SparkSession, path: str | Sequence[str]) -> None:
    paths = [path] if isinstance(path, str) else list(path)
    whole = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
    several = whole.where(F.col("value").rlike(_NEXT_DOCUMENT)).select(F.input_file_name().alias("file")).limit(1).collect()
    if several:
        raise ValueError(f"{several[0]['file']} holds several JSON documents: read it as JSON lines (multiLine=false)")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """JSON lines (one document per line): splittable, the scalable layout."""
    return read_bronze(spark, path, "json", schema, multiLine="false", **options)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str = "_corrupt_record",
             null_values: Sequence[str] = ("", "NA"), required: Sequence[str] | None = None, **options) -> DataFrame:
    """CSV with a header, bound to ``schema`` by column name.

    The order of the file's columns does not matter, other columns are left
    out, and a column the file lacks is NULL; a missing one of ``required``
    (by default the schema's non-nullable fields) raises. All files of one read
    share a header, else the read fails. Lines of another width, and lines
    with a value that is not of its column's type, keep their raw text in
    ``corrupt_col`` instead of failing the read; such a value is NULL.
    """
    header = spark.read.options(header="true", **options).csv(path).columns
    required = [f.name for f in schema.fields if not f.nullable] if required is None else required
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the required columns {missing}")
    raw = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField(corrupt_col, T.StringType())])
    df = read_bronze(spark, path, "csv", raw, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt_col, **options)
    text = {c: F.when(F.col(f"`{c}`").isin(*null_values), None).otherwise(F.col(f"`{c}`")) for c in header}
    typed, bad = [], [F.lit(False)]
    for f in schema.fields:
        if f.name not in text:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        fmt = options.get("timestampFormat")
        value = F.try_to_timestamp(text[f.name], F.lit(fmt)) if fmt and isinstance(f.dataType, T.TimestampType) \
            else text[f.name].try_cast(f.dataType)
        typed.append(value.alias(f.name))
        bad.append(text[f.name].isNotNull() & value.isNull())
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header]))
    corrupt = F.coalesce(F.col(corrupt_col), F.when(reduce(Column.__or__, bad), line))
    return df.select(*typed, corrupt.alias(corrupt_col))


# Options of CSV written by ``land_csv``: quotes are doubled, backslashes are plain.
LANDED_CSV = {"escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def escape_breaks(text: Column) -> Column:
    """Text on one line: backslashes and line breaks become backslash pairs."""
    for plain, pair in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(pair))
    return text


def unescape_breaks(text: Column) -> Column:
    """The inverse of ``escape_breaks``: between escaped backslashes, a
    backslash only ever starts a line break's pair."""
    part = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def read_landed_csv(spark: SparkSession, root: str, schema: T.StructType, day: dt.date | None = None) -> DataFrame:
    """Rows landed by ``land_csv`` as they were written: line breaks, empty texts and NULLs included."""
    df = read_partitions(spark, root, "csv", schema, day, **LANDED_CSV)
    return df.withColumns({f.name: unescape_breaks(F.col(f"`{f.name}`")) for f in schema.fields
                           if isinstance(f.dataType, T.StringType)})


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def partition_filter(day: dt.date | None = None, year: int | None = None, month: int | None = None) -> Column:
    """Predicate on zero-padded string partition columns year/month/day."""
    if day is not None:
        year, month = day.year, day.month
    cond = F.lit(True)
    if year is not None:
        cond = cond & (F.col("year") == f"{year:04d}")
    if month is not None:
        cond = cond & (F.col("month") == f"{month:02d}")
    if day is not None:
        cond = cond & (F.col("day") == f"{day.day:02d}")
    return cond


def read_partitions(spark: SparkSession, root: str, fmt: str, schema: T.StructType,
                    day: dt.date | None = None, **options) -> DataFrame:
    """Read a ``year=YYYY/month=MM/day=DD`` tree from its root and filter on
    the partition columns, so only the matching folders are listed and read
    (partition pruning) and the partition values stay available as columns.
    The partition columns are declared as strings to keep the zero padding.
    Landed JSON is read as JSON lines (splittable) unless told otherwise.
    """
    full = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in PARTITION_COLS]])
    if fmt == "json":
        options = {"multiLine": "false", **options}
    df = read_bronze(spark, root, fmt, full, **options)
    return df.where(partition_filter(day)) if day is not None else df


def read_increment(df: DataFrame, ts_col: str, mark=None) -> DataFrame:
    """Rows strictly newer than the high-water ``mark`` (all rows if None).

    With a mark set, rows whose timestamp is NULL are not returned. The
    predicate reaches the source (Parquet row-group stats / JDBC WHERE).
    """
    if mark is None:
        return df
    return df.where(F.col(ts_col) > F.lit(mark).cast(df.schema[ts_col].dataType))


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the file each row was read from (file-based sources only)."""
    return df.withColumn(name, F.col("_metadata.file_name"))
