"""File sources.

Landed API responses are JSON files; each is read with its declared schema, so types never
drift between an integer and a fractional volume, and no file is ever sampled for inference.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickvault import schemas
from tickvault.session import restore_path


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False,
                   corrupt_column: str | None = None, landed_at: bool = False) -> DataFrame:
    """JSON documents with a declared schema. ``multiline`` for one array/document per file.

    With ``corrupt_column`` malformed records are kept (PERMISSIVE) with their raw text there.
    With ``landed_at`` the file's modification time is added as ``landed_at`` (the version of a
    document when a folder holds several fetches of the same coin).
    """
    reader = spark.read.schema(schema if not corrupt_column else
                               T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())]))
    reader = reader.option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.json(path)
    if landed_at:
        df = df.withColumn("landed_at", F.col("_metadata.file_modification_time"))
    return df


def read_coin_list(spark: SparkSession, path: str) -> DataFrame:
    """The coin list (a JSON array of objects per file)."""
    return read_json_docs(spark, path, schemas.COIN_LIST, multiline=True)


def read_tickers(spark: SparkSession, path: str, landed_at: bool = False) -> DataFrame:
    """Ticker documents (one per coin and fetch)."""
    return read_json_docs(spark, path, schemas.TICKER, multiline=True, landed_at=landed_at)


def read_meta(spark: SparkSession, path: str, landed_at: bool = False) -> DataFrame:
    """S3: metadata documents (one per coin and fetch)."""
    return read_json_docs(spark, path, schemas.META, multiline=True, landed_at=landed_at)


def read_historic(spark: SparkSession, path: str, since: str | None = None, interval: str | None = None) -> DataFrame:
    """Landed history documents ``{coin_id, points:[...]}``, exploded to one row per point, with
    the raw point as ``payload``.

    ``since`` and ``interval`` (the API's ``start`` and ``interval``) work as in ``history_range``.
    """
    from tickvault.operators.flatten import historic_points
    return history_range(historic_points(read_json_docs(spark, path, schemas.HISTORIC_DOC), payload=True), since, interval)


def history_range(points: DataFrame, since: str | None = None, interval: str | None = None) -> DataFrame:
    """S4 + A4: points at or after ``since`` and, with ``interval`` ('1d', '12h', ...), the last of them
    per coin and interval. Points without a usable time are kept, so that a job can quarantine them."""
    bad = points.filter(F.col("read_timestamp").isNull())
    good = points.filter(F.col("read_timestamp").isNotNull())
    if since is not None:
        good = good.filter(F.col("read_timestamp") >= F.to_timestamp_ntz(F.lit(since)))
    if interval is not None:
        from tickvault.operators.aggregate import resample_last
        rest = [c for c in points.columns if c not in ("coin_id", "read_timestamp")]
        good = resample_last(good, "coin_id", "read_timestamp", rest, interval, tiebreak=[c for c in rest if c not in ("date", "hour")]).select(*points.columns)
    return good.unionByName(bad)


def apply_filters(df: DataFrame, filters: dict | None) -> DataFrame:
    """equality conjunction from a dict, before any projection (may use unselected columns)."""
    for c, v in (filters or {}).items():
        df = df.filter(F.col(c) == F.lit(v))
    return df


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None,
               filters: dict | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Format + path + equality filters + projection, returned as a DataFrame (never collected).

    Filters reach the scan as ``PushedFilters`` / ``PartitionFilters``; the projection becomes the
    ``ReadSchema``. A declared ``schema`` keeps partition columns typed (discovery would turn an id
    like '1' into an int).
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = apply_filters(reader.load(path), filters)
    return select_columns(df, columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stored table, or an empty frame of its schema when the path does not exist yet."""
    if restore_path(spark, path):
        return spark.read.format(fmt).schema(schema).load(path).select(*schema.fieldNames())
    return spark.createDataFrame([], schema)


def frame_from_records(spark: SparkSession, records, schema: T.StructType) -> DataFrame:
    """Records with an explicit nested schema (small driver-side inputs only, e.g. tests)."""
    return spark.createDataFrame(records, schema)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate (for a file scan: the file index Spark already listed)."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return v if isinstance(v, int) else int(v.toString())
    except Exception:  # pragma: no cover
        return None


def select_columns(df: DataFrame, columns: list[str | Column] | None) -> DataFrame:
    """P5: projection by list."""
    return df.select(*columns) if columns else df
