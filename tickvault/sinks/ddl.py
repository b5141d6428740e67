"""Table definitions (K8, K11, K12) as catalog DDL over the declared schemas."""
from __future__ import annotations

from pyspark.sql import SparkSession

from tickvault import schemas


def quoted(name: str, database: str | None = None) -> str:
    """A table name as SQL identifiers. Without ``database`` a dotted name is taken apart at its dots."""
    parts = [database, name] if database else name.split(".")
    return ".".join(f"`{p.strip('`').replace('`', '``')}`" for p in parts)


def create_table(spark: SparkSession, name: str, schema, location: str | None = None,
                 partition_cols: list[str] | None = None, fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the declared columns (create-if-missing, K8)."""
    sql = f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({schemas.ddl(schema)}) USING {fmt}"
    if partition_cols:
        sql += f" PARTITIONED BY ({', '.join(quoted(c) for c in partition_cols)})"
    if location:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        sql += f" LOCATION '{escaped}'"
    spark.sql(sql)


def create_metadata_table(spark: SparkSession, name: str = "coin_metadata", location: str | None = None) -> None:
    """19 typed columns, key coin_id (rank is a plain column, §7.4 D3)."""
    create_table(spark, name, schemas.METADATA_TABLE, location)


def create_price_table(spark: SparkSession, name: str = "coin_price", location: str | None = None) -> None:
    """Key (coin_id, read_timestamp), partitioned by day."""
    create_table(spark, name, schemas.PRICE_TABLE, location, schemas.PRICE_PARTITION)


def create_index_table(spark: SparkSession, name: str = "post_index", location: str | None = None) -> None:
    """K8: the 8 typed search-index fields."""
    create_table(spark, name, schemas.INDEX_TABLE, location)
