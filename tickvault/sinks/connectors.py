"""Connector option builders and table maintenance.

The Cassandra and Elasticsearch connector jars are not part of this build: the functions below
produce the exact writer options and the typed frames, and run against a live store only where
the jars are on the classpath. The data work (typed projection, key merge) is in ``flatten`` and
``merge`` and is tested without a store.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickvault.sinks.ddl import quoted


def cassandra_options(table: str, keyspace: str, host: str, port: int | str,
                      user: str | None = None, password: str | None = None) -> dict[str, str]:
    """K5: honours its table and keyspace arguments (§7.4 D7)."""
    opts = {"table": table, "keyspace": keyspace, "spark.cassandra.connection.host": host,
            "spark.cassandra.connection.port": str(port)}
    if user is not None:
        opts["spark.cassandra.auth.username"] = user
    if password is not None:
        opts["spark.cassandra.auth.password"] = password
    return opts


def write_cassandra(df: DataFrame, options: dict[str, str]) -> None:
    """Append; Cassandra rows with the same primary key overwrite each other (an upsert)."""
    df.write.format("org.apache.spark.sql.cassandra").options(**options).mode("append").save()


def es_options(nodes: str, port: int | str, resource: str, id_col: str | None = None,
               user: str | None = None, password: str | None = None) -> dict[str, str]:
    """K6: with ``es.mapping.id`` a repeated document id replaces the stored document."""
    opts = {"es.nodes": nodes, "es.port": str(port), "es.resource": resource}
    if id_col:
        opts["es.mapping.id"] = id_col
        opts["es.write.operation"] = "upsert"
    if user is not None:
        opts["es.net.http.auth.user"] = user
    if password is not None:
        opts["es.net.http.auth.pass"] = password
    return opts


def write_es(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("es").options(**options).mode("append").save()


def upsert_index(docs: DataFrame, path: str, id_col: str = "submission_id") -> None:
    """K6 semantics without a search cluster: the typed 8-field index rows plus the document id,
    merged by that id into a parquet table (a re-indexed document replaces the old one). The table is
    partitioned by the day of ``created_utc`` (fixed by the id; null days share a partition), so a
    changed document rewrites its day, not the index."""
    from pyspark.sql import functions as F, types as T
    from tickvault import schemas
    from tickvault.sinks.merge import upsert
    day = T.StructField(schemas.INDEX_PARTITION[0], T.DateType())
    schema = T.StructType([T.StructField(id_col, T.StringType())] + list(schemas.INDEX_TABLE.fields) + [day])
    docs = docs.withColumn(day.name, F.coalesce(F.to_date("created_utc"), F.lit("1970-01-01").cast("date")))
    upsert(docs, path, [id_col], schema, schemas.INDEX_PARTITION)


def truncate(spark: SparkSession, table: str, database: str | None = None) -> None:
    """K9."""
    spark.sql(f"TRUNCATE TABLE {quoted(table, database)}")


def drop_tables(spark: SparkSession, table: str | None = None, database: str | None = None) -> list[str]:
    """Drop one table, or every table of the database; returns the dropped names."""
    names = [table] if table else [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(n, database)}")
    return names


def show(df: DataFrame, n: int = 20, truncate_cells: bool = True) -> None:
    """Console preview."""
    df.show(n, truncate=truncate_cells)
