"""tickvault: market time series and the posts written about them, on Spark.

Everything is DataFrame / Spark SQL work that Catalyst plans. Sub-packages:

* ``sources``   – declared-schema readers (landed JSON, columnar files, JDBC, Kafka options)
* ``functions`` – column-expression helpers (null defaults, time parsing, nested lookups)
* ``operators`` – DataFrame -> DataFrame building blocks (flatten, select/rank, joins, top-n, search)
* ``sinks``     – key-merge writer (upsert), connector option builders, DDL
* ``streaming`` – Structured Streaming ingest (JSON messages -> typed rows -> idempotent merge)
* ``plans``     – composed jobs and the registered query set used by ``__spark_entry__``

Top-level modules: ``session`` (session factory, shared checkpoint folder, ``scale_conf`` sizing),
``schemas`` (every declared StructType) and ``errors`` (log-and-re-raise wrapper for jobs).
"""

__version__ = "0.1.0"
