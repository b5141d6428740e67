"""Declared-schema readers: landed JSON documents, columnar tables, JDBC and Kafka."""
from tickvault.sources.files import (read_json_docs, read_coin_list, read_tickers, read_meta,  # noqa: F401
                                     read_historic, load_table, read_or_empty, frame_from_records)
