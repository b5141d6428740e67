"""Writers: key-merge upsert (K1-K3), connector option builders (K4-K7), DDL and maintenance."""
from tickvault.sinks.merge import overwrite_partitions, upsert, merge_frames  # noqa: F401
