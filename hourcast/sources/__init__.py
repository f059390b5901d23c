"""Readers and writers.  Everything here is a distributed Spark read or write."""

from hourcast.sources.events import hourly_from_events, load_table
from hourcast.sources.readers import (
    read_feature_csv,
    read_feature_parquet,
    read_hourly_csv,
    read_jdbc,
    read_parquet,
)
from hourcast.sources.writers import (
    append_alerts,
    write_bucketed,
    write_checkpoint,
    write_feature_csv,
    write_feature_parquet,
    write_hourly_csv,
)

__all__ = [
    "hourly_from_events", "load_table",
    "read_hourly_csv", "read_feature_csv", "read_feature_parquet", "read_parquet", "read_jdbc",
    "write_bucketed", "write_checkpoint", "write_hourly_csv", "write_feature_csv", "write_feature_parquet",
    "append_alerts",
]
