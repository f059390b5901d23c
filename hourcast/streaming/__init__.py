"""Streaming jobs: hourly aggregation with watermarks and alerting per micro-batch."""

from hourcast.streaming.hourly import (
    once,
    rate_heartbeats,
    read_event_stream,
    read_heartbeats,
    replay_to_parquet,
    stream_hourly,
    write_heartbeats,
)
from hourcast.streaming.monitor import linear_scorer, run_monitor, tree_scorer

__all__ = ["read_event_stream", "stream_hourly", "replay_to_parquet",
           "rate_heartbeats", "write_heartbeats", "read_heartbeats", "once",
           "run_monitor", "linear_scorer", "tree_scorer"]
