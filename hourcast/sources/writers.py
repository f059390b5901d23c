"""Sinks: Parquet checkpoints, CSV exports and the alerts table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.schema import FEATURE_COLUMNS
from hourcast.sources.readers import DATE_FORMAT, TIMESTAMP_NTZ_FORMAT


def write_checkpoint(df: DataFrame, path: str, partition_by: list[str] | None = None,
                     mode: str = "overwrite", cluster: bool = False) -> str:
    """Persist a frame as Parquet; reading it back starts a new lineage.

    ``cluster=True`` first rebalances on the ``partition_by`` columns: rows of a
    value come together (few files per value), and the adaptive planner
    splits a value whose rows are too many for one task.
    """
    if cluster and partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Save a frame as a Parquet table bucketed and sorted by ``keys`` and return it as a table.

    Rows are dealt by the same hash before the write, so each task writes the one file of
    its bucket.  Tables of the same keys and number of buckets join without an exchange.
    """
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def write_hourly_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    (df.write.mode(mode).option("header", True)
       .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT).option("dateFormat", DATE_FORMAT)
       .csv(path))
    return path


def write_feature_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Headerless positional rows of eight doubles (label at index 4)."""
    line = F.concat_ws(",", *[F.col(c).cast("double").cast("string") for c in FEATURE_COLUMNS])
    df.select(line.alias("value")).write.mode(mode).text(path)
    return path


def write_feature_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.select(*[F.col(c).cast("double") for c in FEATURE_COLUMNS]).write.mode(mode).parquet(path)
    return path


def append_alerts(alerts: DataFrame, path: str, partition_by: list[str] | None = None,
                  run_id: str | None = None) -> str:
    """Add alert rows to the alerts table.

    With ``run_id`` the rows go to ``path/run_id=<id>`` in overwrite mode, so a
    re-run of the same scoring run (after a failure) replaces its own rows
    instead of duplicating them; without it the rows are appended.
    """
    target = f"{path}/run_id={run_id}" if run_id is not None else path
    w = alerts.write.mode("overwrite" if run_id is not None else "append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return path
