"""Readers for hourly telemetry, positional feature rows and Parquet.

CSV is parsed with ``from_csv`` over ``spark.read.text`` rather than with the
CSV data source in DROPMALFORMED mode: the data source decides per query which
columns to parse, so a malformed row can be dropped by ``collect`` yet still be
counted by ``count``.  Parsing every line as one value with a corrupt-record
column gives one answer for every query shape.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.schema import FEATURE_SCHEMA, HOURLY_SCHEMA

BAD = "_corrupt_record"
# Text formats of the telemetry CSV files.
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DATE_FORMAT = "yyyy-MM-dd"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _n_fields(line: Column, delimiter: str, quote: str | None) -> Column:
    """Fields of a CSV line: delimiters outside quoted parts, and one.

    Quoted parts (a doubled or escaped quote stays inside) are cut from the
    text first; the delimiter is matched as plain text.
    """
    if quote:
        q = re.escape(quote)
        line = F.regexp_replace(line, f"{q}(?:[^{q}\\\\]|\\\\.|{q}{q})*{q}", "")
    return F.size(F.split(line, re.escape(delimiter), -1))


def read_hourly_csv(spark: SparkSession, path: str, schema: T.StructType = HOURLY_SCHEMA,
                    header: bool = True, delimiter: str = ",", quote: str | None = '"',
                    timestamp_format: str = TIMESTAMP_NTZ_FORMAT, date_format: str = DATE_FORMAT) -> DataFrame:
    """Hourly telemetry CSV with header; malformed lines are dropped.

    A line is malformed when a field does not parse to its type or the field
    count differs from the schema; empty lines are skipped.
    """
    lines = spark.read.text(path)
    if header:
        header_line = delimiter.join(schema.fieldNames())
        lines = lines.where(F.col("value") != F.lit(header_line))
    lines = lines.where(F.length("value") > 0)
    parse_schema = T.StructType(schema.fields + [T.StructField(BAD, T.StringType(), True)])
    opts = {
        "sep": delimiter,
        "quote": quote or "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD,
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": timestamp_format,
        "dateFormat": date_format,
    }
    n_fields = len(schema.fields)
    parsed = lines.select(
        F.from_csv(F.col("value"), _ddl(parse_schema), opts).alias("r"),
        # from_csv pads short lines with NULLs and ignores extra fields, so the
        # field count is checked on the raw text as well.
        (_n_fields(F.col("value"), delimiter, quote) == F.lit(n_fields)).alias("_arity_ok"),
    )
    return (
        parsed.where(F.col(f"r.{BAD}").isNull() & F.col("_arity_ok"))
        .select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])
    )


def read_feature_csv(spark: SparkSession, path: str, schema: T.StructType = FEATURE_SCHEMA) -> DataFrame:
    """Headerless lines of comma separated doubles; any bad field, or a line with
    the wrong number of fields, fails the job."""
    lines = spark.read.text(path)
    n_fields = len(schema.fields)
    arity = F.size(F.split(F.col("value"), ",", -1))
    checked = F.when(arity == F.lit(n_fields), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit(f"MALFORMED feature line (expected {n_fields} fields): "), F.col("value"))))
    parsed = lines.select(F.from_csv(checked, _ddl(schema), {"mode": "FAILFAST"}).alias("r"))
    return parsed.select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def read_feature_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURE_SCHEMA).parquet(path)


def read_parquet(spark: SparkSession, path: str, cache: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """``schema`` is needed where the table may be empty: a partitioned write of no rows leaves no file to infer it from."""
    df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    return df.persist() if cache else df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int = 8, properties: dict | None = None) -> DataFrame:
    """Warehouse source: a partitioned JDBC read (one range query per partition)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
