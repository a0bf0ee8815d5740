"""Raw audit-log files: `{"Records": [event, ...]}` JSON documents.

S1 reads them (one file is one task, so scale comes from many files — the
usual delivery layout of audit trails); the writer builds the same layout
from any flat table (used to produce the raw zone and test inputs).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.schema import RAW_EVENT, RAW_FILE

EVENTS_PER_FILE = 5000


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per event; a file without `Records` contributes no rows."""
    files = spark.read.schema(RAW_FILE).option("multiLine", True).json(path)
    return files.select(F.inline("Records"))


def flat_to_raw(flat: DataFrame) -> DataFrame:
    """Flat events -> raw event structs (time text cut to whole seconds)."""
    return flat.select(
        F.lit("1.08").alias("eventVersion"),
        F.col("event_id").alias("eventID"),
        F.date_format("event_time", C.ISO_SECONDS).alias("eventTime"),
        F.col("event_source").alias("eventSource"),
        F.col("event_name").alias("eventName"),
        F.col("aws_region").alias("awsRegion"),
        F.col("source_ip").alias("sourceIPAddress"),
        F.col("user_agent").alias("userAgent"),
        F.struct(F.col("user_type").alias("type"),
                 F.col("user_arn").alias("principalId"),
                 F.col("user_arn").alias("arn"),
                 F.col("account_id").alias("accountId"),
                 F.col("user_name").alias("userName")).alias("userIdentity"),
        F.col("error_code").alias("errorCode"),
        F.col("error_message").alias("errorMessage"),
        F.col("is_anomaly_original").alias("is_anomaly"),
        F.col("anomaly_type_original").alias("anomaly_type"),
    )


def write_raw_files(raw: DataFrame, path: str, events_per_file: int = EVENTS_PER_FILE,
                    rows: int | None = None) -> str:
    """Write raw events as many `{"Records": [...]}` files (explicit nulls kept).

    Events are spread over files by a hash of the event id and a per-row id,
    so every file holds about `events_per_file` events whatever the key skew.
    """
    rows = rows if rows is not None else raw.count()
    n_files = max(1, math.ceil(rows / max(1, events_per_file)))
    spread = F.pmod(F.xxhash64("eventID", F.monotonically_increasing_id()), F.lit(n_files))
    files = (raw.withColumn("file_id", spread)
             .groupBy("file_id")
             .agg(F.collect_list(F.struct(*[F.col(f.name) for f in RAW_EVENT.fields])).alias("Records")))
    (files.write.mode("error").option("ignoreNullFields", "false")
     .partitionBy("file_id").json(path))
    return path


def flat_columns() -> list:
    """P3 column expressions: raw event -> the 15 flat columns."""
    u = "userIdentity"
    return [
        F.col("eventID").alias("event_id"),
        C.parse_event_time("eventTime").alias("event_time"),
        F.col("eventSource").alias("event_source"),
        F.col("eventName").alias("event_name"),
        F.col("awsRegion").alias("aws_region"),
        F.col(f"{u}.type").alias("user_type"),
        F.coalesce(F.col(f"{u}.userName"), F.lit("Unknown")).alias("user_name"),
        F.col(f"{u}.arn").alias("user_arn"),
        F.col(f"{u}.accountId").alias("account_id"),
        F.col("sourceIPAddress").alias("source_ip"),
        F.col("userAgent").alias("user_agent"),
        F.col("errorCode").alias("error_code"),
        F.col("errorMessage").alias("error_message"),
        F.col("is_anomaly").alias("is_anomaly_original"),
        F.col("anomaly_type").alias("anomaly_type_original"),
    ]


def flatten_events(raw: DataFrame) -> DataFrame:
    """Raw events -> the 15-column flat table of the feature path."""
    return raw.select(*flat_columns())
