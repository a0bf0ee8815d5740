"""Sinks (K1-K8) and the feature-table source.

All writers are DataFrame writers into a base path (any Hadoop file system:
`s3a://`, `abfss://`, `hdfs://` or local); nothing is gathered on the driver
except one-row summaries.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions import lists as L
from auditlake.schema import (EVENT_COLUMNS, FEATURE_COLUMNS, FLAT, NETWORK_COLUMNS,
                              RISK_COLUMNS, TEMPORAL_COLUMNS, TIME_COLUMNS, USER_COLUMNS)

NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_DOUBLES = {"user_error_rate", "user_activity_diversity", "time_since_prev_event",
            "risk_score_normalized"}
_STRINGS = {"time_period", "service_category", "risk_level"}
_LONGS = {"user_total_events", "user_unique_ips", "user_unique_event_types", "user_error_count",
          "event_type_frequency", "ip_event_count", "ip_unique_users", "events_this_minute",
          "user_events_this_hour"}


def features_schema() -> T.StructType:
    fields = list(FLAT.fields)
    for c in TIME_COLUMNS + USER_COLUMNS + EVENT_COLUMNS + NETWORK_COLUMNS + TEMPORAL_COLUMNS + RISK_COLUMNS:
        t = (T.DoubleType() if c in _DOUBLES else T.StringType() if c in _STRINGS
             else T.LongType() if c in _LONGS else T.IntegerType())
        fields.append(T.StructField(c, t))
    return T.StructType(fields)


# CSV that keeps line ends, quotes, outer spaces, and null apart from the empty text
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
       "ignoreTrailingWhiteSpace": False}
CSV_WRITE = {**CSV, "nullValue": "", "emptyValue": '""'}
# a bare empty field takes the null mark when read, a quoted one stays the empty text
CSV_READ = {**CSV, "nullValue": "\0", "emptyValue": "", "multiLine": True}


# ------------------------------------------------------------------ parsed
def write_parsed_csv(parsed: DataFrame, path: str) -> str | None:
    """K1: header + rows; nothing is written for an empty input."""
    if parsed.isEmpty():
        return None
    parsed.write.mode("error").options(**CSV_WRITE).csv(path)
    return path


def read_parsed_csv(spark: SparkSession, path: str | None, like: DataFrame) -> DataFrame:
    """The rows again, in the schema of `like`; no path (empty input): no rows."""
    if path is None:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).options(**CSV_READ).csv(path)


def write_parsed_json(parsed: DataFrame, path: str) -> str | None:
    """K2: JSON lines (one event per line, nulls kept)."""
    if parsed.isEmpty():
        return None
    parsed.write.mode("error").option("ignoreNullFields", "false").json(path)
    return path


# ---------------------------------------------------------------- features
def write_features(features: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K3: the feature table, partitioned by event date (partition pruning for
    time-bounded reports). Rows are dealt by date first; AQE splits large dates and joins small
    ones by their bytes, so files follow the data, not the tasks. CSV keeps the flat reference layout."""
    if fmt == "csv":
        (features.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
         .write.mode("error").options(**CSV_WRITE).option("timestampNTZFormat", NTZ_FORMAT).csv(path))
        return path
    (features.withColumn("event_date", F.to_date("event_time")).hint("rebalance", F.col("event_date"))
     .write.mode("error").partitionBy("event_date").parquet(path))
    return path


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The feature table with explicit types (no inference)."""
    if fmt == "csv":
        schema = features_schema()
        fields = [T.StructField(f.name, T.TimestampNTZType() if f.name == "event_time" else f.dataType)
                  for f in schema.fields]
        df = (spark.read.schema(T.StructType(fields)).options(**CSV_READ)
              .option("timestampNTZFormat", NTZ_FORMAT).csv(path))
        return df.withColumn("event_time", F.col("event_time").cast("timestamp"))
    schema = T.StructType([*features_schema().fields, T.StructField("event_date", T.DateType())])
    return spark.read.schema(schema).parquet(path).select(*FEATURE_COLUMNS)


def feature_summary_document(summary_row: DataFrame) -> DataFrame:
    """K4 shape: nested one-row document (risk distribution as a map)."""
    levels = [F.struct(F.lit(lv).alias("k"), F.col(f"risk_{lv}").alias("v")) for lv in L.RISK_LEVEL_ORDER]
    present = F.filter(F.array(*levels), lambda s: s["v"] > 0)
    return summary_row.select(
        "total_events", "total_features", F.split("features", ",").alias("features"),
        F.map_from_entries(present).alias("risk_distribution"), "unique_users", "unique_ips",
        F.struct(F.col("date_start").cast("string").alias("start"),
                 F.col("date_end").cast("string").alias("end")).alias("date_range"),
        "sensitive_action_count", "suspicious_ip_count", "error_count")


def write_one_row_json(doc: DataFrame, path: str) -> str:
    doc.coalesce(1).write.mode("error").json(path)
    return path


# ------------------------------------------------------------------ model
def save_model(spark: SparkSession, nodes, scaler: dict, params: dict, path: str) -> str:
    """K6: forest nodes and scaler statistics as Parquet, parameters as JSON."""
    spark.createDataFrame(nodes).write.mode("error").parquet(f"{path}/nodes")
    spark.createDataFrame([(k, float(m), float(s)) for k, (m, s) in scaler.items()],
                          "feature string, mean double, std double").coalesce(1) \
        .write.mode("error").parquet(f"{path}/scaler")
    spark.read.json(spark.sparkContext.parallelize([json.dumps(params)])).coalesce(1) \
        .write.mode("error").json(f"{path}/params")
    return path


def load_model(spark: SparkSession, path: str):
    from auditlake.ml.forest import Forest
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    scaler_rows = spark.read.parquet(f"{path}/scaler").collect()
    params = spark.read.json(f"{path}/params").first().asDict()
    scaler = {r["feature"]: (r["mean"], r["std"]) for r in scaler_rows}
    names = [c for c in L.ML_FEATURES if c in scaler]
    return Forest(nodes, int(params["max_samples"])), scaler, names, params


# ------------------------------------------------------------------ zones
ZONES = {
    "raw": "raw/cloudtrail_events",
    "features": "processed/features",
    "feature_summary": "processed/feature_summary",
    "predictions": "results/anomaly_predictions",
    "detection_summary": "results/detection_summary",
}


def write_zones(base: str, raw: DataFrame | None = None, features: DataFrame | None = None,
                feature_summary: DataFrame | None = None, predictions: DataFrame | None = None,
                detection_summary: DataFrame | None = None) -> dict:
    """K8: `raw/ processed/ results/` layout under one base path."""
    from auditlake.sources.raw import write_raw_files
    base = base.rstrip("/")
    out = {}
    if raw is not None:
        out["raw"] = write_raw_files(raw, f"{base}/{ZONES['raw']}")
    if features is not None:
        out["features"] = write_features(features, f"{base}/{ZONES['features']}")
    if feature_summary is not None:
        out["feature_summary"] = write_one_row_json(feature_summary, f"{base}/{ZONES['feature_summary']}")
    if predictions is not None:
        out["predictions"] = write_features(predictions, f"{base}/{ZONES['predictions']}")
    if detection_summary is not None:
        out["detection_summary"] = write_one_row_json(detection_summary,
                                                      f"{base}/{ZONES['detection_summary']}")
    return out
