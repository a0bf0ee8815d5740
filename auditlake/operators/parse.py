"""Parser path: raw events -> the 23-column parsed table with rule risk levels.

Kept separate from the feature path on purpose: it has its own sensitive-action
list, its own error flag (`errorCode` present, so an empty code counts) and its
own risk points (an empty code earns none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.functions import lists as L


def safe_get(col: str, default) -> Column:
    """Nested lookup with a default for a missing key, an explicit null, or a
    non-object parent (a typed read yields null for all three)."""
    return F.coalesce(F.col(col), F.lit(default))


def parser_points(raw: DataFrame) -> Column:
    t = C.parse_event_time("eventTime")
    hour, dow = F.hour(t), F.weekday(t)
    sens = C.in_list("eventName", L.PARSER_SENSITIVE_ACTIONS)
    bad_ip = C.in_list("sourceIPAddress", L.SUSPICIOUS_IPS)
    truthy_err = F.coalesce(F.col("errorCode") != F.lit(""), F.lit(False))
    off_hours = t.isNotNull() & ~C.is_business_hours(hour)
    weekend = t.isNotNull() & C.is_weekend(dow)
    return (F.when(sens, 2).otherwise(0) + F.when(bad_ip, 2).otherwise(0)
            + F.when(truthy_err, 1).otherwise(0) + F.when(off_hours, 1).otherwise(0)
            + F.when(weekend, 1).otherwise(0))


def parser_level(points: Column) -> Column:
    expr = None
    for lo, name in L.PARSER_RISK_LEVELS:
        expr = F.when(points >= lo, name) if expr is None else expr.when(points >= lo, name)
    return expr.otherwise("low")


def parse_events(raw: DataFrame) -> DataFrame:
    """Raw event rows -> parsed table (column order of the parser)."""
    t = C.parse_event_time("eventTime")
    hour, dow = F.hour(t), F.weekday(t)
    u = "userIdentity"
    return raw.select(
        safe_get("eventID", "").alias("event_id"),
        safe_get("eventTime", "").alias("event_time"),
        safe_get("eventSource", "").alias("event_source"),
        safe_get("eventName", "").alias("event_name"),
        safe_get("awsRegion", "").alias("aws_region"),
        safe_get(f"{u}.type", "").alias("user_type"),
        safe_get(f"{u}.userName", "Unknown").alias("user_name"),
        safe_get(f"{u}.arn", "").alias("user_arn"),
        safe_get(f"{u}.accountId", "").alias("account_id"),
        safe_get("sourceIPAddress", "").alias("source_ip"),
        safe_get("userAgent", "").alias("user_agent"),
        safe_get("errorCode", "").alias("error_code"),
        safe_get("errorMessage", "").alias("error_message"),
        hour.alias("hour_of_day"),
        dow.alias("day_of_week"),
        F.when(t.isNotNull(), C.is_business_hours(hour)).alias("is_business_hours"),
        F.when(t.isNotNull(), C.is_weekend(dow)).alias("is_weekend"),
        C.in_list("eventName", L.PARSER_SENSITIVE_ACTIONS).alias("is_sensitive_action"),
        C.in_list("sourceIPAddress", L.SUSPICIOUS_IPS).alias("is_suspicious_ip"),
        F.col("errorCode").isNotNull().alias("has_error"),
        parser_level(parser_points(raw)).alias("risk_level"),
        F.col("is_anomaly").alias("is_anomaly"),
        F.col("anomaly_type").alias("anomaly_type"),
    )
