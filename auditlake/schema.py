"""Explicit schemas at every boundary."""

from pyspark.sql import types as T

_S = T.StringType()

USER_IDENTITY = T.StructType([
    T.StructField("type", _S),
    T.StructField("principalId", _S),
    T.StructField("arn", _S),
    T.StructField("accountId", _S),
    T.StructField("userName", _S),
])

# One audit event as delivered in a log file. requestParameters and
# responseElements are never read, so they are not part of the read schema
# (column pruning at the JSON reader).
RAW_EVENT = T.StructType([
    T.StructField("eventVersion", _S),
    T.StructField("eventID", _S),
    T.StructField("eventTime", _S),
    T.StructField("eventSource", _S),
    T.StructField("eventName", _S),
    T.StructField("awsRegion", _S),
    T.StructField("sourceIPAddress", _S),
    T.StructField("userAgent", _S),
    T.StructField("userIdentity", USER_IDENTITY),
    T.StructField("errorCode", _S),
    T.StructField("errorMessage", _S),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("anomaly_type", _S),
])

# One log file: {"Records": [event, ...]}.
RAW_FILE = T.StructType([T.StructField("Records", T.ArrayType(RAW_EVENT))])

# Flat event table (15 columns) that the feature pipeline starts from.
FLAT = T.StructType([
    T.StructField("event_id", _S),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_source", _S),
    T.StructField("event_name", _S),
    T.StructField("aws_region", _S),
    T.StructField("user_type", _S),
    T.StructField("user_name", _S),
    T.StructField("user_arn", _S),
    T.StructField("account_id", _S),
    T.StructField("source_ip", _S),
    T.StructField("user_agent", _S),
    T.StructField("error_code", _S),
    T.StructField("error_message", _S),
    T.StructField("is_anomaly_original", T.BooleanType()),
    T.StructField("anomaly_type_original", _S),
])
FLAT_COLUMNS = [f.name for f in FLAT.fields]

# Parsed table of the parser path (23 columns, in order).
PARSED_COLUMNS = [
    "event_id", "event_time", "event_source", "event_name", "aws_region",
    "user_type", "user_name", "user_arn", "account_id", "source_ip",
    "user_agent", "error_code", "error_message", "hour_of_day", "day_of_week",
    "is_business_hours", "is_weekend", "is_sensitive_action",
    "is_suspicious_ip", "has_error", "risk_level", "is_anomaly", "anomaly_type",
]

TIME_COLUMNS = [
    "hour", "day_of_week", "day_of_month", "month", "minute",
    "is_business_hours", "is_weekend", "is_late_night", "time_period",
    "time_period_encoded",
]
USER_COLUMNS = [
    "user_total_events", "user_unique_ips", "user_unique_event_types",
    "user_error_count", "user_error_rate", "is_new_user",
    "user_activity_diversity",
]
EVENT_COLUMNS = [
    "is_sensitive_action", "is_recon_action", "is_data_access", "has_error",
    "is_access_denied", "service_category", "service_category_encoded",
    "event_type_frequency", "is_rare_event",
]
NETWORK_COLUMNS = [
    "is_suspicious_ip", "is_internal_ip", "is_aws_internal", "ip_event_count",
    "ip_unique_users", "is_shared_ip", "is_suspicious_user_agent",
    "is_console_access",
]
TEMPORAL_COLUMNS = [
    "time_since_prev_event", "is_rapid_event", "events_this_minute",
    "is_burst_activity", "user_events_this_hour", "is_unusual_user_activity",
]
RISK_COLUMNS = [
    "risk_score", "risk_score_normalized", "risk_level", "risk_level_encoded",
]

# Feature table (59 columns, in order).
FEATURE_COLUMNS = (FLAT_COLUMNS + TIME_COLUMNS + USER_COLUMNS + EVENT_COLUMNS
                   + NETWORK_COLUMNS + TEMPORAL_COLUMNS + RISK_COLUMNS)
