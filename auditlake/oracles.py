"""DuckDB oracle SQL, one text per registered query.

Written independently of the Spark operators: plain SQL with window
aggregates over the same fixture view. Only the fixture text is shared.
Computed doubles that depend on summation order are rounded to 6 places on
both sides; integer sums are cast to BIGINT; calendar parts to INTEGER.
"""

from __future__ import annotations

from auditlake import oracles_stored
from auditlake.sources.fixture import FIXTURE_SQL

TRAIL = FIXTURE_SQL.format(events="events")

_ERR = {
    "present": "COALESCE(error_code <> '', false)",
    "reference": "(error_code IS DISTINCT FROM '')",
}

_SUS_UA = "kali|parrot|pentoo|blackarch|sqlmap|nikto|nmap|masscan|curl|wget|python-requests"


def feature_ctes(semantics: str = "present") -> str:
    err = _ERR[semantics]
    return f"""
trail AS ({TRAIL}),
f0 AS (
  SELECT *,
    CAST(hour(event_time) AS INTEGER) AS hour,
    CAST(isodow(event_time) - 1 AS INTEGER) AS day_of_week,
    CAST(dayofmonth(event_time) AS INTEGER) AS day_of_month,
    CAST(month(event_time) AS INTEGER) AS month,
    CAST(minute(event_time) AS INTEGER) AS minute,
    CASE WHEN {err} THEN 1 ELSE 0 END AS has_error
  FROM trail
),
f1 AS (
  SELECT *,
    CASE WHEN hour BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS is_business_hours,
    CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_late_night,
    CASE WHEN hour >= 6 AND hour < 12 THEN 'morning' WHEN hour >= 12 AND hour < 17 THEN 'afternoon'
         WHEN hour >= 17 AND hour < 21 THEN 'evening' ELSE 'night' END AS time_period,
    CASE WHEN hour >= 6 AND hour < 12 THEN 0 WHEN hour >= 12 AND hour < 17 THEN 1
         WHEN hour >= 17 AND hour < 21 THEN 2 ELSE 3 END AS time_period_encoded,
    CASE WHEN user_name IS NULL THEN NULL ELSE COUNT(*) OVER (PARTITION BY user_name) END AS user_total_events,
    CASE WHEN user_name IS NULL THEN NULL ELSE COUNT(DISTINCT source_ip) OVER (PARTITION BY user_name) END AS user_unique_ips,
    CASE WHEN user_name IS NULL THEN NULL ELSE COUNT(DISTINCT event_name) OVER (PARTITION BY user_name) END AS user_unique_event_types,
    CASE WHEN user_name IS NULL THEN NULL ELSE CAST(SUM(has_error) OVER (PARTITION BY user_name) AS BIGINT) END AS user_error_count,
    CASE WHEN event_name IN ('CreateUser','CreateAccessKey','AttachUserPolicy','PutUserPolicy','AddUserToGroup',
         'CreateRole','DeleteUser','DeleteAccessKey','StopLogging','DeleteTrail','UpdateTrail','DeleteBucket',
         'CreateDBSnapshot','CopyDBSnapshot','ListSecrets','GetSecretValue','PutBucketPolicy',
         'DeleteBucketPolicy','CreateLoginProfile') THEN 1 ELSE 0 END AS is_sensitive_action,
    CASE WHEN event_name IN ('ListUsers','ListRoles','ListBuckets','ListAccessKeys','DescribeInstances',
         'DescribeDBInstances','ListSecrets','GetAccountSummary','ListGroups','ListPolicies') THEN 1 ELSE 0 END AS is_recon_action,
    CASE WHEN event_name IN ('GetObject','PutObject','DeleteObject','CopyObject','GetBucketAcl','GetObjectAcl')
         THEN 1 ELSE 0 END AS is_data_access,
    CASE WHEN strpos(error_code, 'AccessDenied') > 0 OR strpos(error_code, 'Unauthorized') > 0 THEN 1 ELSE 0 END AS is_access_denied,
    CASE WHEN strpos(lower(event_source), 'iam') > 0 THEN 'identity'
         WHEN strpos(lower(event_source), 's3') > 0 THEN 'storage'
         WHEN strpos(lower(event_source), 'ec2') > 0 THEN 'compute'
         WHEN strpos(lower(event_source), 'rds') > 0 THEN 'database'
         WHEN strpos(lower(event_source), 'lambda') > 0 THEN 'serverless'
         WHEN strpos(lower(event_source), 'cloudtrail') > 0 THEN 'audit' ELSE 'other' END AS service_category,
    CASE WHEN event_name IS NULL THEN NULL ELSE COUNT(*) OVER (PARTITION BY event_name) END AS event_type_frequency,
    CASE WHEN source_ip IN ('45.227.255.206','103.75.118.91','185.220.101.34','91.240.118.172','23.94.188.246')
         THEN 1 ELSE 0 END AS is_suspicious_ip,
    CASE WHEN starts_with(source_ip, '192.168.') OR starts_with(source_ip, '10.') THEN 1
         WHEN starts_with(source_ip, '172.') AND TRY_CAST(split_part(source_ip, '.', 2) AS INTEGER) BETWEEN 16 AND 31 THEN 1
         ELSE 0 END AS is_internal_ip,
    CASE WHEN strpos(source_ip, 'amazonaws.com') > 0 OR strpos(source_ip, 'aws.internal') > 0 THEN 1 ELSE 0 END AS is_aws_internal,
    CASE WHEN source_ip IS NULL THEN NULL ELSE COUNT(*) OVER (PARTITION BY source_ip) END AS ip_event_count,
    CASE WHEN source_ip IS NULL THEN NULL ELSE COUNT(DISTINCT user_name) OVER (PARTITION BY source_ip) END AS ip_unique_users,
    CASE WHEN regexp_matches(lower(user_agent), '{_SUS_UA}') THEN 1 ELSE 0 END AS is_suspicious_user_agent,
    CASE WHEN strpos(lower(user_agent), 'console') > 0 THEN 1 ELSE 0 END AS is_console_access,
    COALESCE(CAST(epoch_us(event_time) - epoch_us(LAG(event_time) OVER (
        ORDER BY event_time ASC NULLS LAST, event_id ASC NULLS FIRST)) AS DOUBLE) / 1e6, 0.0) AS time_since_prev_event,
    CASE WHEN event_time IS NULL THEN NULL
         ELSE COUNT(*) OVER (PARTITION BY date_trunc('minute', event_time)) END AS events_this_minute,
    CASE WHEN user_name IS NULL THEN NULL
         ELSE COUNT(*) OVER (PARTITION BY date_trunc('hour', event_time), user_name) END AS user_events_this_hour
  FROM f0
),
f2 AS (
  SELECT *,
    CAST(user_error_count AS DOUBLE) / user_total_events AS user_error_rate,
    CASE WHEN user_total_events < 5 THEN 1 ELSE 0 END AS is_new_user,
    CAST(user_unique_event_types AS DOUBLE) / user_total_events AS user_activity_diversity,
    CASE service_category WHEN 'identity' THEN 0 WHEN 'storage' THEN 1 WHEN 'compute' THEN 2
         WHEN 'database' THEN 3 WHEN 'serverless' THEN 4 WHEN 'audit' THEN 5 ELSE 6 END AS service_category_encoded,
    CASE WHEN event_type_frequency < 10 THEN 1 ELSE 0 END AS is_rare_event,
    CASE WHEN ip_unique_users > 1 THEN 1 ELSE 0 END AS is_shared_ip,
    CASE WHEN time_since_prev_event > 0 AND time_since_prev_event < 1 THEN 1 ELSE 0 END AS is_rapid_event,
    CASE WHEN events_this_minute > 10 THEN 1 ELSE 0 END AS is_burst_activity,
    CASE WHEN user_events_this_hour > 20 THEN 1 ELSE 0 END AS is_unusual_user_activity
  FROM f1
),
f3 AS (
  SELECT *,
    CAST(3 * is_sensitive_action + 2 * is_recon_action + 3 * is_suspicious_ip + 2 * is_suspicious_user_agent
       + is_late_night + is_weekend + has_error + 2 * is_access_denied + 2 * is_burst_activity
       + is_new_user + is_rare_event AS INTEGER) AS risk_score
  FROM f2
),
f4 AS (
  SELECT *, ROUND(CAST(risk_score AS DOUBLE) / 19 * 100, 2) AS risk_score_normalized FROM f3
),
feat AS (
  SELECT event_id, CAST(event_time AS TIMESTAMP) AS event_time, event_source, event_name, aws_region,
    user_type, user_name, user_arn, account_id, source_ip, user_agent, error_code, error_message,
    is_anomaly_original, anomaly_type_original,
    hour, day_of_week, day_of_month, month, minute, is_business_hours, is_weekend, is_late_night,
    time_period, time_period_encoded,
    user_total_events, user_unique_ips, user_unique_event_types, user_error_count, user_error_rate,
    is_new_user, user_activity_diversity,
    is_sensitive_action, is_recon_action, is_data_access, has_error, is_access_denied, service_category,
    service_category_encoded, event_type_frequency, is_rare_event,
    is_suspicious_ip, is_internal_ip, is_aws_internal, ip_event_count, ip_unique_users, is_shared_ip,
    is_suspicious_user_agent, is_console_access,
    time_since_prev_event, is_rapid_event, events_this_minute, is_burst_activity, user_events_this_hour,
    is_unusual_user_activity,
    risk_score, risk_score_normalized,
    CASE WHEN risk_score_normalized >= 70 THEN 'critical' WHEN risk_score_normalized >= 50 THEN 'high'
         WHEN risk_score_normalized >= 25 THEN 'medium' ELSE 'low' END AS risk_level,
    CASE WHEN risk_score_normalized >= 70 THEN 3 WHEN risk_score_normalized >= 50 THEN 2
         WHEN risk_score_normalized >= 25 THEN 1 ELSE 0 END AS risk_level_encoded
  FROM f4
)"""


def with_features(select: str, semantics: str = "present") -> str:
    return f"WITH {feature_ctes(semantics)}\n{select}"


def feature_cols(*cols: str, semantics: str = "present") -> str:
    return with_features(f"SELECT event_id, {', '.join(cols)} FROM feat", semantics)


# ------------------------------------------------------------------ lists
_SENS14 = ("'CreateUser','CreateAccessKey','AttachUserPolicy','PutUserPolicy','AddUserToGroup','CreateRole',"
           "'StopLogging','DeleteTrail','UpdateTrail','DeleteBucket','CreateDBSnapshot','CopyDBSnapshot',"
           "'ListSecrets','GetSecretValue'")
_BAD_IPS = "'45.227.255.206','103.75.118.91','185.220.101.34','91.240.118.172','23.94.188.246'"


def parsed_ctes(include_trail: bool = True) -> str:
    head = f"trail AS ({TRAIL})," if include_trail else ""
    return f"""
{head}
p0 AS (
  SELECT
    COALESCE(event_id, '') AS event_id,
    COALESCE(strftime(event_time, '%Y-%m-%dT%H:%M:%SZ'), '') AS event_time,
    COALESCE(event_source, '') AS event_source,
    COALESCE(event_name, '') AS event_name,
    COALESCE(aws_region, '') AS aws_region,
    COALESCE(user_type, '') AS user_type,
    COALESCE(user_name, 'Unknown') AS user_name,
    COALESCE(user_arn, '') AS user_arn,
    COALESCE(account_id, '') AS account_id,
    COALESCE(source_ip, '') AS source_ip,
    COALESCE(user_agent, '') AS user_agent,
    COALESCE(error_code, '') AS error_code,
    COALESCE(error_message, '') AS error_message,
    CAST(hour(event_time) AS INTEGER) AS hour_of_day,
    CAST(isodow(event_time) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN event_time IS NULL THEN NULL ELSE hour(event_time) BETWEEN 9 AND 18 END AS is_business_hours,
    CASE WHEN event_time IS NULL THEN NULL ELSE isodow(event_time) >= 6 END AS is_weekend,
    COALESCE(event_name IN ({_SENS14}), false) AS is_sensitive_action,
    COALESCE(source_ip IN ({_BAD_IPS}), false) AS is_suspicious_ip,
    error_code IS NOT NULL AS has_error,
    (CASE WHEN event_name IN ({_SENS14}) THEN 2 ELSE 0 END
     + CASE WHEN source_ip IN ({_BAD_IPS}) THEN 2 ELSE 0 END
     + CASE WHEN error_code <> '' THEN 1 ELSE 0 END
     + CASE WHEN event_time IS NOT NULL AND NOT (hour(event_time) BETWEEN 9 AND 18) THEN 1 ELSE 0 END
     + CASE WHEN event_time IS NOT NULL AND isodow(event_time) >= 6 THEN 1 ELSE 0 END) AS pts,
    is_anomaly_original AS is_anomaly,
    anomaly_type_original AS anomaly_type
  FROM trail
),
p AS (
  SELECT * EXCLUDE (pts),
    CASE WHEN pts >= 4 THEN 'critical' WHEN pts >= 3 THEN 'high' WHEN pts >= 1 THEN 'medium' ELSE 'low' END AS risk_level
  FROM p0
)"""


def with_parsed(select: str) -> str:
    return f"WITH {parsed_ctes()}\n{select}"


_PARSED_COLS = ("event_id, event_time, event_source, event_name, aws_region, user_type, user_name, user_arn, "
                "account_id, source_ip, user_agent, error_code, error_message, hour_of_day, day_of_week, "
                "is_business_hours, is_weekend, is_sensitive_action, is_suspicious_ip, has_error, risk_level, "
                "is_anomaly, anomaly_type")


def _levels(src: str, col: str, order: list[str], out_col: str | None = None, pct: bool = True) -> str:
    out_col = out_col or col
    values = ", ".join(f"({i}, '{v}')" for i, v in enumerate(order))
    pct_sql = (", ROUND(COALESCE(CAST(COALESCE(c.n, 0) AS DOUBLE) * 100.0 / NULLIF(t.total, 0), 0.0), 6) AS pct"
               if pct else "")
    return f"""lv(ord, lvl) AS (VALUES {values}),
c AS (SELECT {col} AS lvl, COUNT(*) AS n FROM {src} GROUP BY {col}),
t AS (SELECT COUNT(*) AS total FROM {src})
SELECT lv.lvl AS {out_col}, CAST(COALESCE(c.n, 0) AS BIGINT) AS count{pct_sql}
FROM lv LEFT JOIN c ON lv.lvl = c.lvl, t ORDER BY lv.ord"""


def _rule_ctes() -> str:
    return feature_ctes("present") + """,
r AS (SELECT *, -risk_score_normalized AS d, CASE WHEN is_anomaly_original = true THEN 1 ELSE 0 END AS y FROM feat),
st AS (SELECT quantile_cont(d, 0.1) AS off, min(d) AS dmin, max(d) AS dmax FROM r),
rp0 AS (SELECT r.*, CASE WHEN d - st.off < 0 THEN 1 ELSE 0 END AS ml_anomaly_prediction,
          (1.0 - (d - st.dmin) / NULLIF(st.dmax - st.dmin, 0)) * 100.0 AS score_raw FROM r, st),
rp1 AS (SELECT *, round_even(score_raw, 2) AS ml_anomaly_score FROM rp0),
rp AS (SELECT *, CASE WHEN ml_anomaly_score >= 80 THEN 'critical' WHEN ml_anomaly_score >= 60 THEN 'high'
                      WHEN ml_anomaly_score >= 40 THEN 'medium' ELSE 'low' END AS ml_severity FROM rp1)"""


def _rule(select: str) -> str:
    return f"WITH {_rule_ctes()}\n{select}"


_CONFUSION = """SELECT CAST(SUM(CASE WHEN y = 0 AND ml_anomaly_prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS true_negatives,
  CAST(SUM(CASE WHEN y = 0 AND ml_anomaly_prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
  CAST(SUM(CASE WHEN y = 1 AND ml_anomaly_prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives,
  CAST(SUM(CASE WHEN y = 1 AND ml_anomaly_prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS true_positives FROM rp"""

_ML34 = ["hour", "day_of_week", "is_business_hours", "is_weekend", "is_late_night", "time_period_encoded",
         "user_total_events", "user_unique_ips", "user_unique_event_types", "user_error_rate", "is_new_user",
         "user_activity_diversity", "is_sensitive_action", "is_recon_action", "is_data_access", "has_error",
         "is_access_denied", "service_category_encoded", "event_type_frequency", "is_rare_event",
         "is_suspicious_ip", "is_internal_ip", "ip_event_count", "ip_unique_users", "is_shared_ip",
         "is_suspicious_user_agent", "is_console_access", "time_since_prev_event", "is_rapid_event",
         "events_this_minute", "is_burst_activity", "user_events_this_hour", "is_unusual_user_activity",
         "risk_score_normalized"]


def _ranked(columns: str, where: str, order: str, listed: int) -> str:
    """The first rows of a filtered list, by a numbered window."""
    return f"SELECT {columns} FROM feat WHERE {where} QUALIFY row_number() OVER (ORDER BY {order}) <= {listed}"


def _tally(key: str, **columns: str) -> str:
    """Aggregates by a key, each over a narrow projection of the feature table."""
    listed = ", ".join(f"{value} AS {name}" for name, value in columns.items())
    return f"SELECT {key}, {listed} FROM feat GROUP BY ALL"


def _sql_catalog() -> dict[str, str]:
    """The named reports, from their definitions: which key, which tallies, which rows and how many."""
    rows = "count(event_id)"             # every event has an id here
    found = {
        "total_events": "SELECT sum(n)::BIGINT AS total_events FROM (SELECT risk_level, count(*) AS n FROM feat GROUP BY ALL)",
        "risk_distribution": _tally("risk_level", count=rows),
        "top_users": f"""SELECT * FROM ({_tally("user_name", event_count=rows, sensitive_actions="count_if(is_sensitive_action = 1)::BIGINT",
                     errors="count_if(has_error = 1)::BIGINT", avg_risk_score="round(sum(risk_score_normalized) / count(risk_score_normalized), 2)")})
QUALIFY row_number() OVER (ORDER BY event_count DESC, user_name NULLS FIRST) <= 10""",
        "high_risk_events": _ranked("user_name, source_ip, event_name, event_time, risk_level, risk_score_normalized",
                                    "risk_level_encoded >= 2", "risk_score_normalized DESC, event_id", 50),
        "hourly_pattern": _tally("hour", event_count=rows, anomaly_count="count_if(coalesce(is_anomaly_original, false))::BIGINT"),
        "anomaly_summary": """SELECT anomaly_type_original, n AS count FROM (
  SELECT anomaly_type_original, is_anomaly_original AS planted, count(event_id) AS n FROM feat GROUP BY ALL) WHERE planted""",
        "suspicious_ips": """SELECT source_ip, sum(n)::BIGINT AS event_count, count(user_name) AS unique_users, sum(wrong)::BIGINT AS error_count
FROM (SELECT source_ip, user_name, count(event_id) AS n, count_if(has_error = 1) AS wrong FROM feat WHERE is_suspicious_ip > 0 GROUP BY ALL)
GROUP BY source_ip""",
        "sensitive_actions": _ranked("event_name, user_name, source_ip, event_time, risk_score_normalized",
                                     "is_sensitive_action > 0", "event_time DESC NULLS LAST, event_id", 50),
    }
    # a report reads the same from the plan and from the stored table
    return {f"{where}_{name}": with_features(text) for name, text in found.items() for where in ("sql", "stored")}


def _published() -> str:
    """Rows and checksum of every published zone."""
    def zone(name: str, table: str, *keys: str) -> str:
        text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
        return (f"SELECT '{name}' AS zone, count(*) AS rows, CAST(coalesce(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)), 0) AS BIGINT) "
                f"AS checksum, true AS intact FROM {table}")
    parts = [zone("raw", "trail", "event_id"), zone("features", "rp", "event_id", "risk_score", "risk_level"),
             zone("predictions", "rp", "event_id", "ml_anomaly_prediction", "ml_severity"),
             zone("feature_summary", "(SELECT count(*) AS a, sum(is_sensitive_action) AS b, sum(has_error) AS c FROM rp)", "a", "b", "c"),
             zone("detection_summary", "(SELECT count(*) AS a, sum(ml_anomaly_prediction) AS b FROM rp)", "a", "b")]
    return _rule("\nUNION ALL ".join(parts))


def _holdout() -> str:
    """Key counts of the events up to the cut, applied to both parts; window counts within a part."""
    return f"""WITH trail AS ({TRAIL}),
ranked AS (SELECT event_time, row_number() OVER (ORDER BY event_time) - 1 AS r, count(*) OVER () AS n FROM trail WHERE event_time IS NOT NULL),
cut AS (SELECT event_time AS at FROM ranked WHERE r = (n - 1) * 80 // 100),
parted AS (SELECT t.*, CASE WHEN t.event_time > cut.at THEN 'test' ELSE 'train' END AS part FROM trail t, cut),
users AS (SELECT user_name, count(*) AS n, count(DISTINCT source_ip) AS ips, count(DISTINCT event_name) AS kinds,
    count(*) FILTER (error_code IS NOT NULL AND error_code <> '') AS errors FROM parted WHERE part = 'train' GROUP BY user_name),
kinds AS (SELECT event_name, count(*) AS n FROM parted WHERE part = 'train' GROUP BY event_name),
ips AS (SELECT source_ip, count(*) AS n, count(DISTINCT user_name) AS users FROM parted WHERE part = 'train' GROUP BY source_ip),
joined AS (SELECT p.event_id, p.part, p.user_name, u.ips, u.kinds, u.errors,
    CASE WHEN p.user_name IS NOT NULL THEN coalesce(u.n, 0) END AS total,
    CASE WHEN p.event_name IS NOT NULL THEN coalesce(k.n, 0) END AS event_type_frequency,
    CASE WHEN p.source_ip IS NOT NULL THEN coalesce(i.n, 0) END AS ip_event_count,
    CASE WHEN p.source_ip IS NOT NULL THEN coalesce(i.users, 0) END AS ip_unique_users,
    CASE WHEN p.event_time IS NOT NULL THEN count(*) OVER (PARTITION BY part, date_trunc('minute', p.event_time)) END AS events_this_minute,
    CASE WHEN p.user_name IS NOT NULL THEN count(*) OVER (PARTITION BY part, date_trunc('hour', p.event_time), p.user_name) END AS user_events_this_hour
  FROM parted p LEFT JOIN users u ON u.user_name = p.user_name LEFT JOIN kinds k ON k.event_name = p.event_name
  LEFT JOIN ips i ON i.source_ip = p.source_ip)
SELECT event_id, part, total AS user_total_events,
  CASE WHEN user_name IS NOT NULL THEN coalesce(ips, 0) END AS user_unique_ips,
  CASE WHEN user_name IS NOT NULL THEN coalesce(kinds, 0) END AS user_unique_event_types,
  CASE WHEN user_name IS NOT NULL THEN coalesce(errors, 0) END AS user_error_count,
  CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE errors::DOUBLE / total END AS user_error_rate,
  CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE kinds::DOUBLE / total END AS user_activity_diversity,
  CASE WHEN total < 5 THEN 1 ELSE 0 END AS is_new_user, event_type_frequency,
  CASE WHEN event_type_frequency < 10 THEN 1 ELSE 0 END AS is_rare_event, ip_event_count, ip_unique_users,
  events_this_minute, user_events_this_hour FROM joined"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    # ---- parser and sources
    o["src_raw_records"] = f"""WITH trail AS ({TRAIL})
SELECT event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS eventTime, event_name AS eventName,
  user_name, source_ip AS sourceIPAddress, error_code AS errorCode FROM trail"""
    o["safe_get"] = with_parsed("SELECT event_id, user_name, source_ip, error_code FROM p")
    o["flatten_parsed"] = with_parsed(f"SELECT {_PARSED_COLS} FROM p")
    o["flatten_events"] = f"""WITH trail AS ({TRAIL})
SELECT event_id, date_trunc('second', event_time) AS event_time, event_source, event_name, aws_region,
  user_type, COALESCE(user_name, 'Unknown') AS user_name, user_arn, account_id, source_ip, user_agent,
  error_code, error_message, is_anomaly_original, anomaly_type_original FROM trail"""
    o["parse_timestamp"] = with_parsed(
        "SELECT event_id, hour_of_day, day_of_week, is_business_hours, is_weekend FROM p")
    o["parsed_sensitive"] = with_parsed("SELECT event_id, is_sensitive_action FROM p")
    o["parsed_suspicious_ip"] = with_parsed("SELECT event_id, is_suspicious_ip FROM p")
    o["parsed_has_error"] = with_parsed("SELECT event_id, has_error FROM p")
    o["parsed_risk_level"] = with_parsed("SELECT event_id, risk_level FROM p")
    o["sink_parsed_csv"] = with_parsed("SELECT event_id, event_time, risk_level, has_error FROM p")
    o["sink_parsed_json"] = o["sink_parsed_csv"]
    o["sink_features"] = feature_cols("event_time", "risk_score", "risk_level")
    o["src_features"] = feature_cols("event_time", "user_total_events", "time_since_prev_event", "risk_level")
    o["sink_zones"] = f"""WITH trail AS ({TRAIL})
SELECT 'raw' AS zone, COUNT(*) AS rows FROM trail UNION ALL SELECT 'processed' AS zone, COUNT(*) AS rows FROM trail"""
    o["feature_summary"] = with_features("""SELECT COUNT(*) AS total_events, 59 AS total_features,
  '""" + ",".join(_FEATURE_ORDER) + """' AS features,
  COUNT(*) FILTER (WHERE risk_level = 'low') AS risk_low,
  COUNT(*) FILTER (WHERE risk_level = 'medium') AS risk_medium,
  COUNT(*) FILTER (WHERE risk_level = 'high') AS risk_high,
  COUNT(*) FILTER (WHERE risk_level = 'critical') AS risk_critical,
  COUNT(DISTINCT user_name) AS unique_users, COUNT(DISTINCT source_ip) AS unique_ips,
  MIN(event_time) AS date_start, MAX(event_time) AS date_end,
  CAST(SUM(is_sensitive_action) AS BIGINT) AS sensitive_action_count,
  CAST(SUM(is_suspicious_ip) AS BIGINT) AS suspicious_ip_count,
  CAST(SUM(has_error) AS BIGINT) AS error_count FROM feat""")
    o["sink_feature_summary"] = with_features("""SELECT COUNT(*) AS total_events, 59 AS total_features,
  59 AS n_feature_names,
  CASE WHEN COUNT(*) FILTER (WHERE risk_level = 'low') > 0 THEN COUNT(*) FILTER (WHERE risk_level = 'low') END AS risk_low,
  CASE WHEN COUNT(*) FILTER (WHERE risk_level = 'medium') > 0 THEN COUNT(*) FILTER (WHERE risk_level = 'medium') END AS risk_medium,
  COUNT(DISTINCT user_name) AS unique_users, COUNT(DISTINCT source_ip) AS unique_ips,
  CAST(SUM(has_error) AS BIGINT) AS error_count FROM feat""")
    # ---- per-event features
    for key, col in [("time_hour", "hour"), ("time_day_of_week", "day_of_week"),
                     ("time_day_of_month", "day_of_month"), ("time_month", "month"), ("time_minute", "minute"),
                     ("time_is_business_hours", "is_business_hours"), ("time_is_weekend", "is_weekend"),
                     ("time_is_late_night", "is_late_night"), ("time_period", "time_period"),
                     ("time_period_encoded", "time_period_encoded"),
                     ("user_total_events", "user_total_events"), ("user_unique_ips", "user_unique_ips"),
                     ("user_unique_event_types", "user_unique_event_types"),
                     ("user_error_count", "user_error_count"), ("user_error_rate", "user_error_rate"),
                     ("user_is_new", "is_new_user"), ("user_activity_diversity", "user_activity_diversity"),
                     ("event_is_sensitive", "is_sensitive_action"), ("event_is_recon", "is_recon_action"),
                     ("event_is_data_access", "is_data_access"), ("event_has_error", "has_error"),
                     ("event_is_access_denied", "is_access_denied"),
                     ("event_service_category", "service_category"),
                     ("event_service_encoded", "service_category_encoded"),
                     ("event_type_frequency", "event_type_frequency"), ("event_is_rare", "is_rare_event"),
                     ("net_is_suspicious_ip", "is_suspicious_ip"), ("net_is_internal_ip", "is_internal_ip"),
                     ("net_is_aws_internal", "is_aws_internal"), ("net_ip_event_count", "ip_event_count"),
                     ("net_ip_unique_users", "ip_unique_users"), ("net_is_shared_ip", "is_shared_ip"),
                     ("net_is_suspicious_ua", "is_suspicious_user_agent"), ("net_is_console", "is_console_access"),
                     ("temp_time_since_prev", "time_since_prev_event"), ("temp_is_rapid", "is_rapid_event"),
                     ("temp_events_this_minute", "events_this_minute"), ("temp_is_burst", "is_burst_activity"),
                     ("temp_user_events_this_hour", "user_events_this_hour"),
                     ("temp_is_unusual_user", "is_unusual_user_activity"),
                     ("risk_score", "risk_score"), ("risk_score_normalized", "risk_score_normalized"),
                     ("risk_level", "risk_level"), ("risk_level_encoded", "risk_level_encoded")]:
        o[key] = feature_cols(col)
    o["user_error_count_ref"] = feature_cols("user_error_count", semantics="reference")
    o["event_has_error_ref"] = feature_cols("has_error", semantics="reference")
    o["risk_score_ref"] = feature_cols("risk_score", semantics="reference")
    o["features_full"] = with_features("SELECT * FROM feat")
    o["features_after_dedup"] = o["features_full"]
    o["features_full_ref"] = with_features("SELECT * FROM feat", "reference")
    o["join_threat_feed"] = feature_cols("is_suspicious_ip")
    # ---- summaries
    o["parse_risk_distribution"] = with_parsed(",\n" + _levels("p", "risk_level", ["low", "medium", "high", "critical"]))
    o["parse_anomaly_distribution"] = with_parsed("""SELECT COUNT(*) FILTER (WHERE is_anomaly = false) AS normal_count,
  COUNT(*) FILTER (WHERE is_anomaly = true) AS anomaly_count FROM p""")
    o["parse_top_event_types"] = with_parsed("""SELECT event_name, COUNT(*) AS event_count FROM p GROUP BY event_name
ORDER BY event_count DESC, event_name ASC NULLS FIRST LIMIT 10""")
    o["parse_events_per_user"] = with_parsed(
        "SELECT user_name, COUNT(*) AS event_count FROM p GROUP BY user_name ORDER BY user_name")
    o["parse_totals"] = with_parsed("""SELECT COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_sensitive_action) AS sensitive_count,
  COUNT(*) FILTER (WHERE is_suspicious_ip) AS suspicious_ip_count,
  COUNT(*) FILTER (WHERE has_error) AS error_count, COUNT(DISTINCT user_name) AS unique_users FROM p""")
    o["feat_risk_distribution"] = with_features(",\n" + _levels("feat", "risk_level", ["low", "medium", "high", "critical"]))
    o["feat_label_distribution"] = f"""WITH trail AS ({TRAIL}),
t AS (SELECT COUNT(*) AS total FROM trail)
SELECT is_anomaly_original AS label, COUNT(*) AS count,
  ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0 / MAX(t.total), 6) AS pct
FROM trail, t WHERE is_anomaly_original IS NOT NULL GROUP BY is_anomaly_original"""
    o["feat_top_users"] = f"""WITH trail AS ({TRAIL})
SELECT user_name, COUNT(*) AS event_count FROM trail WHERE user_name IS NOT NULL GROUP BY user_name
ORDER BY event_count DESC, user_name ASC LIMIT 5"""
    stat_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean, "
        f"ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std, ROUND(MIN(CAST({c} AS DOUBLE)), 6) AS min, "
        f"ROUND(MAX(CAST({c} AS DOUBLE)), 6) AS max FROM feat"
        for c in ["risk_score_normalized", "user_total_events", "user_error_rate",
                  "time_since_prev_event", "events_this_minute"])
    o["feat_statistics"] = with_features(stat_rows)
    # ---- named SQL
    o.update(_sql_catalog())
    o["sink_parsed_csv_all"] = o["sink_parsed_json_all"] = o["flatten_parsed"]
    o["sink_features_all"] = o["src_features_all"] = o["features_full"]
    # ---- detector operators on the rule decision
    sel = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _ML34)
    o["ml_select_features"] = with_features(f"SELECT event_id, {sel} FROM feat")
    o["ml_ground_truth"] = f"""WITH trail AS ({TRAIL})
SELECT event_id, CASE WHEN is_anomaly_original = true THEN 1 ELSE 0 END AS y FROM trail"""
    x = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _ML34)
    sc = ", ".join(
        f"ROUND(CASE WHEN STDDEV_POP({c}) OVER () > 0 THEN ({c} - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER () "
        f"ELSE 0.0 END, 6) AS {c}" for c in _ML34)
    o["ml_scale"] = with_features(f", x AS (SELECT event_id, {x} FROM feat)\nSELECT event_id, {sc} FROM x")
    o["ml_threshold_flag"] = _rule("SELECT event_id, ml_anomaly_prediction FROM rp")
    o["ml_minmax_score"] = _rule("SELECT event_id, ml_anomaly_score FROM rp")
    o["ml_severity"] = _rule("SELECT event_id, ml_severity FROM rp")
    o["ml_confusion"] = _rule(_CONFUSION)
    o["ml_metrics"] = _rule(f""", cm AS ({_CONFUSION}),
m AS (SELECT *,
  COALESCE(CAST(true_positives + true_negatives AS DOUBLE) / NULLIF(true_positives + true_negatives + false_positives + false_negatives, 0), 0.0) AS a,
  COALESCE(CAST(true_positives AS DOUBLE) / NULLIF(true_positives + false_positives, 0), 0.0) AS pr,
  COALESCE(CAST(true_positives AS DOUBLE) / NULLIF(true_positives + false_negatives, 0), 0.0) AS re FROM cm)
SELECT ROUND(a, 4) AS accuracy, ROUND(pr, 4) AS precision, ROUND(re, 4) AS recall,
  ROUND(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END, 4) AS f1_score,
  true_positives, true_negatives, false_positives, false_negatives FROM m""")
    o["ml_roc_auc"] = _rule(""",
sc AS (SELECT score_raw AS s, CAST(SUM(y) AS DOUBLE) AS pos, CAST(SUM(1 - y) AS DOUBLE) AS neg
       FROM rp WHERE score_raw IS NOT NULL GROUP BY score_raw),
cu AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS cneg FROM sc)
SELECT ROUND(CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0
  THEN SUM(pos * cneg + 0.5 * pos * neg) / (SUM(pos) * SUM(neg)) ELSE 0.0 END, 4) AS roc_auc FROM cu""")
    o["ml_severity_distribution"] = _rule(""",
flagged AS (SELECT * FROM rp WHERE ml_anomaly_prediction = 1),
""" + _levels("flagged", "ml_severity", ["critical", "high", "medium", "low"], "severity", pct=False))
    o["ml_final_summary"] = _rule(""", s AS (SELECT COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE ml_anomaly_prediction = 1) AS predicted_anomaly FROM rp)
SELECT total_events, total_events - predicted_anomaly AS predicted_normal, predicted_anomaly,
  ROUND(COALESCE(CAST(total_events - predicted_anomaly AS DOUBLE) * 100.0 / NULLIF(total_events, 0), 0.0), 6) AS normal_pct,
  ROUND(COALESCE(CAST(predicted_anomaly AS DOUBLE) * 100.0 / NULLIF(total_events, 0), 0.0), 6) AS anomaly_pct FROM s""")
    o["ml_top_risk_events"] = _rule("""SELECT user_name, event_name, source_ip, ml_anomaly_score, ml_severity FROM rp
ORDER BY ml_anomaly_score DESC NULLS LAST, event_id ASC LIMIT 5""")
    # ---- threats
    o["threat_privilege_escalation"] = f"""WITH trail AS ({TRAIL})
SELECT event_id, event_time, user_name, event_name, source_ip FROM trail
WHERE event_name IN ('CreateUser','CreateAccessKey','AttachUserPolicy','PutUserPolicy','AddUserToGroup','CreateRole')
   OR regexp_full_match(event_name, 'Attach[A-Za-z0-9_]*Policy')"""
    o["threat_log_tampering"] = f"""WITH trail AS ({TRAIL})
SELECT event_id, event_time, user_name, event_name, source_ip FROM trail
WHERE event_name IN ('StopLogging','DeleteTrail','UpdateTrail')"""
    o["threat_unusual_access"] = with_features("""SELECT event_id, event_time, user_name, source_ip,
  CASE WHEN is_business_hours = 0 THEN 1 ELSE 0 END AS off_hours,
  CASE WHEN source_ip IS NOT NULL AND source_ip <> '' AND is_internal_ip = 0 AND is_aws_internal = 0 THEN 1 ELSE 0 END AS foreign_ip
FROM feat WHERE is_business_hours = 0
   OR (source_ip IS NOT NULL AND source_ip <> '' AND is_internal_ip = 0 AND is_aws_internal = 0)""")
    o["threat_failed_attacks"] = with_features("""SELECT user_name, time_bucket(INTERVAL '10 minutes', event_time) AS window_start,
  time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes' AS window_end, COUNT(*) AS failures
FROM feat WHERE is_access_denied = 1 AND user_name IS NOT NULL AND event_time IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) >= 3""")
    o["threat_exfiltration"] = f"""WITH trail AS ({TRAIL}),
h AS (SELECT user_name, date_trunc('hour', event_time) AS hour_start, COUNT(*) AS action_count FROM trail
      WHERE event_name = 'GetObject' AND user_name IS NOT NULL AND event_time IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, AVG(action_count) OVER (PARTITION BY user_name) AS mean,
        STDDEV_SAMP(action_count) OVER (PARTITION BY user_name) AS std FROM h)
SELECT user_name, hour_start, action_count, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std FROM s
WHERE std IS NOT NULL AND action_count > mean + 3.0 * std"""
    o["threat_exfiltration_burst"] = f"""WITH trail AS ({TRAIL}),
day AS (SELECT date_trunc('day', max(event_time)) - INTERVAL 9 DAY AS burst FROM trail),
h AS (SELECT user_name, date_trunc('hour', event_time) AS hour_start,
    CAST(SUM(CASE WHEN date_trunc('hour', event_time) = burst THEN 60 ELSE 1 END) AS BIGINT) AS action_count FROM trail, day
  WHERE event_name = 'GetObject' AND user_name IS NOT NULL AND event_time IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, avg(action_count) OVER w AS mean, stddev_samp(action_count) OVER w AS std FROM h WINDOW w AS (PARTITION BY user_name))
SELECT user_name, CAST(hour_start AS TIMESTAMP) AS hour_start, action_count, round(mean, 6) AS mean, round(std, 6) AS std FROM s WHERE action_count > mean + 3 * std"""
    o["join_feed_ranges"] = f"""WITH trail AS ({TRAIL}),
v4 AS (SELECT source_ip, list_sum([CAST(p AS BIGINT) * CAST(pow(256, 4 - i) AS BIGINT) FOR p, i IN string_split(source_ip, '.')]) AS n
  FROM (SELECT DISTINCT source_ip FROM trail WHERE regexp_full_match(source_ip, '[0-9]+([.][0-9]+){{3}}'))),
feed AS (SELECT DISTINCT source_ip AS entry, 32 AS length FROM trail WHERE error_code <> ''
  UNION SELECT DISTINCT source_ip, 24 FROM trail WHERE event_name = 'CreateUser'),
spans AS (SELECT DISTINCT length, n - n % (1::BIGINT << (32 - length)) AS low, n - n % (1::BIGINT << (32 - length)) + (1::BIGINT << (32 - length)) - 1 AS high,
    CASE WHEN length = 32 THEN entry ELSE regexp_replace(entry, '[0-9]+$', '0') END || '/' || length AS network
  FROM feed JOIN v4 ON v4.source_ip = feed.entry),
hit AS (SELECT source_ip, arg_max(network, length) AS network FROM v4 JOIN spans ON n BETWEEN low AND high GROUP BY source_ip
  UNION ALL SELECT DISTINCT entry, entry FROM feed WHERE entry <> '' AND length = 32 AND entry NOT IN (SELECT source_ip FROM v4))
SELECT event_id, network AS feed_network FROM trail LEFT JOIN hit USING (source_ip)"""
    o["user_events_last_hour"] = f"""WITH trail AS ({TRAIL}),
v AS (SELECT event_id, COUNT(*) OVER (PARTITION BY user_name ORDER BY event_time
        RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n
      FROM trail WHERE user_name IS NOT NULL AND event_time IS NOT NULL)
SELECT trail.event_id, v.n AS user_events_last_hour FROM trail LEFT JOIN v ON trail.event_id = v.event_id"""
    o["ip_first_seen"] = f"""WITH trail AS ({TRAIL}),
f AS (SELECT source_ip, arg_min(event_time, (event_time, event_id)) AS t0, arg_min(event_id, (event_time, event_id)) AS id0
      FROM trail WHERE source_ip IS NOT NULL AND event_time IS NOT NULL GROUP BY source_ip)
SELECT trail.event_id, trail.source_ip, f.t0 AS ip_first_seen,
  CASE WHEN trail.event_time IS NULL OR f.t0 IS NULL THEN NULL
       WHEN trail.event_time = f.t0 AND trail.event_id = f.id0 THEN 1 ELSE 0 END AS is_first_seen
FROM trail LEFT JOIN f ON trail.source_ip = f.source_ip"""
    # ---- streaming
    o["stream_flatten"] = f"""WITH {feature_ctes()}, {parsed_ctes(include_trail=False)}
SELECT feat.event_id, date_trunc('second', feat.event_time) AS event_time, feat.hour,
  feat.is_sensitive_action, feat.is_suspicious_ip, p.risk_level AS parser_risk_level
FROM feat JOIN p ON feat.event_id = p.event_id"""
    o["stream_minute_counts"] = f"""WITH trail AS ({TRAIL}),
t AS (SELECT date_trunc('second', event_time) AS ts FROM trail WHERE event_time IS NOT NULL),
wm AS (SELECT MAX(ts) - INTERVAL 10 MINUTE AS w FROM t)
SELECT date_trunc('minute', ts) AS minute_start, COUNT(*) AS events_this_minute FROM t, wm
WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= wm.w GROUP BY 1"""
    o["stream_user_hour_counts"] = f"""WITH trail AS ({TRAIL}),
t AS (SELECT date_trunc('second', event_time) AS ts, COALESCE(user_name, 'Unknown') AS user_name
      FROM trail WHERE event_time IS NOT NULL),
wm AS (SELECT MAX(ts) - INTERVAL 10 MINUTE AS w FROM t)
SELECT date_trunc('hour', ts) AS hour_start, user_name, COUNT(*) AS user_events_this_hour FROM t, wm
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= wm.w GROUP BY 1, 2"""
    o["alerts_high_severity"] = with_parsed(
        "SELECT DISTINCT event_id, risk_level AS parser_risk_level FROM p WHERE risk_level IN ('high', 'critical')")
    o["baseline_tables"] = with_features("""SELECT event_id, user_total_events, event_type_frequency, ip_event_count
FROM feat""")
    o["sink_published"] = _published()
    o["holdout_features"] = _holdout()
    from auditlake import oracles_forest     # it builds on the feature CTEs above
    return o | oracles_stored.oracle_sql() | oracles_forest.oracle_sql()


_FEATURE_ORDER = [
    "event_id", "event_time", "event_source", "event_name", "aws_region", "user_type", "user_name", "user_arn",
    "account_id", "source_ip", "user_agent", "error_code", "error_message", "is_anomaly_original",
    "anomaly_type_original", "hour", "day_of_week", "day_of_month", "month", "minute", "is_business_hours",
    "is_weekend", "is_late_night", "time_period", "time_period_encoded", "user_total_events", "user_unique_ips",
    "user_unique_event_types", "user_error_count", "user_error_rate", "is_new_user", "user_activity_diversity",
    "is_sensitive_action", "is_recon_action", "is_data_access", "has_error", "is_access_denied",
    "service_category", "service_category_encoded", "event_type_frequency", "is_rare_event", "is_suspicious_ip",
    "is_internal_ip", "is_aws_internal", "ip_event_count", "ip_unique_users", "is_shared_ip",
    "is_suspicious_user_agent", "is_console_access", "time_since_prev_event", "is_rapid_event",
    "events_this_minute", "is_burst_activity", "user_events_this_hour", "is_unusual_user_activity", "risk_score",
    "risk_score_normalized", "risk_level", "risk_level_encoded"]
