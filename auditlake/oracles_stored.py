"""DuckDB SQL of the queries in `plans/stored.py`.

`zone` states what flattening must give for the trail's raw documents, whose keys are missing,
null or empty by rules on the event id.
"""

from __future__ import annotations

from auditlake.sources.fixture import FIXTURE_SQL
from auditlake.sources.variant import KEYS

ZONE = f"""trail AS ({FIXTURE_SQL.format(events="events")}),
keyed AS (SELECT *, CAST(event_id AS BIGINT) AS k, CAST(event_id AS BIGINT) % 89 IN (0, 1) AS nobody,
    CAST(event_id AS BIGINT) % 613 IN (7, 8) AS timeless FROM trail),
zone AS (SELECT k, event_id,
    CASE WHEN NOT timeless THEN date_trunc('second', event_time) END AS event_time,
    CASE WHEN k % 401 = 3 THEN '' ELSE event_source END AS event_source, event_name, aws_region,
    CASE WHEN nobody THEN '' ELSE user_type END AS user_type,
    CASE WHEN nobody OR (user_name IS NULL AND k % 2 = 0) THEN 'Unknown' ELSE user_name END AS user_name,
    CASE WHEN nobody THEN '' ELSE user_arn END AS user_arn, CASE WHEN nobody THEN '' ELSE account_id END AS account_id,
    CASE WHEN source_ip IS NULL AND k % 2 = 0 THEN '' ELSE source_ip END AS source_ip,
    CASE WHEN user_agent IS NULL AND k % 4 = 0 THEN '' ELSE user_agent END AS user_agent,
    CASE WHEN error_code IS NULL AND k % 3 = 0 THEN '' ELSE error_code END AS error_code,
    CASE WHEN error_message IS NULL AND k % 5 = 0 THEN '' ELSE error_message END AS error_message,
    is_anomaly_original, anomaly_type_original FROM keyed),
cut AS (SELECT CAST(make_timestamp(1000000 * (min(t) + (max(t) - min(t)) // 2)) AS DATE) AS day
  FROM (SELECT CAST(floor(epoch(event_time)) AS BIGINT) AS t FROM trail)),
parted AS (SELECT z.*, (CAST(t.event_time AS DATE) <= cut.day OR t.timeless) AS early
  FROM zone z JOIN keyed t USING (event_id), cut)"""


def _with(select: str) -> str:
    return f"WITH {ZONE}\n{select}"


def _state(name: str, path: str) -> str:
    """Counts of a key's states by the rules of the raw documents."""
    column, k = name, "k"
    missing = {"event_time": "k % 613 = 7", "event_source": "k % 401 = 3", "source_ip": "source_ip IS NULL AND k % 2 = 0",
               "user_agent": "user_agent IS NULL AND k % 4 = 0", "error_code": "error_code IS NULL AND k % 3 = 0",
               "error_message": "error_message IS NULL AND k % 5 = 0", "user_type": "nobody", "user_arn": "nobody", "account_id": "nobody",
               "user_name": "nobody OR (user_name IS NULL AND k % 2 = 0)",
               "anomaly_type_original": "anomaly_type_original IS NULL AND k % 5 = 0"}.get(name, "false")
    value = f"CAST({column} AS VARCHAR)"
    state = f"CASE WHEN {missing} THEN 'missing' WHEN {column} IS NULL THEN 'null' WHEN {value} = '' THEN 'empty' ELSE 'filled' END"
    return f"SELECT '{path}' AS key, {state} AS state FROM keyed"


def _key_states() -> str:
    extra = [("$.userIdentity", "CASE k % 89 WHEN 0 THEN 'missing' WHEN 1 THEN 'null' ELSE 'filled' END"),
             ("$.requestParameters.n", "CASE WHEN k % 7 = 0 THEN 'filled' ELSE 'missing' END"),
             ("$.requestParameters.braces", "CASE WHEN k % 7 = 0 THEN 'filled' ELSE 'missing' END"),
             ("$.additionalEventData", "CASE WHEN k % 11 = 0 THEN 'null' ELSE 'missing' END")]
    parts = [_state(name, path) for name, path, _ in KEYS] + [f"SELECT '{p}' AS key, {s} AS state FROM keyed" for p, s in extra]
    counts = ", ".join(f"count(*) FILTER (state = '{s}') AS {s}_events" for s in ("missing", "null", "empty", "filled"))
    return _with(f"SELECT key, {counts} FROM ({' UNION ALL '.join(parts)}) GROUP BY key")


_USERS = """SELECT user_name, count(*) AS user_total_events, count(DISTINCT source_ip) AS user_unique_ips,
  count(DISTINCT event_name) AS user_unique_event_types"""
_IPS = "SELECT source_ip, count(*) AS ip_event_count, count(DISTINCT user_name) AS ip_unique_users"


def _versions(column: str) -> str:
    """Counts per key in both versions: the first holds the early events, the second all."""
    return f"""SELECT {column} AS key, 1 AS version, count(*) AS n FROM parted WHERE early AND {column} IS NOT NULL GROUP BY 1
  UNION ALL SELECT {column}, 2, count(*) FROM parted WHERE {column} IS NOT NULL GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    flat = ", ".join(name for name, _, _ in KEYS)
    wrong = "(error_code IS DISTINCT FROM '')"
    o = {"flatten_events_missing_keys": _with(f"SELECT {flat} FROM zone"),
         "raw_zone_key_states": _key_states(),
         "event_has_error_missing_keys": _with(f"SELECT event_id, CAST({wrong} AS INTEGER) AS has_error FROM zone")}
    o["user_error_count_missing_keys"] = _with(f"""SELECT event_id, CASE WHEN user_name IS NOT NULL THEN errors END AS user_error_count,
  CASE WHEN user_name IS NOT NULL THEN CAST(errors AS DOUBLE) / events END AS user_error_rate
FROM (SELECT event_id, user_name, count(*) FILTER ({wrong}) OVER w AS errors, count(*) OVER w AS events
  FROM zone WINDOW w AS (PARTITION BY user_name))""")
    o["baselines_merged_days"] = _with(f"""{_USERS}, count(*) FILTER ({wrong}) AS user_error_count
FROM zone WHERE user_name IS NOT NULL GROUP BY user_name""")
    o["baselines_merged_addresses"] = _with(f"{_IPS} FROM zone WHERE source_ip IS NOT NULL GROUP BY source_ip")
    o["baselines_approximate"] = _with(f"""SELECT 'user' AS kind, user_name AS key, user_total_events AS events, user_unique_ips AS others,
  true AS within_error FROM ({_USERS} FROM zone WHERE user_name IS NOT NULL GROUP BY user_name)
UNION ALL SELECT 'ip', source_ip, ip_event_count, ip_unique_users, true
FROM ({_IPS} FROM zone WHERE source_ip IS NOT NULL GROUP BY source_ip)""")
    o["baselines_last_week"] = _with(f"""{_USERS} FROM zone WHERE user_name IS NOT NULL AND CAST(event_time AS DATE) IN
  (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM zone WHERE event_time IS NOT NULL ORDER BY d DESC LIMIT 7) GROUP BY user_name""")
    o["baselines_stream_restart"] = _with(f"""SELECT event_id, CAST(CASE WHEN early THEN 1 ELSE 2 END AS BIGINT) AS baseline_version,
  u.n AS user_total_events, e.n AS event_type_frequency, i.n AS ip_event_count
FROM parted p
LEFT JOIN ({_versions("user_name")}) u ON u.key = p.user_name AND u.version = CASE WHEN early THEN 1 ELSE 2 END
LEFT JOIN ({_versions("event_name")}) e ON e.key = p.event_name AND e.version = CASE WHEN early THEN 1 ELSE 2 END
LEFT JOIN ({_versions("source_ip")}) i ON i.key = p.source_ip AND i.version = CASE WHEN early THEN 1 ELSE 2 END""")
    o["stream_minute_counts_closed"] = _with("""SELECT date_trunc('minute', event_time) AS minute_start, count(*) AS events_this_minute
FROM zone WHERE event_time IS NOT NULL GROUP BY 1""")
    o["stream_user_hour_counts_closed"] = _with("""SELECT date_trunc('hour', event_time) AS hour_start, user_name,
  count(*) AS user_events_this_hour FROM zone WHERE event_time IS NOT NULL GROUP BY 1, 2""")
    o["stream_late_rows"] = _with("""SELECT event_id, event_time, date_trunc('minute', event_time) AS window_start
FROM zone, (SELECT max(event_time) AS high FROM zone WHERE k % 10 <> 0)
WHERE k % 10 = 0 AND date_trunc('minute', event_time) + INTERVAL 1 MINUTE <= high - INTERVAL 10 MINUTE""")
    return o
