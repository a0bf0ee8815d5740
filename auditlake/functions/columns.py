"""Column expressions for the per-event rules.

Everything here is a native Catalyst expression (no Python UDF), so it stays
inside whole-stage codegen next to the scan. Null handling follows the
reference's observable behaviour: a flag over a missing value is 0, never null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlake.functions import lists as L

ERROR_PRESENT = "present"      # error iff error_code is non-null and non-empty
ERROR_REFERENCE = "reference"  # error iff error_code IS DISTINCT FROM '' (null counts)
ERROR_SEMANTICS = (ERROR_PRESENT, ERROR_REFERENCE)

# FIXED VALUES — audit-log time text. Written zero-padded; parsed like
# `%Y-%m-%dT%H:%M:%SZ`, which also accepts one-digit month, day and time fields.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_SECONDS_PARSE = "yyyy-M-d'T'H:m:s'Z'"


def flag(cond: Column) -> Column:
    """1 when the condition is true, else 0 (null counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- time
def parse_event_time(text) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ` text (fields may be unpadded) to TIMESTAMP;
    anything else (other layouts, fractions, impossible dates) null."""
    return F.try_to_timestamp(col_or(text), F.lit(ISO_SECONDS_PARSE))


def time_period(hour) -> Column:
    h = col_or(hour)
    expr = None
    for lo, hi, name, _ in L.TIME_PERIODS:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(L.TIME_PERIOD_OTHER[0])


def time_period_code(period) -> Column:
    p = col_or(period)
    expr = None
    for _, _, name, code in L.TIME_PERIODS:
        expr = F.when(p == name, code) if expr is None else expr.when(p == name, code)
    return expr.when(p == L.TIME_PERIOD_OTHER[0], L.TIME_PERIOD_OTHER[1])


def is_business_hours(hour) -> Column:
    lo, hi = L.BUSINESS_HOURS
    return col_or(hour).between(lo, hi)


def is_late_night(hour) -> Column:
    lo, hi = L.LATE_NIGHT_HOURS
    return col_or(hour).between(lo, hi)


def is_weekend(day_of_week) -> Column:
    return col_or(day_of_week) >= 5


# ------------------------------------------------------------------- errors
def has_error(error_code, semantics: str = ERROR_PRESENT) -> Column:
    """Boolean error test under the chosen semantics (see README)."""
    e = col_or(error_code)
    if semantics == ERROR_PRESENT:
        return F.coalesce(e != F.lit(""), F.lit(False))
    if semantics == ERROR_REFERENCE:
        return ~e.eqNullSafe(F.lit(""))
    raise ValueError(f"error semantics must be one of {ERROR_SEMANTICS}")


def is_access_denied(error_code) -> Column:
    e = col_or(error_code)
    return F.coalesce(e.contains("AccessDenied") | e.contains("Unauthorized"), F.lit(False))


# ----------------------------------------------------------------- services
def service_category(source) -> Column:
    s = F.lower(col_or(source))
    expr = None
    for token, name, _ in L.SERVICE_CATEGORIES:
        cond = s.contains(token)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(L.SERVICE_OTHER[0])


def service_category_code(category) -> Column:
    c = col_or(category)
    expr = None
    for _, name, code in L.SERVICE_CATEGORIES:
        expr = F.when(c == name, code) if expr is None else expr.when(c == name, code)
    return expr.when(c == L.SERVICE_OTHER[0], L.SERVICE_OTHER[1])


# ------------------------------------------------------------------ network
def is_internal_ip(ip) -> Column:
    """RFC1918-style prefixes; second octet of 172.* parsed leniently."""
    a = col_or(ip)
    second = F.get(F.split(a, r"\."), 1).try_cast("int")
    internal = (a.startswith("192.168.") | a.startswith("10.")
                | (a.startswith("172.") & F.coalesce(second.between(16, 31), F.lit(False))))
    return F.coalesce(internal, F.lit(False))


def is_aws_internal(ip) -> Column:
    a = col_or(ip)
    return F.coalesce(a.contains("amazonaws.com") | a.contains("aws.internal"), F.lit(False))


def is_suspicious_user_agent(agent) -> Column:
    low = F.lower(col_or(agent))
    hit = reduce(lambda x, y: x | y, [low.contains(t) for t in L.SUSPICIOUS_USER_AGENT_TOKENS])
    return F.coalesce(hit, F.lit(False))


def is_console_access(agent) -> Column:
    return F.coalesce(F.lower(col_or(agent)).contains("console"), F.lit(False))


def in_list(c, values) -> Column:
    return F.coalesce(col_or(c).isin(list(values)), F.lit(False))


# --------------------------------------------------------------------- risk
def risk_level_from_normalized(norm) -> Column:
    n = col_or(norm)
    expr = None
    for lo, name in L.RISK_LEVELS:
        expr = F.when(n >= lo, name) if expr is None else expr.when(n >= lo, name)
    return expr.otherwise("low")


def level_code(level, codes: dict) -> Column:
    c = col_or(level)
    expr = None
    for name, code in codes.items():
        expr = F.when(c == name, code) if expr is None else expr.when(c == name, code)
    return expr


def severity(score) -> Column:
    s = col_or(score)
    expr = None
    for lo, name in L.SEVERITY_LEVELS:
        expr = F.when(s >= lo, name) if expr is None else expr.when(s >= lo, name)
    return expr.otherwise("low")


def seconds_between(later, earlier) -> Column:
    """Exact difference in seconds (microsecond resolution) as DOUBLE."""
    return (F.unix_micros(col_or(later)) - F.unix_micros(col_or(earlier))) / F.lit(1_000_000.0)


def ntz(c) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (wall clock in the UTC session)."""
    return col_or(c).cast("timestamp_ntz")
