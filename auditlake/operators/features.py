"""Per-event feature stages: time, user, event, network, temporal, risk.

Each stage is a `DataFrame -> DataFrame` transform adding the reference's
columns. Row-local rules are native expressions; whole-table counts come from
one shared `EventStats` (see event_stats.py) joined back with size-checked
lookups; the global gap uses `gap_lookup` / `time_since_previous` below. The
single-stage functions serve per-feature queries; the full plan
(plans/features.py) attaches all lookups at once and then applies
`add_lookup_rules`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.functions import lists as L
from auditlake.operators.event_stats import EventStats, hour_key, minute_key
from auditlake.operators.lookup import attach, materialize
from auditlake.operators.ordered import lag_over_unique, range_cuts

ROW_ID = "_rid"


# plan nodes under which every branch that reads the rows again sees them in the same places
SCAN_NODES = {"Project", "Filter", "LogicalRelation", "Relation", "DataSourceV2ScanRelation", "LocalRelation",
              "SubqueryAlias", "View"}


def is_scan(df: DataFrame) -> bool:
    """Whether `df` is a deterministic projection or filter of stored rows."""
    def plain(node) -> bool:
        children = node.children()
        # a file relation's name carries its format
        return node.nodeName().split(" ")[0] in SCAN_NODES and all(plain(children.apply(i)) for i in range(children.size()))
    plan = df._jdf.queryExecution().optimizedPlan()
    return bool(plan.deterministic()) and plain(plan)


def with_row_id(df: DataFrame) -> DataFrame:
    """Stable per-row id. Rows straight from a scan get it in the scan, which every
    branch repeats alike. Rows that come out of a shuffle (de-duplicated logs,
    joins) may be dealt differently each time they are computed, so they are
    written once with their id; the branches read that table."""
    numbered = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    return numbered if is_scan(df) else materialize(numbered, "rows")[0]


def spread_narrow_input(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Round-robin the rows over the cluster's parallelism when the scan came
    out in fewer than `min_share` of it (one small file, one row group). A large
    input is already split by the scan and is returned untouched, so this never
    adds a shuffle of a big table. Call it after `with_row_id`."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < max(1, int(target * min_share)):
        return df.repartition(target)
    return df


# --------------------------------------------------------------------- time
def add_time_features(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    t = F.col(time_col)
    hour, dow = F.hour(t), F.weekday(t)
    period = C.time_period(hour)
    return df.withColumns({
        "hour": hour,
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(t),
        "month": F.month(t),
        "minute": F.minute(t),
        "is_business_hours": C.flag(C.is_business_hours(hour)),
        "is_weekend": C.flag(C.is_weekend(dow)),
        "is_late_night": C.flag(C.is_late_night(hour)),
        "time_period": period,
        "time_period_encoded": C.time_period_code(period),
    })


# --------------------------------------------------------------------- user
def add_user_features(df: DataFrame, stats: EventStats,
                      semantics: str = C.ERROR_PRESENT) -> DataFrame:
    lk, bound = stats.users(semantics)
    out = attach(df, lk, bound, ["user_name"])
    total = F.col("user_total_events")
    return out.withColumns({
        "user_error_rate": F.col("user_error_count") / total,
        "is_new_user": C.flag(total < L.NEW_USER_BELOW),
        "user_activity_diversity": F.col("user_unique_event_types") / total,
    })


# -------------------------------------------------------------------- event
def add_event_flags(df: DataFrame, semantics: str = C.ERROR_PRESENT) -> DataFrame:
    category = C.service_category("event_source")
    return df.withColumns({
        "is_sensitive_action": C.flag(C.in_list("event_name", L.FEATURE_SENSITIVE_ACTIONS)),
        "is_recon_action": C.flag(C.in_list("event_name", L.RECON_ACTIONS)),
        "is_data_access": C.flag(C.in_list("event_name", L.DATA_ACCESS_ACTIONS)),
        "has_error": C.flag(C.has_error("error_code", semantics)),
        "is_access_denied": C.flag(C.is_access_denied("error_code")),
        "service_category": category,
        "service_category_encoded": C.service_category_code(category),
    })


def add_event_features(df: DataFrame, stats: EventStats,
                       semantics: str = C.ERROR_PRESENT) -> DataFrame:
    out = add_event_flags(df, semantics)
    lk, bound = stats.event_names()
    out = attach(out, lk, bound, ["event_name"])
    return out.withColumn("is_rare_event", C.flag(F.col("event_type_frequency") < L.RARE_EVENT_BELOW))


# ------------------------------------------------------------------ network
def add_network_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_suspicious_ip": C.flag(C.in_list("source_ip", L.SUSPICIOUS_IPS)),
        "is_internal_ip": C.flag(C.is_internal_ip("source_ip")),
        "is_aws_internal": C.flag(C.is_aws_internal("source_ip")),
    })


def add_agent_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_suspicious_user_agent": C.flag(C.is_suspicious_user_agent("user_agent")),
        "is_console_access": C.flag(C.is_console_access("user_agent")),
    })


def row_features(df: DataFrame, semantics: str = C.ERROR_PRESENT) -> DataFrame:
    """Every feature that needs only its own row."""
    return add_agent_flags(add_network_flags(add_event_flags(add_time_features(df), semantics)))


def add_network_features(df: DataFrame, stats: EventStats) -> DataFrame:
    out = add_network_flags(df)
    lk, bound = stats.ips()
    out = attach(out, lk, bound, ["source_ip"])
    return add_agent_flags(out.withColumn("is_shared_ip", C.flag(F.col("ip_unique_users") > 1)))


# ----------------------------------------------------------------- temporal
def gap_lookup(df: DataFrame, time_col: str = "event_time", tiebreak: list[str] | None = None,
               rows_bound: int | None = None) -> tuple[DataFrame, int, list[str]]:
    """The per-time gap table of `time_since_previous`, keyed like the events:
    (time_col, *tiebreak) -> `_gap`; only the first row of each time matches.

    Within a group of equal times only the first row can have a non-zero gap,
    so the ordered work runs on distinct times only: a partial aggregate keeps
    one row per time (with the first tie-break), and a range-bucketed lag runs
    over those unique times. `rows_bound` (rows with a time; exact when it
    comes from the stats job) bounds the table for the broadcast decision.
    """
    tiebreak = tiebreak or ["event_id"]
    timed = df.where(F.col(time_col).isNotNull())
    if rows_bound is None:
        rows_bound = timed.count()
    cuts = range_cuts(timed, time_col, rows=rows_bound)
    keyed = timed.select(F.col(time_col).alias("_t"),
                         F.struct(*[F.col(c) for c in tiebreak]).alias("_tb"))
    firsts = keyed.groupBy("_t").agg(F.min("_tb").alias("_first"))
    chained = lag_over_unique(firsts, "_t", out="_tprev", cuts=cuts)
    gaps = chained.select(
        F.col("_t").alias(time_col), *[F.col(f"_first.{c}").alias(c) for c in tiebreak],
        F.coalesce(C.seconds_between("_t", "_tprev"), F.lit(0.0)).alias("_gap"))
    return gaps, rows_bound, [time_col, *tiebreak]


def time_since_previous(df: DataFrame, time_col: str = "event_time",
                        tiebreak: list[str] | None = None,
                        out: str = "time_since_prev_event",
                        rows_bound: int | None = None) -> DataFrame:
    """Seconds since the previous event of the whole table, in order
    (time ASC, tiebreak ASC); first row and rows without a time get 0.

    The per-time answer (`gap_lookup`) joins back on the (time, tie-break) key,
    which is unique per event, so the join is even however hot a time is.
    """
    gaps, bound, keys = gap_lookup(df, time_col, tiebreak, rows_bound)
    joined = attach(df, gaps, bound, keys, null_safe=tuple(keys[1:]))
    return joined.withColumn(out, F.coalesce(F.col("_gap"), F.lit(0.0))).drop("_gap")


def add_temporal_features(df: DataFrame, stats: EventStats, time_col: str = "event_time",
                          tiebreak: list[str] | None = None) -> DataFrame:
    out = time_since_previous(df, time_col, tiebreak, rows_bound=stats.timed_rows)
    gap = F.col("time_since_prev_event")
    out = out.withColumns({"is_rapid_event": C.flag((gap > 0) & (gap < 1)),
                           "_minute": minute_key(time_col), "_hour": hour_key(time_col)})
    lk, bound = stats.minutes()
    out = attach(out, lk, bound, ["_minute"])
    lk, bound = stats.user_hours()
    out = attach(out, lk, bound, ["_hour", "user_name"], null_safe=("_hour",))
    return out.withColumns({
        "is_burst_activity": C.flag(F.col("events_this_minute") > L.BURST_ABOVE),
        "is_unusual_user_activity": C.flag(F.col("user_events_this_hour") > L.UNUSUAL_USER_HOUR_ABOVE),
    }).drop("_minute", "_hour")


def add_lookup_rules(df: DataFrame) -> DataFrame:
    """Rules over the looked-up counts (after `attach_many` in the full plan)."""
    total = F.col("user_total_events")
    gap = F.coalesce(F.col("_gap"), F.lit(0.0))
    share = lambda c: F.when(total > 0, F.col(c) / total).when(total == 0, 0.0)
    return df.withColumns({
        "user_error_rate": share("user_error_count"),
        "is_new_user": C.flag(total < L.NEW_USER_BELOW),
        "user_activity_diversity": share("user_unique_event_types"),
        "is_rare_event": C.flag(F.col("event_type_frequency") < L.RARE_EVENT_BELOW),
        "is_shared_ip": C.flag(F.col("ip_unique_users") > 1),
        "is_suspicious_user_agent": C.flag(C.is_suspicious_user_agent("user_agent")),
        "is_console_access": C.flag(C.is_console_access("user_agent")),
        "time_since_prev_event": gap,
        "is_rapid_event": C.flag((gap > 0) & (gap < 1)),
        "is_burst_activity": C.flag(F.col("events_this_minute") > L.BURST_ABOVE),
        "is_unusual_user_activity": C.flag(F.col("user_events_this_hour") > L.UNUSUAL_USER_HOUR_ABOVE),
    }).drop("_gap", "_minute", "_hour")


# --------------------------------------------------------------------- risk
def risk_score_expr():
    total = None
    for col, w in L.RISK_WEIGHTS:
        term = F.col(col) * F.lit(w)
        total = term if total is None else total + term
    return total


def add_risk(df: DataFrame) -> DataFrame:
    score = risk_score_expr().cast("int")
    norm = F.round(score / F.lit(float(L.RISK_MAX_SCORE)) * 100, 2)
    level = C.risk_level_from_normalized(norm)
    return df.withColumns({
        "risk_score": score,
        "risk_score_normalized": norm,
        "risk_level": level,
        "risk_level_encoded": C.level_code(level, L.RISK_LEVEL_CODES),
    })
