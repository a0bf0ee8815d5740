"""Threat rules described for the dashboard (D1-D7), as batch Spark jobs.

The rules work on the feature table (or the flat table where noted). Group
work is partial-aggregated before any shuffle; the per-user rolling count is a
difference of running counts over (user, time range) partitions whose ranges
follow the data, so no user or hour can gather in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.functions import lists as L
from auditlake.operators.lookup import attach, materialize
from auditlake.operators.ordered import with_range_bucket

HOUR_US = 3_600_000_000


def _event_rows(df: DataFrame, cond) -> DataFrame:
    return df.where(cond).select("event_id", C.ntz("event_time").alias("event_time"),
                                 "user_name", "event_name", "source_ip")


def privilege_escalation(df: DataFrame) -> DataFrame:
    """Identity changes that grant or create access."""
    grants = C.in_list("event_name", L.PRIVILEGE_ESCALATION_ACTIONS) | F.col("event_name").rlike(L.ATTACH_POLICY)
    return _event_rows(df, grants)


def log_tampering(df: DataFrame) -> DataFrame:
    """Attempts to stop or change audit logging."""
    return _event_rows(df, C.in_list("event_name", L.LOG_TAMPERING_ACTIONS))


def unusual_access(features: DataFrame) -> DataFrame:
    """Off-hours activity, or a present address that is neither private
    nor a cloud-internal name."""
    off = F.col("is_business_hours") == 0
    ip = F.col("source_ip")
    foreign = (ip.isNotNull() & (ip != F.lit("")) & (F.col("is_internal_ip") == 0)
               & (F.col("is_aws_internal") == 0))
    return (features.where(off | foreign)
            .select("event_id", C.ntz("event_time").alias("event_time"), "user_name", "source_ip",
                    C.flag(off).alias("off_hours"), C.flag(foreign).alias("foreign_ip")))


def failed_attacks(features: DataFrame, window: str = "10 minutes", min_failures: int = 3) -> DataFrame:
    """D3: users with at least `min_failures` denied calls in one tumbling window."""
    denied = features.where((F.col("is_access_denied") == 1) & F.col("user_name").isNotNull()
                            & F.col("event_time").isNotNull())
    g = denied.groupBy("user_name", F.window("event_time", window).alias("w")).agg(
        F.count(F.lit(1)).alias("failures"))
    return (g.where(F.col("failures") >= min_failures)
            .select("user_name", C.ntz("w.start").alias("window_start"),
                    C.ntz("w.end").alias("window_end"), "failures"))


def exfiltration(df: DataFrame, action: str = "GetObject", k: float = 3.0) -> DataFrame:
    """Hours in which a user's `action` count exceeds that user's hourly
    mean + k * sample std (over the hours with at least one such call)."""
    hourly = (df.where((F.col("event_name") == action) & F.col("user_name").isNotNull()
                       & F.col("event_time").isNotNull())
              .groupBy("user_name", F.date_trunc("hour", "event_time").alias("hour_start"))
              .agg(F.count(F.lit(1)).alias("action_count")))
    # one row per (user, hour): a user's partition is bounded by the hours spanned
    per_user = Window.partitionBy("user_name")
    stats = (hourly.withColumn("mean", F.avg("action_count").over(per_user))
             .withColumn("std", F.stddev_samp("action_count").over(per_user)))
    return (stats.where(F.col("std").isNotNull()
                        & (F.col("action_count") > F.col("mean") + F.lit(k) * F.col("std")))
            .select("user_name", C.ntz("hour_start").alias("hour_start"), "action_count",
                    F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")))


def user_events_last_hour(df: DataFrame) -> DataFrame:
    """Events of the same user in the closed hour [t - 1h, t] (ties included).

    count(u, t) = P(u, t) - P(u, < t - 1h), P being the user's running count.
    Equal (user, time) pairs first collapse into one weighted key (a partial
    aggregate). Every key also emits a probe at t - 1h. Keys and probes are cut
    into (user, time range) partitions whose ranges come from quantiles of all
    key and probe times, so a user holding a third of the rows, even within one
    hour, is spread over many ranges. A range-local running sum plus the user's
    total in earlier ranges (one row per user and range) gives P at every key
    and probe; probes meet their key on the unique (user, time) pair, and the
    per-key count joins back onto the events. Null user or time -> null.
    """
    base = df.select("event_id", "user_name", F.unix_micros("event_time").alias("_us"))
    keys = (base.where(F.col("user_name").isNotNull() & F.col("_us").isNotNull())
            .groupBy("user_name", "_us").agg(F.count(F.lit(1)).alias("_w")))
    keys, _ = materialize(keys, "user-times")          # read by the cuts, the ranges, keys and probes
    points = keys.select("user_name", "_us", F.col("_us").alias("_t0"), "_w", F.lit(True).alias("_key")) \
        .unionByName(keys.select("user_name", (F.col("_us") - F.lit(HOUR_US)).alias("_us"),
                                 F.col("_us").alias("_t0"), F.lit(0).cast("bigint").alias("_w"),
                                 F.lit(False).alias("_key")))
    points = with_range_bucket(points, "_us")
    w = Window.partitionBy("user_name", "_bkt").orderBy("_us")
    upto = w.rangeBetween(Window.unboundedPreceding, 0)          # t_e <= t
    before = w.rangeBetween(Window.unboundedPreceding, -1)       # t_e <  t
    local = points.withColumn("_loc", F.when(F.col("_key"), F.sum("_w").over(upto))
                                       .otherwise(F.coalesce(F.sum("_w").over(before), F.lit(0))))
    per_range = (points.groupBy("user_name", "_bkt").agg(F.sum("_w").alias("_n"))
                 .withColumn("_off", F.coalesce(F.sum("_n").over(
                     Window.partitionBy("user_name").orderBy("_bkt")
                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                 .select("user_name", "_bkt", "_off"))
    prefix = local.join(per_range, ["user_name", "_bkt"], "left").withColumn(
        "_p", F.col("_loc") + F.col("_off"))
    now = prefix.where("_key").select("user_name", "_t0", F.col("_p").alias("_p_now"))
    then = prefix.where(~F.col("_key")).select("user_name", "_t0", F.col("_p").alias("_p_before"))
    per_key = now.join(then, ["user_name", "_t0"]).select(
        "user_name", F.col("_t0").alias("_us"),
        (F.col("_p_now") - F.col("_p_before")).cast("bigint").alias("user_events_last_hour"))
    # per_key has unique (user, time) keys; hot keys on the event side are split by AQE
    out = base.join(per_key, ["user_name", "_us"], "left")
    return out.select("event_id", "user_events_last_hour")


def ip_first_seen(df: DataFrame) -> DataFrame:
    """First time each address appears, and whether this event is it
    (order: time, then event id). Null address or time -> null."""
    firsts = (df.where(F.col("source_ip").isNotNull() & F.col("event_time").isNotNull())
              .groupBy("source_ip")
              .agg(F.min(F.struct("event_time", "event_id")).alias("_f")))
    lookup, m = materialize(firsts.select("source_ip", F.col("_f.event_time").alias("ip_first_seen"),
                                          F.col("_f.event_id").alias("_first_id")),
                            "ip_first", rows=F.count(F.lit(1)))
    out = attach(df.select("event_id", "source_ip", "event_time"), lookup, int(m["rows"] or 0),
                 ["source_ip"])
    first = F.when(F.col("event_time").isNull() | F.col("ip_first_seen").isNull(), F.lit(None)) \
        .otherwise(C.flag((F.col("event_time") == F.col("ip_first_seen"))
                          & (F.col("event_id") == F.col("_first_id"))))
    return out.select("event_id", "source_ip", C.ntz("ip_first_seen").alias("ip_first_seen"),
                      first.cast("int").alias("is_first_seen"))
