"""Run summaries of the parser, the feature table and the detector.

Every summary is one aggregate pass (partial aggregation map-side) over the
input; only the tiny aggregated result — a handful of rows, bounded by the
number of levels or by the requested top-k — is ordered or windowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlake.functions import lists as L


def _pct(count_col: str, total_col: str):
    return F.round(F.coalesce(F.try_divide(F.col(count_col) * F.lit(100.0), F.col(total_col)),
                              F.lit(0.0)), 6)


def level_distribution(df: DataFrame, level_col: str, order: list[str],
                       out_col: str | None = None) -> DataFrame:
    """Count and percent per level in a fixed order; absent levels count 0.

    One aggregate pass (a conditional count per level plus the total), then
    the single result row is unpivoted; the percent is over all rows (levels
    outside `order` included)."""
    out_col = out_col or level_col
    lv = F.col(level_col)
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(lv == F.lit(v)).alias(f"_c{i}") for i, v in enumerate(order)])
    pairs = ", ".join(f"{i}, '{v}', _c{i}" for i, v in enumerate(order))
    rows = one.selectExpr("_total", f"stack({len(order)}, {pairs}) AS (_ord, `{out_col}`, `count`)")
    return (rows.select(out_col, F.col("count").cast("bigint").alias("count"),
                        _pct("count", "_total").alias("pct"), "_ord")
            .orderBy("_ord").drop("_ord"))


# ------------------------------------------------------------------ parser
def parse_anomaly_distribution(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count_if(F.col("is_anomaly") == F.lit(False)).alias("normal_count"),
        F.count_if(F.col("is_anomaly") == F.lit(True)).alias("anomaly_count"))


def parse_top_event_types(parsed: DataFrame, k: int = 10) -> DataFrame:
    return (parsed.groupBy("event_name").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count"), F.asc_nulls_first("event_name")).limit(k))


def parse_events_per_user(parsed: DataFrame) -> DataFrame:
    return (parsed.groupBy("user_name").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.asc_nulls_first("user_name")))


def parse_totals(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("is_sensitive_action").alias("sensitive_count"),
        F.count_if("is_suspicious_ip").alias("suspicious_ip_count"),
        F.count_if("has_error").alias("error_count"),
        F.countDistinct("user_name").alias("unique_users"))


# ---------------------------------------------------------------- features
def feature_summary(features: DataFrame) -> DataFrame:
    """One row: the content of the feature-run summary document."""
    lv = F.col("risk_level")
    return features.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.lit(len(features.columns)).alias("total_features"),
        F.lit(",".join(features.columns)).alias("features"),
        *[F.count_if(lv == F.lit(level)).alias(f"risk_{level}") for level in L.RISK_LEVEL_ORDER],
        F.countDistinct("user_name").alias("unique_users"),
        F.countDistinct("source_ip").alias("unique_ips"),
        F.min("event_time").cast("timestamp_ntz").alias("date_start"),
        F.max("event_time").cast("timestamp_ntz").alias("date_end"),
        F.sum("is_sensitive_action").cast("bigint").alias("sensitive_action_count"),
        F.sum("is_suspicious_ip").cast("bigint").alias("suspicious_ip_count"),
        F.sum("has_error").cast("bigint").alias("error_count"),
    )


def label_distribution(features: DataFrame) -> DataFrame:
    """Count and percent (of all rows) per non-null original label."""
    counts = features.groupBy(F.col("is_anomaly_original").alias("label")).agg(
        F.count(F.lit(1)).alias("count"))
    counts = counts.withColumn("_total", F.sum("count").over(Window.partitionBy()))
    return (counts.where(F.col("label").isNotNull())
            .select("label", "count", _pct("count", "_total").alias("pct")))


def top_users(features: DataFrame, k: int = 5) -> DataFrame:
    return (features.where(F.col("user_name").isNotNull())
            .groupBy("user_name").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count"), F.asc("user_name")).limit(k))


STAT_COLUMNS = ["risk_score_normalized", "user_total_events", "user_error_rate",
                "time_since_prev_event", "events_this_minute"]


def feature_statistics(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mean, sample std, min, max per column (nulls skipped), one row per column."""
    cols = [c for c in (cols or STAT_COLUMNS) if c in features.columns]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"n{i}"), F.max(x).alias(f"x{i}")]
    one = features.agg(*aggs)
    stack = ", ".join(f"'{c}', a{i}, s{i}, n{i}, x{i}" for i, c in enumerate(cols))
    rows = one.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, mean, std, min, max)")
    return rows.select("feature", *[F.round(c, 6).alias(c) for c in ["mean", "std", "min", "max"]])
