"""Named reports over the feature table `security_events`.

Each report is a DataFrame plan of its own that reads only the columns it needs, so
filters and projections reach the scan and `orderBy().limit()` plans as a top-k;
every limit has a unique tie-break. The same report exists as Spark SQL text in pipe
syntax (`get_query`), to be run on the stored table (`store_events`). Report
names and output columns are fixed by the catalogue.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE = "security_events"
TOP, LISTED = 10, 50


def total_events(e: DataFrame) -> DataFrame:
    return e.agg(F.count(F.lit(1)).alias("total_events"))


def risk_distribution(e: DataFrame) -> DataFrame:
    return e.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))


def top_users(e: DataFrame) -> DataFrame:
    per_user = e.groupBy("user_name").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("is_sensitive_action").alias("sensitive_actions"),
        F.sum("has_error").alias("errors"), F.round(F.avg("risk_score_normalized"), 2).alias("avg_risk_score"))
    return per_user.orderBy(F.desc("event_count"), F.asc_nulls_first("user_name")).limit(TOP)


def high_risk_events(e: DataFrame) -> DataFrame:
    risky = e.where(F.col("risk_level").isin("high", "critical"))
    return (risky.orderBy(F.desc("risk_score_normalized"), F.asc("event_id")).limit(LISTED)
            .select("user_name", "source_ip", "event_name", "event_time", "risk_level", "risk_score_normalized"))


def hourly_pattern(e: DataFrame) -> DataFrame:
    return e.groupBy("hour").agg(F.count(F.lit(1)).alias("event_count"), F.sum(
        F.coalesce(F.col("is_anomaly_original").cast("int"), F.lit(0))).alias("anomaly_count")).orderBy("hour")


def anomaly_summary(e: DataFrame) -> DataFrame:
    return e.where("is_anomaly_original").groupBy("anomaly_type_original").agg(F.count(F.lit(1)).alias("count"))


def suspicious_ips(e: DataFrame) -> DataFrame:
    per_ip = e.where("is_suspicious_ip = 1").groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("user_name").alias("unique_users"),
        F.sum("has_error").alias("error_count"))
    return per_ip.orderBy(F.desc("event_count"), F.asc("source_ip"))


def sensitive_actions(e: DataFrame) -> DataFrame:
    return (e.where("is_sensitive_action = 1").orderBy(F.desc_nulls_last("event_time"), F.asc("event_id")).limit(LISTED)
            .select("event_name", "user_name", "source_ip", "event_time", "risk_score_normalized"))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {f.__name__: f for f in (
    total_events, risk_distribution, top_users, high_risk_events, hourly_pattern, anomaly_summary, suspicious_ips,
    sensitive_actions)}
# reports on columns that need only their own row: no statistics of the whole table
ROW_LOCAL = {"total_events", "hourly_pattern", "anomaly_summary", "suspicious_ips"}

TEXTS = {
    "total_events": "|> AGGREGATE count(*) AS total_events",
    "risk_distribution": "|> AGGREGATE count(*) AS count GROUP BY risk_level",
    "top_users": f"""|> AGGREGATE count(*) AS event_count, sum(is_sensitive_action) AS sensitive_actions, sum(has_error) AS errors,
             round(avg(risk_score_normalized), 2) AS avg_risk_score GROUP BY user_name
|> ORDER BY event_count DESC, user_name NULLS FIRST |> LIMIT {TOP}""",
    "high_risk_events": f"""|> WHERE risk_level IN ('high', 'critical') |> ORDER BY risk_score_normalized DESC, event_id |> LIMIT {LISTED}
|> SELECT user_name, source_ip, event_name, event_time, risk_level, risk_score_normalized""",
    "hourly_pattern": "|> AGGREGATE count(*) AS event_count, count_if(is_anomaly_original) AS anomaly_count GROUP BY hour |> ORDER BY hour",
    "anomaly_summary": "|> WHERE is_anomaly_original |> AGGREGATE count(*) AS count GROUP BY anomaly_type_original",
    "suspicious_ips": """|> WHERE is_suspicious_ip = 1
|> AGGREGATE count(*) AS event_count, count(DISTINCT user_name) AS unique_users, sum(has_error) AS error_count GROUP BY source_ip
|> ORDER BY event_count DESC, source_ip""",
    "sensitive_actions": f"""|> WHERE is_sensitive_action = 1 |> ORDER BY event_time DESC NULLS LAST, event_id |> LIMIT {LISTED}
|> SELECT event_name, user_name, source_ip, event_time, risk_score_normalized""",
}


def list_queries() -> list[str]:
    return list(REPORTS)


def get_query(name: str, table: str = TABLE) -> str | None:
    """Text of a report over a stored table, or None for an unknown name."""
    return f"FROM {table}\n{TEXTS[name]}" if name in TEXTS else None


def as_table(features: DataFrame) -> DataFrame:
    """The feature table as the reports see it (wall-clock event time)."""
    return features.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def store_events(features: DataFrame, path: str, table: str = TABLE) -> str:
    """Write the feature table once, partitioned by date, and name it `table` in the session,
    so that `spark.sql(get_query(name))` reads the stored columns. Rows are dealt by
    date, and AQE splits a large date by its bytes into as many tasks and files as it
    needs. Returns the name."""
    spark = features.sparkSession
    dated = as_table(features).withColumn("event_date", F.to_date("event_time"))
    (dated.hint("rebalance", F.col("event_date"))
     .write.mode("error").partitionBy("event_date").parquet(path))
    spark.read.schema(dated.schema).parquet(path).createOrReplaceTempView(table)
    return table


def run_query(spark: SparkSession, name: str, features: DataFrame) -> DataFrame:
    if name not in REPORTS:
        raise KeyError(f"unknown query {name!r}; known: {list_queries()}")
    return REPORTS[name](as_table(features))
