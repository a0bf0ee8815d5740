"""The `trail` fixture: the driver's `events` table mapped onto the flat schema.

The reference ships no event data, so tests and registered queries run on a
deterministic view over `events` that exercises every rule (sensitive and
recon names, bad and internal addresses, empty and null fields, tool agents,
midnight ties, bursts). The SQL text is the one piece shared with the DuckDB
oracles; the operators themselves are written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.session import prepare

# `{events}` is substituted by the events relation (a DataFrame in Spark, the
# view name in DuckDB).
FIXTURE_SQL = """
WITH e AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k,
         (event_id % 400 = 19) AS atk FROM {events}
)
SELECT
  CAST(event_id AS STRING) AS event_id,
  CAST(CASE WHEN event_id % 12 = 7 THEN date_trunc('day', ts) ELSE ts END AS TIMESTAMP) AS event_time,
  CASE WHEN atk THEN 'secretsmanager.amazonaws.com'
       WHEN event_id % 2000 = 5 THEN 'cloudtrail.amazonaws.com'
       WHEN event_type = 'click' THEN CASE WHEN k % 2 = 0 THEN 's3.amazonaws.com' ELSE 'lambda.amazonaws.com' END
       WHEN event_type = 'view' THEN CASE k % 3 WHEN 0 THEN 'ec2.amazonaws.com' WHEN 1 THEN 'rds.amazonaws.com' ELSE 'iam.amazonaws.com' END
       WHEN event_type = 'signup' THEN 'iam.amazonaws.com'
       WHEN event_type = 'purchase' THEN 's3.amazonaws.com'
       ELSE 'signin.amazonaws.com' END AS event_source,
  CASE WHEN atk THEN 'ListSecrets'
       WHEN event_id % 2000 = 5 THEN 'StopLogging'
       WHEN event_type = 'click' THEN CASE WHEN k % 2 = 0 THEN 'ListBuckets' ELSE 'InvokeFunction' END
       WHEN event_type = 'view' THEN CASE k % 3 WHEN 0 THEN 'DescribeInstances' WHEN 1 THEN 'DescribeDBInstances' ELSE 'ListUsers' END
       WHEN event_type = 'signup' THEN CASE WHEN k % 7 = 0 THEN 'CreateUser' ELSE 'GetUser' END
       WHEN event_type = 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'GetObject' ELSE 'PutObject' END
       ELSE 'ConsoleLogin' END AS event_name,
  'us-east-1' AS aws_region,
  'IAMUser' AS user_type,
  CASE WHEN event_id % 2500 = 3 THEN 'temp_' || CAST(event_id AS STRING)
       WHEN event_id % 12 = 7 THEN 'unknown_actor'
       WHEN event_id % 997 = 11 THEN NULL
       ELSE 'user_' || CAST(user_id AS STRING) END AS user_name,
  'arn:aws:iam::000000000000:user/' || CAST(user_id AS STRING) AS user_arn,
  '000000000000' AS account_id,
  CASE WHEN atk THEN '45.227.255.206' ELSE
  CASE k % 25 WHEN 0 THEN '45.227.255.206' WHEN 1 THEN '185.220.101.34'
       WHEN 2 THEN '172.20.0.9' WHEN 3 THEN '172.40.0.9' WHEN 4 THEN 'ec2.amazonaws.com'
       WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 7 THEN '10.0.0.' || CAST(k % 5 AS STRING)
       ELSE '192.168.1.' || CAST(user_id AS STRING) END END AS source_ip,
  CASE WHEN atk THEN 'curl/7.84.0' ELSE
  CASE event_id % 9 WHEN 0 THEN 'curl/7.84.0' WHEN 1 THEN 'console.amazonaws.com'
       WHEN 2 THEN 'aws-cli/2.15.0 Python/3.11.0 Linux/5.4.0-KALI' WHEN 3 THEN NULL
       WHEN 4 THEN 'Boto3/1.26.0 Python/3.9.0'
       ELSE 'aws-sdk-python/1.34.0 Python/3.11.0' END END AS user_agent,
  CASE WHEN atk THEN 'AccessDenied'
       WHEN event_type = 'error' THEN CASE k % 3 WHEN 0 THEN 'AccessDenied' WHEN 1 THEN 'UnauthorizedOperation' ELSE 'ThrottlingException' END
       WHEN k % 10 = 9 THEN '' ELSE NULL END AS error_code,
  CASE WHEN atk OR event_type = 'error' THEN 'request failed' ELSE NULL END AS error_message,
  (atk OR event_id % 12 = 7 OR k % 25 = 0) AS is_anomaly_original,
  CASE WHEN atk THEN 'sensitive_action' WHEN event_id % 12 = 7 THEN 'unusual_time' WHEN k % 25 = 0 THEN 'unusual_ip' ELSE NULL END AS anomaly_type_original
FROM e
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat 15-column event table built from `<sf_dir>/events.parquet`."""
    prepare(spark)
    return spark.sql(FIXTURE_SQL, events=table(spark, sf_dir, "events"))


def _json(column: Column) -> Column:
    """A column's value as JSON text, an explicit `null` included."""
    text = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
    return F.substr(text, F.lit(6), F.length(text) - 6)


def raw_documents(flat: DataFrame, events_per_document: int = 500) -> DataFrame:
    """(document): the trail as `{"Records": [...]}` texts in which keys are missing, null or empty by
    fixed rules on the event id, with keys beyond the flat table's. A document's
    events are dealt by a hash of their id."""
    k = F.col("event_id").cast("long")

    def field(key: str, column, missing=None):
        pair = F.concat(F.lit(f'"{key}":'), _json(column))
        return pair if missing is None else F.when(~F.coalesce(missing, F.lit(False)), pair)

    def null(name: str, n: int):
        return F.col(name).isNull() & (k % n == 0)

    def joined(*fields):
        return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))

    identity = joined(field("type", F.col("user_type")), field("arn", F.col("user_arn")), field("accountId", F.col("account_id")),
                      field("userName", F.col("user_name"), null("user_name", 2)))
    time = F.when(k % 613 == 8, "n/a").otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    record = joined(
        field("eventID", F.col("event_id")), field("eventTime", time, k % 613 == 7),
        field("eventSource", F.col("event_source"), k % 401 == 3), field("eventName", F.col("event_name")),
        field("awsRegion", F.col("aws_region")), field("sourceIPAddress", F.col("source_ip"), null("source_ip", 2)),
        field("userAgent", F.col("user_agent"), null("user_agent", 4)),
        F.when(k % 89 != 0, F.concat(F.lit('"userIdentity":'), F.when(k % 89 == 1, "null").otherwise(identity))),
        field("errorCode", F.col("error_code"), null("error_code", 3)), field("errorMessage", F.col("error_message"), null("error_message", 5)),
        field("is_anomaly", F.col("is_anomaly_original")), field("anomaly_type", F.col("anomaly_type_original"), null("anomaly_type_original", 5)),
        F.when(k % 7 == 0, F.concat(F.lit('"requestParameters":{"n":'), k.cast("string"), F.lit(',"braces":"}{]["}'))),
        F.when(k % 11 == 0, F.lit('"additionalEventData":null')))
    group = F.pmod(F.xxhash64("event_id"), F.lit(max(1, -(-flat.count() // events_per_document))))
    return (flat.select(group.alias("g"), record.alias("r")).groupBy("g")
            .agg(F.concat(F.lit('{"Records":['), F.concat_ws(",", F.collect_list("r")), F.lit("]}")).alias("document")).select("document"))
