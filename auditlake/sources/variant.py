"""Raw events kept whole: one VARIANT an event, every key as it was delivered.

`{"Records": [...]}` documents are read into a VARIANT column, so a key that is missing, an
explicit null, an empty text and keys that no rule knows all stay apart. The raw zone
is a Parquet table of such events by day. Flattening tells a missing key (it takes the
key's default: empty text, or `Unknown` for a user's name) from an explicit null (null), which
decides `has_error` and the error counts under the reference semantics.

Defined cases: a document that isn't JSON or has no `Records` list gives no events; a list entry
that isn't an object is an event without keys; a missing or null `userIdentity` is an identity without keys;
a value of another type than text is taken as its text; a time in another layout is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions import columns as C

# fixed values: column, key, what a missing key stands for
KEYS = [
    ("event_id", "$.eventID", ""),
    ("event_time", "$.eventTime", ""),
    ("event_source", "$.eventSource", ""),
    ("event_name", "$.eventName", ""),
    ("aws_region", "$.awsRegion", ""),
    ("user_type", "$.userIdentity.type", ""),
    ("user_name", "$.userIdentity.userName", "Unknown"),
    ("user_arn", "$.userIdentity.arn", ""),
    ("account_id", "$.userIdentity.accountId", ""),
    ("source_ip", "$.sourceIPAddress", ""),
    ("user_agent", "$.userAgent", ""),
    ("error_code", "$.errorCode", ""),
    ("error_message", "$.errorMessage", ""),
    ("is_anomaly_original", "$.is_anomaly", None),
    ("anomaly_type_original", "$.anomaly_type", None),
]
EVENT = "event"
STATES = ("missing", "null", "empty", "filled")


def documents_to_events(documents: DataFrame, column: str = "document") -> DataFrame:
    """One VARIANT `event` a row, from VARIANT documents."""
    return documents.select(F.explode(F.try_variant_get(column, "$.Records", "array<variant>")).alias(EVENT))


def read_variant_events(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Events of delivered files: a file is one document, or with `multi_line=False` a line is."""
    return documents_to_events(spark.read.option("singleVariantColumn", "document").option("multiLine", multi_line).json(path))


def read_variant_stream(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The same as a stream of files."""
    stream = spark.readStream.schema("document variant").option("singleVariantColumn", "document").option("multiLine", multi_line)
    return documents_to_events(stream.json(path))


def value(path: str, default, kind: str = "string", event: str = EVENT) -> Column:
    """A key's value; `default` where the key is missing, null where it is an explicit null."""
    there = F.try_variant_get(event, path, "variant")
    return F.when(there.isNull(), F.lit(default).cast(kind)).otherwise(F.try_variant_get(event, path, kind))


def key_state(path: str, event: str = EVENT) -> Column:
    """`missing`, `null`, `empty` (empty text) or `filled`."""
    there = F.try_variant_get(event, path, "variant")
    return (F.when(there.isNull(), "missing").when(F.is_variant_null(there), "null")
            .when(F.try_variant_get(event, path, "string") == "", "empty").otherwise("filled"))


def flatten_variant(events: DataFrame) -> DataFrame:
    """The 15-column flat table."""
    def column(name: str, path: str, default) -> Column:
        if name == "event_time":
            return C.parse_event_time(value(path, default)).alias(name)
        return value(path, default, "boolean" if name == "is_anomaly_original" else "string").alias(name)
    return events.select(*[column(*k) for k in KEYS])


def key_states(events: DataFrame, paths: list[str]) -> DataFrame:
    """(key, missing, null, empty, filled): how many events have each key in which state. One aggregate."""
    states = events.select(F.explode(F.array(*[F.struct(F.lit(p).alias("key"), key_state(p).alias("state")) for p in paths])).alias("s"))
    return states.groupBy("s.key").agg(*[F.count_if(F.col("s.state") == s).alias(f"{s}_events") for s in STATES])


def write_variant_zone(events: DataFrame, path: str, mode: str = "error") -> str:
    """The raw zone: VARIANT events in Parquet, a folder a day. Rows are dealt by day ahead of the write, and AQE
    splits large days and joins small ones by their bytes, so a day has files of the advisory size, however many tasks read it."""
    day = F.coalesce(F.to_date(C.parse_event_time(value("$.eventTime", ""))).cast("string"), F.lit("none"))
    events.select(EVENT, day.alias("day")).hint("rebalance", F.col("day")).write.mode(mode).partitionBy("day").parquet(path)
    return path


def read_variant_zone(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("event variant, day string").parquet(path)
