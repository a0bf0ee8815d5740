"""Structured Streaming jobs over a folder of raw audit-log files.

* `row_local_stream`: file source -> the flat table + every row-local rule
  (time, event and network flags, parser risk level); stateless.
* `minute_counts`: watermarked tumbling-minute counts (append mode). `close_backfill` ends
  a finished backfill, so that its last windows come out too; `report_late` writes the
  events that came after their window had closed to a table.
* `alerts`: parser high/critical events, de-duplicated on event id within the
  watermark, appended by `foreachBatch` to an alerts table.
* `enrich_stream`: joins each micro-batch with the newest committed version of a baseline store.
* `enrich_with_baselines`: whole-table counts cannot be computed on an
  unbounded stream, so a batch job writes baseline tables and the stream joins
  them (stream-static left join, broadcast only under the size check).

Runners use `trigger(availableNow=True)` with their checkpoint under the shared
checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions import columns as C
from auditlake.operators import features as FT
from auditlake.operators.baselines import BaselineStore
from auditlake.operators.event_stats import EventStats
from auditlake.operators.lookup import broadcast_or_shuffle
from auditlake.operators.parse import parser_level, parser_points
from auditlake.schema import RAW_FILE
from auditlake.session import scratch_path
from auditlake.sources.raw import flat_columns

WATERMARK = "10 minutes"
END_OF_BACKFILL = "__end_of_backfill__"


def read_raw_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_FILE).option("multiLine", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select(F.inline("Records"))


def row_local_stream(raw: DataFrame) -> DataFrame:
    """Flat columns + row-local features + parser risk level."""
    flat = raw.select(*flat_columns(), parser_level(parser_points(raw)).alias("parser_risk_level"))
    out = FT.add_time_features(flat)
    out = FT.add_event_flags(out)
    out = FT.add_network_flags(out)
    return (out.withColumn("is_suspicious_user_agent", C.flag(C.is_suspicious_user_agent("user_agent")))
               .withColumn("is_console_access", C.flag(C.is_console_access("user_agent"))))


def is_end():
    return F.col("event_id").eqNullSafe(END_OF_BACKFILL)


def close_backfill(spark: SparkSession, path: str, last_time: dt.datetime, name: str = "end") -> None:
    """End a finished backfill: a file with one marker event, later than `last_time` by more than a
    window and the watermark's delay, so that the next run of a counting stream closes all windows. The marker
    counts in no window."""
    until = (last_time + dt.timedelta(days=2)).strftime("%Y-%m-%dT%H:%M:%SZ")
    record = F.to_json(F.struct(F.array(F.struct(F.lit(END_OF_BACKFILL).alias("eventID"), F.lit(until).alias("eventTime"))).alias("Records")))
    spark.range(1).select(record.alias("value")).coalesce(1).write.mode("append").text(path)


def minute_counts(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events per tumbling minute, emitted once the watermark closes it."""
    return (events.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 minute").alias("w"))
            .agg(F.count_if(~is_end()).alias("events_this_minute")).where("events_this_minute > 0")
            .select(C.ntz("w.start").alias("minute_start"), "events_this_minute"))


def user_hour_counts(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events per (tumbling hour, user), emitted once the watermark closes it."""
    return (events.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 hour").alias("w"), "user_name")
            .agg(F.count_if(~is_end()).alias("user_events_this_hour")).where("user_events_this_hour > 0")
            .select(C.ntz("w.start").alias("hour_start"), "user_name", "user_events_this_hour"))


def alerts(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """High and critical parser-level events, one row per event id; events without
    an id count as the same only if they agree in every column."""
    key = F.coalesce(F.col("event_id"), F.sha2(F.to_json(F.struct(*events.columns)), 256))
    return (events.where(F.col("parser_risk_level").isin("high", "critical"))
            .withColumn("_alert", key).withWatermark("event_time", watermark)
            .dropDuplicatesWithinWatermark(["_alert"]).drop("_alert"))


def enrich_with_baselines(stream: DataFrame, stats: EventStats) -> DataFrame:
    """Attach whole-table baselines (user, event name, address) to a stream."""
    out = stream
    for lk, bound, key in ((*stats.users(), "user_name"), (*stats.event_names(), "event_name"),
                           (*stats.ips(), "source_ip")):
        out = out.join(broadcast_or_shuffle(lk, bound), key, "left")
    return out


def enrich_stream(stream: DataFrame, store: BaselineStore, out: str, ckpt: str) -> None:
    """D14 with a stored baseline: each micro-batch joins the version that is newest when it runs, and
    says which. A restarted stream (same checkpoint) goes on with what has been committed
    meanwhile; a replayed batch overwrites its own rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        version = store.version()
        rows = enrich_with_baselines(batch, store.stats(version)).withColumn("baseline_version", F.lit(version).cast("long"))
        write_batch(rows, batch_id, out)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()


def report_late(events: DataFrame, out: str, seen: str, ckpt: str, window: str = "minute", delay_minutes: int = 10) -> None:
    """Events whose tumbling window was closed before they came, as whole rows of a table, so they can be counted
    again or corrected. The watermark is that of the windowed counts: the latest event time
    of all batches before, less the delay. `seen` holds one row a batch with its latest time."""
    spark = events.sparkSession
    start = F.date_trunc(window, F.col("event_time"))

    def write(batch: DataFrame, batch_id: int) -> None:
        high = None
        if batch_id:
            high = spark.read.schema("latest timestamp, _batch_id int").parquet(seen).where(F.col("_batch_id") < batch_id).agg(F.max("latest")).first()[0]
        closed = F.lit(False) if high is None else start + F.expr(f"INTERVAL 1 {window}") <= F.lit(high) - F.expr(f"INTERVAL {delay_minutes} minutes")
        write_batch(batch.where(closed & ~is_end()).withColumn("window_start", start), batch_id, out)
        write_batch(batch.agg(F.max("event_time").alias("latest")), batch_id, seen)

    events.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()


def write_batch(rows: DataFrame, batch_id: int, out: str) -> None:
    (rows.withColumn("_batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_batch_id").parquet(out))


def run_to_parquet(df: DataFrame, name: str, mode: str = "append", out: str | None = None, ckpt: str | None = None) -> str:
    """Run a streaming DataFrame to completion into a parquet folder; with `out` and `ckpt` it
    goes on where a run before ended."""
    spark = df.sparkSession
    out, ckpt = out or scratch_path(spark, name), ckpt or scratch_path(spark, f"{name}-ckpt")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def run_foreach_batch(df: DataFrame, name: str, key: str = "event_id",
                      out: str | None = None, ckpt: str | None = None) -> str:
    """Write each micro-batch as its own partition of a parquet table. A batch
    replayed after a failure overwrites its own partition (dynamic partition
    overwrite keyed by the batch id), so the output is exactly-once."""
    spark = df.sparkSession
    out = out or scratch_path(spark, name)
    ckpt = ckpt or scratch_path(spark, f"{name}-ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out)

    q = (df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def read_batches(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that `run_foreach_batch` wrote (none, if no batch had any)."""
    schema = T.StructType([*like.schema.fields, T.StructField("_batch_id", T.IntegerType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
