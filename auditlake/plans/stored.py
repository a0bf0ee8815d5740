"""Queries over what outlives a job: the lossless raw zone, baseline versions, and streams that
are closed, restarted or late. All read the trail as raw documents (`fixture.raw_documents`)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.operators import features as FT
from auditlake.operators.baselines import NO_DAY, BaselineStore
from auditlake.operators.event_stats import event_stats
from auditlake.session import scratch_path
from auditlake.sources import variant as V
from auditlake.sources.fixture import raw_documents, trail
from auditlake.streaming import ingest as ST

STATE_KEYS = [path for _, path, _ in V.KEYS] + ["$.userIdentity", "$.requestParameters.n", "$.requestParameters.braces", "$.additionalEventData"]


def land(flat: DataFrame, path: str) -> None:
    """Append the raw documents of some events to a landing folder, a document a line."""
    raw_documents(flat).write.mode("append").text(path)


def zone(s: SparkSession, sf: str) -> DataFrame:
    """VARIANT events of the raw zone: delivered documents, read and stored by day."""
    landing = scratch_path(s, "landing")
    land(trail(s, sf), landing)
    return V.read_variant_zone(s, V.write_variant_zone(V.read_variant_events(s, landing, multi_line=False), scratch_path(s, "raw-zone")))


def flat_zone(s: SparkSession, sf: str) -> DataFrame:
    return V.flatten_variant(zone(s, sf))


def q_flatten_events_missing_keys(s, sf):
    return flat_zone(s, sf).withColumn("event_time", C.ntz("event_time"))


def q_raw_zone_key_states(s, sf):
    """In how many events each key is missing, null, empty or filled, from the stored zone."""
    return V.key_states(zone(s, sf), STATE_KEYS)


def q_event_has_error_missing_keys(s, sf):
    """E4 under the reference semantics: an explicit null counts as an error, a missing key does not."""
    return flat_zone(s, sf).select("event_id", C.flag(C.has_error("error_code", C.ERROR_REFERENCE)).alias("has_error"))


def q_user_error_count_missing_keys(s, sf):
    """U4 under the reference semantics."""
    flat = flat_zone(s, sf)
    return FT.add_user_features(flat, event_stats(flat), C.ERROR_REFERENCE).select("event_id", "user_error_count", "user_error_rate")


# ------------------------------------------------------------------- baselines
def middle_day(flat: DataFrame) -> str:
    """The day in the middle of the table's time range."""
    t = F.unix_seconds("event_time")
    middle = F.min(t) + F.floor((F.max(t) - F.min(t)) / 2)
    return flat.agg(F.to_date(F.timestamp_seconds(middle)).cast("string")).first()[0] or NO_DAY


def two_parts(s: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    """The trail, and which of its events come first: up to the middle day, or with no readable time."""
    flat = trail(s, sf)
    k = F.col("event_id").cast("long")
    return flat, (F.to_date("event_time").cast("string") <= middle_day(flat)) | (k % 613).isin(7, 8)


def landed(s: SparkSession, flat: DataFrame, landing: str | None = None) -> DataFrame:
    """Flat events, by way of raw documents."""
    landing = landing or scratch_path(s, "landing")
    land(flat, landing)
    return V.flatten_variant(V.read_variant_events(s, landing, multi_line=False))


def merged_store(s: SparkSession, sf: str) -> BaselineStore:
    """Two commits of different days, then a third that replaces days of the second."""
    flat, first = two_parts(s, sf)
    store = BaselineStore(s, scratch_path(s, "baselines"))
    store.commit(landed(s, flat.where(first)))
    rest = landed(s, flat.where(~first))
    store.commit(rest.where(F.dayofmonth("event_time") % 3 != 0).unionByName(rest.where(F.dayofmonth("event_time") % 3 == 0).limit(1)))
    store.commit(rest.where(F.dayofmonth("event_time") % 3 == 0))
    return store


def q_baselines_merged_days(s, sf):
    """Merged days equal one batch over all of them."""
    return merged_store(s, sf).stats().users(C.ERROR_REFERENCE)[0]


def q_baselines_merged_addresses(s, sf):
    return merged_store(s, sf).stats().ips()[0]


def q_baselines_approximate(s, sf):
    """U2, U3, N5 with sketches: for each user and address the exact counts, and whether the estimate from a sketch a day is
    within four standard errors of them (and half an event)."""
    store = merged_store(s, sf)
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 4 * 0.01625 * F.col(b) + 0.5
    users = store.stats().users()[0].join(store.approximate("user").withColumnRenamed("key", "user_name"), "user_name").select(
        F.lit("user").alias("kind"), F.col("user_name").alias("key"), F.col("n").alias("events"), F.col("user_unique_ips").alias("others"),
        (close("ips", "user_unique_ips") & close("event_names", "user_unique_event_types")).alias("within_error"))
    ips = store.stats().ips()[0].join(store.approximate("ip").withColumnRenamed("key", "source_ip"), "source_ip").select(
        F.lit("ip").alias("kind"), F.col("source_ip").alias("key"), F.col("n").alias("events"), F.col("ip_unique_users").alias("others"),
        close("users", "ip_unique_users").alias("within_error"))
    return users.unionByName(ips)


def q_baselines_last_week(s, sf):
    """Counts over a range of days: the last seven that have events."""
    store = merged_store(s, sf)
    days = [r["day"] for r in store.days().where(F.col("day") != NO_DAY).orderBy(F.col("day").desc()).limit(7).collect()]
    return store.stats(first=min(days, default=None), last=max(days, default=None)).users()[0].select(
        "user_name", "user_total_events", "user_unique_ips", "user_unique_event_types") if days else store.stats().users()[0].limit(0)


def q_baselines_stream_restart(s, sf):
    """A stream joins the version that is newest when a batch runs; restarted from its checkpoint, it
    goes on with the one committed meanwhile."""
    flat, first = two_parts(s, sf)
    store = BaselineStore(s, scratch_path(s, "baselines"))
    landing, out, ckpt = (scratch_path(s, n) for n in ("landing", "enriched", "enriched-ckpt"))
    columns = ["event_id", "user_name", "event_name", "source_ip"]
    for part in (first, ~first):
        store.commit(landed(s, flat.where(part)))
        land(flat.where(part), landing)
        stream = V.flatten_variant(V.read_variant_stream(s, landing, multi_line=False)).select(*columns)
        ST.enrich_stream(stream, store, out, ckpt)
    return s.read.parquet(out).select("event_id", "baseline_version", "user_total_events", "event_type_frequency", "ip_event_count")


# --------------------------------------------------------------------- streams
def closed_counts(s: SparkSession, sf: str, counts: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Windowed counts of a finished backfill: a first run, the end marker, and a second run from the checkpoint."""
    landing, path, ckpt = (scratch_path(s, n) for n in ("landing", name, f"{name}-ckpt"))
    land(trail(s, sf), landing)
    made = counts(V.flatten_variant(V.read_variant_stream(s, landing, multi_line=False)))
    ST.run_to_parquet(made, name, out=path, ckpt=ckpt)
    last = V.flatten_variant(V.read_variant_events(s, landing, multi_line=False)).agg(F.max("event_time")).first()[0]
    if last is not None:
        ST.close_backfill(s, landing, last)
        ST.run_to_parquet(counts(V.flatten_variant(V.read_variant_stream(s, landing, multi_line=False))), name, out=path, ckpt=ckpt)
    return s.read.schema(made.schema).parquet(path)


def q_stream_minute_counts_closed(s, sf):
    return closed_counts(s, sf, ST.minute_counts, "minutes")


def q_stream_user_hour_counts_closed(s, sf):
    return closed_counts(s, sf, ST.user_hour_counts, "user-hours")


def q_stream_late_rows(s, sf):
    """Every tenth event is delivered after the others: those whose minute was closed by then."""
    flat = trail(s, sf)
    late = F.col("event_id").cast("long") % 10 == 0
    landing, out, seen, ckpt = (scratch_path(s, n) for n in ("landing", "late", "seen", "late-ckpt"))
    for part in (~late, late):
        land(flat.where(part), landing)
        events = V.flatten_variant(V.read_variant_stream(s, landing, multi_line=False)).select("event_id", "event_time")
        ST.report_late(events, out, seen, ckpt)
    rows = ST.read_batches(s, out, events.withColumn("window_start", F.col("event_time")))
    return rows.select("event_id", C.ntz("event_time").alias("event_time"), C.ntz("window_start").alias("window_start"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [q_flatten_events_missing_keys, q_raw_zone_key_states, q_event_has_error_missing_keys, q_user_error_count_missing_keys,
             q_baselines_merged_days, q_baselines_merged_addresses, q_baselines_approximate, q_baselines_last_week,
             q_baselines_stream_restart, q_stream_minute_counts_closed, q_stream_user_hour_counts_closed, q_stream_late_rows]
    return {f.__name__.removeprefix("q_"): f for f in found}


