"""The lossless raw zone, baseline versions, closed and late streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.operators import baselines as B
from auditlake.operators.event_stats import event_stats
from auditlake.plans.features import build_features
from auditlake.session import local_path, scratch_path
from auditlake.sources import variant as V
from auditlake.sources.sinks import write_features
from auditlake.streaming import ingest as ST
from tests.helpers import flat_rows

SMALL = "/root/testdata/sf0.001"


def events_of(spark, *documents):
    path = scratch_path(spark, "docs")
    spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string").write.text(path)
    return V.read_variant_events(spark, path, multi_line=False)


ODD = [{"Records": [{"eventID": "a", "errorCode": None}, {"eventID": "b"}, {"eventID": "c", "errorCode": ""}, {"eventID": "d", "errorCode": "X"},
                    {"eventID": "e", "userIdentity": None, "errorCode": 5}, {"eventID": "f", "userIdentity": {"userName": None}},
                    {"eventID": "g", "userIdentity": {"userName": ""}, "eventTime": "2024-01-01T00:00:00Z", "is_anomaly": True, "x": {"y": [1, None]}},
                    {"eventID": None, "eventTime": "2024-01-01 00:00:00"}, 7]},
       {"Records": []}, {"Records": None}, {"other": 1}, "not json", {"Records": {"eventID": "no list"}}]


def test_missing_null_and_empty_stay_apart(spark):
    rows = V.flatten_variant(events_of(spark, *ODD)).collect()
    by = {r.event_id: r for r in rows}
    assert len(rows) == 9 and [by[k].error_code for k in "abcde"] == [None, "", "", "X", "5"]
    assert [by[k].user_name for k in "efga"] == ["Unknown", None, "", "Unknown"] and by["e"].user_type == "" and by["f"].user_type == ""
    assert by["g"].event_time == dt.datetime(2024, 1, 1) and by["g"].is_anomaly_original is True and by[None].event_time is None
    assert by[""].user_name == "Unknown" and by[""].is_anomaly_original is None            # the entry that is no object
    wrong = V.flatten_variant(events_of(spark, *ODD)).select("event_id", C.has_error("error_code", C.ERROR_REFERENCE).alias("e"))
    assert {r.event_id: r.e for r in wrong.collect() if r.event_id in set("abcd")} == {"a": True, "b": False, "c": False, "d": True}


def test_zone_keeps_every_key(spark):
    path = V.write_variant_zone(events_of(spark, *ODD), scratch_path(spark, "zone"))
    back = [json.loads(r.j) for r in V.read_variant_zone(spark, path).select(F.to_json("event").alias("j")).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, back)) == sorted(map(key, ODD[0]["Records"]))
    assert {d for d in os.listdir(local_path(path)) if d.startswith("day=")} == {"day=2024-01-01", "day=none"}
    states = {r.key: tuple(r)[1:] for r in V.key_states(V.read_variant_zone(spark, path), ["$.errorCode", "$.x.y"]).collect()}
    assert states == {"$.errorCode": (5, 1, 1, 2), "$.x.y": (8, 0, 0, 1)}
    whole = scratch_path(spark, "pretty")
    spark.createDataFrame([(json.dumps(ODD[0], indent=2),)], "value string").coalesce(1).write.text(whole)
    assert V.read_variant_events(spark, whole).count() == 9


def test_files_of_a_date_follow_its_bytes(spark):
    flat = flat_rows(spark, [{"event_id": str(k), "event_time": f"2024-01-0{1 + k % 2} 10:00:00", "user_name": f"u{k % 5}"} for k in range(400)])
    path = local_path(write_features(build_features(flat.repartition(12)), scratch_path(spark, "dated")))
    dates = [d for d in os.listdir(path) if d.startswith("event_date=")]
    assert len(dates) == 2 and all(sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{d}")) == 1 for d in dates)


def days(spark, *which):
    rows = [{"event_id": f"{d}-{k}", "event_time": None if d == 0 else f"2024-01-{d:02d} {k % 24:02d}:{k % 60:02d}:00",
             "user_name": None if k % 11 == 0 else f"u{k % 7}", "source_ip": "" if k % 5 == 0 else None if k % 13 == 0 else f"10.0.{d}.{k % 9}",
             "event_name": f"n{(k + d) % 4}", "error_code": (None, "", "Denied")[k % 3]} for d in which for k in range(60)]
    return flat_rows(spark, rows)


def as_set(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_merged_days_equal_one_batch(spark):
    store = B.BaselineStore(spark, scratch_path(spark, "base"))
    assert store.version() == 0 and store.stats().users()[0].count() == 0
    assert [store.commit(days(spark, 0, 1, 2)), store.commit(days(spark, 3)), store.commit(days(spark, 2))] == [1, 2, 3]
    merged, batch = store.stats(), event_stats(days(spark, 0, 1, 2, 3))
    for lookup in ("users", "ips", "event_names", "minutes", "user_hours"):
        assert as_set(getattr(merged, lookup)()[0]) == as_set(getattr(batch, lookup)()[0]), lookup
    assert (merged.rows, merged.total_rows, merged.timed_rows) == (batch.rows, batch.total_rows, batch.timed_rows)
    flat = days(spark, 0, 1, 2, 3)
    assert as_set(build_features(flat, stats=merged)) == as_set(build_features(flat))
    assert as_set(store.stats(version=1).users()[0]) == as_set(event_stats(days(spark, 0, 1, 2)).users()[0])
    assert as_set(store.stats(first="2024-01-02", last="2024-01-03").ips()[0]) == as_set(event_stats(days(spark, 2, 3)).ips()[0])


def test_a_replaced_day_leaves_no_trace_and_a_lost_job_shows_nothing(spark, monkeypatch):
    store = B.BaselineStore(spark, scratch_path(spark, "base"))
    store.commit(days(spark, 1, 2))
    monkeypatch.setattr(B, "materialize", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.commit(days(spark, 3))                      # its counts are written, its commit is not
    monkeypatch.undo()
    assert store.version() == 1 and {r.day for r in store.days().collect()} == {"2024-01-01", "2024-01-02"}
    assert as_set(store.stats().users()[0]) == as_set(event_stats(days(spark, 1, 2)).users()[0])
    half = days(spark, 2).where("event_id < '2-3'")
    assert store.commit(half) == 2
    assert as_set(store.stats().users()[0]) == as_set(event_stats(days(spark, 1).unionByName(half)).users()[0])
    assert store.commit(days(spark)) == 3 and as_set(store.stats().users()[0]) == as_set(store.stats(2).users()[0])


def test_sketches_count_within_their_error(spark):
    store = B.BaselineStore(spark, scratch_path(spark, "base"))
    for part in (0, 1):
        flat = spark.range(0, 30_000).selectExpr(
            "CAST(id AS string) AS event_id", f"TIMESTAMP '2024-02-0{part + 1} 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id % 1440 AS int)) AS event_time",
            "'u' AS user_name", f"CAST(id + {part * 10_000} AS string) AS source_ip", "CAST(NULL AS string) AS event_name", "'' AS error_code")
        store.commit(flat)
    row = store.approximate("user").first()
    assert row.n == 60_000 and abs(row.ips - 40_000) <= 4 * 0.01625 * 40_000 and row.event_names == 0
    assert store.stats().users()[0].first().user_unique_ips == 40_000
    assert store.approximate("ip").where("users = 1").count() == store.approximate("ip").count()
    assert store.approximate("user", last="2024-02-01").first().n == 30_000


def write_raw(spark, path, times):
    lines = [json.dumps({"Records": [{"eventID": f"{t}-{k}", "eventTime": t} for k, t in enumerate(times)]})]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def flat_stream(spark, path):
    return V.flatten_variant(V.read_variant_stream(spark, path, multi_line=False))


def test_marker_closes_the_last_windows_and_counts_nowhere(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    write_raw(spark, src, ["2024-01-01T10:00:05Z", "2024-01-01T10:00:10Z", "2024-01-01T10:30:00Z"])
    run = lambda: ST.run_to_parquet(ST.minute_counts(flat_stream(spark, src)), "m", out=out, ckpt=ckpt)
    counts = lambda: {str(r.minute_start)[11:16]: r.events_this_minute for r in spark.read.parquet(out).collect()}
    run()
    assert counts() == {"10:00": 2}
    ST.close_backfill(spark, src, dt.datetime(2024, 1, 1, 10, 30))
    run()
    assert counts() == {"10:00": 2, "10:30": 1}
    write_raw(spark, src, ["2024-01-09T00:00:00Z"])
    ST.close_backfill(spark, src, dt.datetime(2024, 1, 9))
    run()
    assert counts() == {"10:00": 2, "10:30": 1, "00:00": 1}


def test_late_rows_are_reported_whole(spark):
    src, out, seen, ckpt = (scratch_path(spark, n) for n in ("src", "late", "seen", "ckpt"))
    like = spark.createDataFrame([], "event_id string, event_time timestamp, window_start timestamp")
    run = lambda: ST.report_late(flat_stream(spark, src).select("event_id", "event_time"), out, seen, ckpt)
    late = lambda: sorted(str(r.event_time)[11:16] for r in ST.read_batches(spark, out, like).collect())
    write_raw(spark, src, ["2024-01-01T10:00:05Z", "2024-01-01T11:00:00Z"])
    run()
    assert late() == []                                             # nothing was closed before the first batch
    write_raw(spark, src, ["2024-01-01T10:49:30Z", "2024-01-01T10:48:59Z", "2024-01-01T10:50:00Z", "2024-01-01T09:00:00Z", "x"])
    run()
    run()
    assert late() == ["09:00", "10:48", "10:49"]


def test_reading_batches_writes_nothing(spark):
    path = scratch_path(spark, "no-batches")
    assert ST.read_batches(spark, path, spark.createDataFrame([], "a int")).count() == 0
    assert not os.path.exists(local_path(path))
