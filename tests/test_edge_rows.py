"""Hand-made edge rows (FIXTURES §4) through the Spark operators."""

import json
import math

from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.ml import evaluate as EV
from auditlake.operators import features as FT
from auditlake.operators.event_stats import event_stats
from auditlake.operators.parse import parse_events
from auditlake.plans.features import build_features
from auditlake.session import scratch_path, local_path
from auditlake.sources.raw import read_raw_records
from tests.helpers import by_id, flat_rows


def test_null_time_rules(spark):
    df = flat_rows(spark, [
        {"event_id": "a", "event_time": None, "user_name": "u1", "event_name": "X"},
        {"event_id": "b", "event_time": None, "user_name": "u1", "event_name": "X"},
        {"event_id": "c", "event_time": "2026-01-05 10:00:00", "user_name": "u1", "event_name": "X"},
    ])
    f = build_features(df)
    got = by_id(f, "hour", "is_business_hours", "is_weekend", "is_late_night", "time_period",
                "time_since_prev_event", "events_this_minute", "user_events_this_hour")
    assert got["a"] == (None, 0, 0, 0, "night", 0.0, None, 2)
    assert got["c"] == (10, 1, 0, 0, "morning", 0.0, 1, 1)


def test_parser_error_flags(spark):
    path = scratch_path(spark, "edge-raw")
    events = [
        {"eventID": "missing", "eventTime": "2026-01-05T10:00:00Z"},
        {"eventID": "null", "eventTime": "2026-01-05T10:00:00Z", "errorCode": None},
        {"eventID": "empty", "eventTime": "2026-01-05T10:00:00Z", "errorCode": ""},
        {"eventID": "x", "eventTime": "2026-01-05T10:00:00Z", "errorCode": "X"},
        {"eventID": "bad", "eventTime": "bad"},
    ]
    import os
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "f1.json"), "w") as fh:
        json.dump({"Records": events}, fh)
    with open(os.path.join(local_path(path), "f2.json"), "w") as fh:
        json.dump({}, fh)
    p = parse_events(read_raw_records(spark, path))
    got = by_id(p, "has_error", "risk_level", "hour_of_day", "is_business_hours", "user_name")
    assert got["missing"][:2] == (False, "low")
    assert got["null"][:2] == (False, "low")
    assert got["empty"][:2] == (True, "low")
    assert got["x"][:2] == (True, "medium")
    assert got["bad"][2:4] == (None, None)
    assert got["x"][4] == "Unknown"


def test_empty_records_give_schema(spark):
    path = scratch_path(spark, "edge-empty")
    import os
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "f.json"), "w") as fh:
        json.dump({"Records": []}, fh)
    r = read_raw_records(spark, path)
    assert r.count() == 0 and "eventID" in r.columns
    assert parse_events(r).count() == 0


def test_has_error_semantics(spark):
    df = flat_rows(spark, [{"event_id": "n", "error_code": None}, {"event_id": "e", "error_code": ""},
                           {"event_id": "x", "error_code": "X"}])
    pres = by_id(FT.add_event_flags(df, C.ERROR_PRESENT), "has_error")
    ref = by_id(FT.add_event_flags(df, C.ERROR_REFERENCE), "has_error")
    assert (pres["n"], pres["e"], pres["x"]) == (0, 0, 1)
    assert (ref["n"], ref["e"], ref["x"]) == (1, 0, 1)


def test_internal_ip(spark):
    ips = ["172.15.0.1", "172.16.0.1", "172.31.0.1", "172.32.0.1", "172.x.0.1", "172", "", None]
    df = flat_rows(spark, [{"event_id": str(i), "source_ip": ip} for i, ip in enumerate(ips)])
    got = by_id(FT.add_network_flags(df), "is_internal_ip")
    assert [got[str(i)] for i in range(len(ips))] == [0, 1, 1, 0, 0, 0, 0, 0]


def test_time_rules(spark):
    times = {"h8": "2026-01-05 08:30:00", "h9": "2026-01-05 09:00:00", "h18": "2026-01-05 18:59:00",
             "h19": "2026-01-05 19:00:00", "h5": "2026-01-05 05:00:00", "h6": "2026-01-05 06:00:00",
             "h12": "2026-01-05 12:00:00", "h17": "2026-01-05 17:00:00", "h21": "2026-01-05 21:00:00",
             "sat": "2026-01-10 12:00:00"}
    df = flat_rows(spark, [{"event_id": k, "event_time": v} for k, v in times.items()])
    got = by_id(FT.add_time_features(df), "is_business_hours", "time_period", "day_of_week")
    assert [got[k][0] for k in ["h8", "h9", "h18", "h19"]] == [0, 1, 1, 0]
    assert [got[k][1] for k in ["h5", "h6", "h12", "h17", "h21"]] == [
        "night", "morning", "afternoon", "evening", "night"]
    assert got["h9"][2] == 0 and got["sat"][2] == 5


def test_access_denied_case_sensitive(spark):
    df = flat_rows(spark, [{"event_id": "a", "error_code": "accessdenied"},
                           {"event_id": "b", "error_code": "Client.UnauthorizedOperation"}])
    got = by_id(FT.add_event_flags(df), "is_access_denied")
    assert got == {"a": 0, "b": 1}


def test_rapid_event(spark):
    df = flat_rows(spark, [
        {"event_id": "1", "event_time": "2026-01-05 10:00:00"},
        {"event_id": "2", "event_time": "2026-01-05 10:00:00"},
        {"event_id": "3", "event_time": "2026-01-05 10:00:00.500000"},
        {"event_id": "4", "event_time": "2026-01-05 10:00:01.500000"},
    ])
    f = build_features(df)
    got = by_id(f, "time_since_prev_event", "is_rapid_event")
    assert got["1"] == (0.0, 0) and got["2"] == (0.0, 0)
    assert got["3"] == (0.5, 1) and got["4"] == (1.0, 0)


def test_risk_levels(spark):
    rows = [(s, round(s / 19 * 100, 2)) for s in [4, 5, 9, 10, 13, 14]]
    df = spark.createDataFrame(rows, "s int, n double")
    got = [r[0] for r in df.select(C.risk_level_from_normalized("n")).collect()]
    assert got == ["low", "medium", "medium", "high", "high", "critical"]


def test_parser_levels(spark):
    from auditlake.operators.parse import parser_level
    df = spark.createDataFrame([(i,) for i in range(5)], "p int")
    got = [r[0] for r in df.select(parser_level(F.col("p"))).collect()]
    assert got == ["low", "medium", "medium", "high", "critical"]


def test_constant_scores_give_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "d double")
    got = [r[0] for r in df.select(EV.minmax_score("d", 1.0, 1.0)).collect()]
    assert got == [None, None]


def test_auc_one_class_is_zero(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, s double")
    assert EV.roc_auc(df, "y", "s").first()[0] == 0.0


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (0, 0.8)], "y int, s double")
    # pairs (pos, neg): 0.35>0.1, 0.35<0.4, 0.35<0.8, 0.8>0.1, 0.8>0.4, 0.8=0.8 -> 3.5/6
    assert math.isclose(EV.roc_auc(df, "y", "s").first()[0], round(3.5 / 6, 4))


def test_severity_bands(spark):
    df = spark.createDataFrame([(80.0,), (79.99,), (60.0,), (40.0,), (39.99,)], "s double")
    got = [r[0] for r in df.select(C.severity("s")).collect()]
    assert got == ["critical", "high", "high", "medium", "low"]


def test_null_user_counts(spark):
    df = flat_rows(spark, [{"event_id": "a", "user_name": None, "source_ip": "1.1.1.1",
                            "event_time": "2026-01-05 10:00:00"},
                           {"event_id": "b", "user_name": "u", "source_ip": "1.1.1.1",
                            "event_time": "2026-01-05 10:00:00"}])
    st = event_stats(df)
    f = FT.add_user_features(df, st)
    f = FT.add_network_features(f, st)
    got = by_id(f, "user_total_events", "is_new_user", "ip_event_count", "ip_unique_users")
    assert got["a"] == (None, 0, 2, 1)
    assert got["b"] == (1, 1, 2, 1)


def test_prepare_skips_static_settings(spark, monkeypatch):
    """Queries get the caller's session; static settings must not be touched."""
    from auditlake import session as S
    monkeypatch.setitem(S.SESSION_CONF, "spark.python.sql.dataFrameDebugging.enabled", "true")
    monkeypatch.setitem(S.SESSION_CONF, "spark.sql.session.timeZone", "UTC")
    S.prepare(spark)          # must not raise CANNOT_MODIFY_STATIC_CONFIG
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_exfiltration_flags_planted_burst(spark):
    from auditlake.operators import threats as TH
    rows = []
    for h in range(30):                       # one GetObject per hour for 30 hours
        rows.append({"event_id": f"n{h}", "user_name": "u", "event_name": "GetObject",
                     "event_time": f"2026-01-0{1 + h // 24} {h % 24:02d}:10:00"})
    for i in range(30):                       # then 30 in one hour
        rows.append({"event_id": f"b{i}", "user_name": "u", "event_name": "GetObject",
                     "event_time": f"2026-01-03 05:{i:02d}:00"})
    got = TH.exfiltration(flat_rows(spark, rows)).collect()
    assert [(str(r["hour_start"]), r["action_count"]) for r in got] == [("2026-01-03 05:00:00", 30)]


def test_duplicate_copies_get_one_gap(spark):
    rows = [{"event_id": "p", "event_time": "2026-01-05 10:00:00", "user_name": "u"}] + \
           [{"event_id": "dup", "event_time": "2026-01-05 10:00:05", "user_name": "u"}] * 3
    f = build_features(flat_rows(spark, rows))
    gaps = sorted(r["time_since_prev_event"] for r in f.where(F.col("event_id") == "dup").collect())
    assert gaps == [0.0, 0.0, 5.0]
    assert f.where(F.col("event_id") == "dup").select("user_events_this_hour").distinct().collect()[0][0] == 4


def test_time_text_parsing_rules(spark):
    vals = {"ok": "2026-01-05T14:30:00Z", "unpadded": "2026-1-5T1:2:3Z", "no_z": "2026-01-05T14:30:00",
            "space": "2026-01-05 14:30:00Z", "h24": "2026-01-05T24:00:00Z", "feb30": "2026-02-30T10:00:00Z",
            "frac": "2026-01-05T14:30:00.5Z", "short_year": "26-01-05T14:30:00Z"}
    df = spark.createDataFrame(list(vals.items()), "k string, s string")
    got = {r["k"]: r["t"] for r in df.select("k", C.parse_event_time("s").alias("t")).collect()}
    assert str(got["ok"]) == "2026-01-05 14:30:00" and str(got["unpadded"]) == "2026-01-05 01:02:03"
    assert all(got[k] is None for k in ["no_z", "space", "h24", "feb30", "frac", "short_year"])
