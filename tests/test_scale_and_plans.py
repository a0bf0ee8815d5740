"""Scale properties: plan shapes, partition invariance, skewed inputs."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from auditlake.operators import features as FT
from auditlake.operators import threats as TH
from auditlake.plans.features import build_features
from auditlake.sources.fixture import trail
from tests.conftest import SF001
from tests.helpers import flat_rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_plan_streams_events_through_broadcasts(spark):
    f = build_features(trail(spark, SF001))
    plan = _plan(f)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only the per-range summary (one row per bucket) may meet in one partition
            assert "HashAggregate(keys=[_bkt" in lines[i + 1], lines[i + 1]
    assert plan.count("BroadcastHashJoin") >= 6
    # the event scan is never shuffled: every Exchange sits on a lookup side
    assert "SortMergeJoin" not in plan


def test_partition_invariance(spark):
    fl = trail(spark, SF001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(tuple(r) for r in build_features(fl).drop("event_time").collect())
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = sorted(tuple(r) for r in build_features(fl).drop("event_time").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def _skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2026, 1, 5, 0, 0, 0)
    rows = []
    for i in range(n):
        if i % 3 == 0:           # a third of all rows share one timestamp and one user
            t, u = base, "hot"
        else:
            t, u = base + dt.timedelta(seconds=rnd.randint(0, 7200), microseconds=rnd.randint(0, 999999)), \
                f"u{rnd.randint(0, 20)}"
        if i % 97 == 0:
            t = None
        rows.append({"event_id": f"e{i:05d}", "event_time": t, "user_name": u,
                     "source_ip": "10.0.0.1", "event_name": "GetObject"})
    return rows


def test_global_gap_with_hot_ties_matches_brute_force(spark):
    rows = _skewed_rows()
    df = flat_rows(spark, rows)
    got = {r["event_id"]: r["time_since_prev_event"] for r in FT.time_since_previous(df).collect()}
    pdf = pd.DataFrame(rows)
    pdf = pdf.sort_values(["event_time", "event_id"], na_position="last").reset_index(drop=True)
    gaps = pdf["event_time"].diff().dt.total_seconds().fillna(0)
    want = dict(zip(pdf["event_id"], gaps))
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9, k


def test_rolling_hour_matches_brute_force(spark):
    rows = _skewed_rows(1200)
    df = flat_rows(spark, rows)
    got = {r["event_id"]: r["user_events_last_hour"] for r in TH.user_events_last_hour(df).collect()}
    pdf = pd.DataFrame(rows)
    for _, r in pdf.sample(60, random_state=1).iterrows():
        if r["event_time"] is None or pd.isna(r["event_time"]):
            assert got[r["event_id"]] is None
            continue
        same = pdf[(pdf.user_name == r.user_name) & pdf.event_time.notna()]
        lo = r.event_time - dt.timedelta(hours=1)
        want = int(((same.event_time >= lo) & (same.event_time <= r.event_time)).sum())
        assert got[r["event_id"]] == want


def test_lookup_falls_back_to_shuffle_join_when_too_big(spark):
    fl = trail(spark, SF001)
    want = sorted(tuple(r) for r in build_features(fl).drop("event_time").collect())
    old = spark.conf.get("auditlake.broadcast.maxBytes", None)
    try:
        spark.conf.set("auditlake.broadcast.maxBytes", "0")
        f = build_features(fl)
        plan = _plan(f)
        n = f.count()
        got = sorted(tuple(r) for r in f.drop("event_time").collect())
    finally:
        if old is None:
            spark.conf.unset("auditlake.broadcast.maxBytes")
        else:
            spark.conf.set("auditlake.broadcast.maxBytes", old)
    assert n == fl.count()
    assert got == want                       # same 59 columns either way
    assert plan.count("SortMergeJoin") >= 6 and "ShuffledHashJoin" not in plan
    for line in plan.splitlines():
        if "BroadcastHashJoin" in line:      # only the per-range summary (bounded rows)
            assert "[_bkt" in line, line


def test_exact_quantile_by_selection_matches_numpy(spark, monkeypatch):
    import numpy as np
    from auditlake.operators import ordered as O
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(size=4000), np.full(3000, 0.25)])   # a heavy tie
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    monkeypatch.setattr(O, "SELECT_FINAL_ROWS", 300)                        # force several rounds
    monkeypatch.setattr(O, "SELECT_BUCKETS", 8)
    for q in (0.1, 0.5, 0.9):
        got = O.exact_quantile(df, "x", q)
        assert abs(got - float(np.percentile(vals, q * 100))) < 1e-12, q


def test_ordered_operators_gather_only_range_summaries(spark):
    from auditlake.ml import evaluate as EV
    rows = _skewed_rows(600)
    df = flat_rows(spark, rows)
    scored = df.select((F.length("event_id") % 2).alias("y"),
                       F.unix_micros("event_time").cast("double").alias("s"))
    for plan_df in (EV.roc_auc(scored, "y", "s"), TH.user_events_last_hour(df),
                    FT.time_since_previous(df)):
        lines = _plan(plan_df).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = lines[i + 1]
                # a per-range summary, or the partial rows of a global aggregate (one per task)
                assert ("HashAggregate(keys=[_bkt" in below
                        or ("HashAggregate(keys=[]" in below and "partial_" in below)), below


def test_skewed_features_same_on_both_join_paths(spark):
    df = flat_rows(spark, _skewed_rows(1500))
    want = sorted(tuple(r) for r in build_features(df).drop("event_time").collect())
    old = spark.conf.get("auditlake.broadcast.maxBytes", None)
    try:
        spark.conf.set("auditlake.broadcast.maxBytes", "0")
        got = sorted(tuple(r) for r in build_features(df).drop("event_time").collect())
    finally:
        if old is None:
            spark.conf.unset("auditlake.broadcast.maxBytes")
        else:
            spark.conf.set("auditlake.broadcast.maxBytes", old)
    assert got == want


def test_threshold_is_one_path_at_all_sizes(spark, monkeypatch):
    import numpy as np
    from auditlake.ml import evaluate as EV
    from auditlake.operators import ordered as O
    rng = np.random.default_rng(9)
    vals = rng.normal(size=3000).round(2)
    df = spark.createDataFrame([(float(v),) for v in vals], "d double")
    small = EV.decision_stats(df, "d", 0.1)
    assert abs(small["offset"] - float(np.percentile(vals, 10))) < 1e-12
    monkeypatch.setattr(O, "SELECT_FINAL_ROWS", 200)              # more rounds, same answer
    monkeypatch.setattr(O, "SELECT_BUCKETS", 16)
    assert EV.decision_stats(df, "d", 0.1) == small


def test_quantile_with_infinities_nan_and_nulls(spark, monkeypatch):
    import pytest
    from auditlake.operators import ordered as O
    monkeypatch.setattr(O, "SELECT_FINAL_ROWS", 100)
    monkeypatch.setattr(O, "SELECT_BUCKETS", 6)
    inf = float("inf")
    ranked = [float(v) for v in range(300)] + [inf] * 200 + [-inf] * 5
    df = spark.createDataFrame([(v,) for v in [*ranked, float("nan"), None, None]], "x double")
    ordered = sorted(ranked)
    ks = [0, 5, 304, 504]
    assert O.kth_smallest(df, "x", ks) == {k: ordered[k] for k in ks}
    assert O.exact_quantile(df, "x", 0.9) == inf
    assert O.exact_quantile(df, "x", 0.25) == ordered[126]
    assert O.exact_quantile(df.where("x IS NULL"), "x", 0.5) is None
    with pytest.raises(ValueError):
        O.kth_smallest(df, "x", [505])


def test_same_features_when_the_input_comes_out_of_a_shuffle(spark):
    from tests.conftest import SF001
    from auditlake.sources.fixture import trail
    events = trail(spark, SF001)
    assert FT.is_scan(events)
    want = sorted(map(str, build_features(events).collect()))
    other = spark.createDataFrame([(k,) for k in range(3)], "k long")
    shuffled = {
        "dedup": events.dropDuplicates(["event_id"]),
        "repartition": events.repartition(7, "source_ip"),
        "join": events.join(other, F.pmod(F.xxhash64("event_id"), F.lit(3)) == F.col("k")).drop("k"),
    }
    conf = {"auditlake.broadcast.maxBytes": "0", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for name, df in shuffled.items():
        assert not FT.is_scan(df)
        assert sorted(map(str, build_features(df).collect())) == want, name
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert sorted(map(str, build_features(shuffled["dedup"]).collect())) == want
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_event_name_lookup_is_broadcast_by_its_own_rows(spark):
    """Many (user, event) pairs, few event names."""
    from auditlake.operators.event_stats import event_stats
    rows = [{"event_id": str(i), "event_time": f"2025-01-01 00:{i % 60:02d}:00", "user_name": f"u{i % 97}",
             "event_name": f"e{i % 5}", "source_ip": f"10.0.0.{i % 90}"} for i in range(900)]
    stats = event_stats(flat_rows(spark, rows))
    spark.conf.set("auditlake.broadcast.maxBytes", "2000")
    try:
        lookup, bound = stats.event_names()
        assert stats.rows["user_event"] > 400 and bound == 5
        assert stats.users()[1] == 97 and stats.ips()[1] == 90
    finally:
        spark.conf.unset("auditlake.broadcast.maxBytes")


def test_row_local_keys_run_no_statistics(spark):
    from auditlake.plans import queries as Q
    from tests.conftest import SF001
    for key in ("event_is_sensitive", "net_is_console", "sql_total_events", "sql_suspicious_ips"):
        plan = _plan(Q.registry()[key](spark, SF001))
        assert "event_stats" not in plan and plan.count("Scan parquet") == 1, key
