"""Publication under one manifest, and a hold-out that sees nothing of the part it is judged on."""

import pytest
from pyspark.sql import functions as F

from auditlake.functions import lists as L
from auditlake.operators import fitted
from auditlake.operators import summaries as SM
from auditlake.operators.event_stats import event_stats
from auditlake.plans import detection as DET
from auditlake.plans import queries as Q
from auditlake.plans import stored
from auditlake.plans.features import build_features
from auditlake.session import scratch_path
from auditlake.sources import publish as PB
from auditlake.sources import sinks as K
from auditlake.sources import variant as V
from auditlake.sources.fixture import trail

SMALL = "/root/testdata/sf0.001"


def zones(spark, part):
    table, found = Q.build_and_decide(part)
    landing = scratch_path(spark, "landing")
    stored.land(part, landing)
    doc = found.agg(F.count(F.lit(1)).alias("total_events"), F.coalesce(F.sum("ml_anomaly_prediction"), F.lit(0)).alias("anomalies"))
    return {"raw": V.read_variant_events(spark, landing, multi_line=False), "features": table, "predictions": found,
            "feature_summary": K.feature_summary_document(SM.feature_summary(table)), "detection_summary": doc}


def test_a_run_is_published_whole_or_not_at_all(spark, monkeypatch):
    rows, base = trail(spark, SMALL).limit(300).checkpoint(), scratch_path(spark, "published")
    assert PB.manifest(spark, base).count() == 0
    with pytest.raises(LookupError):
        PB.read_zone(spark, base, "features")
    first = zones(spark, rows.where(F.col("event_id").cast("long") % 3 == 0))
    assert PB.publish(spark, base, first) == 1
    held = PB.manifest(spark, base).collect()
    second = zones(spark, rows)
    with monkeypatch.context() as broken:       # dies between the zones
        broken.setattr(K, "write_one_row_json", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            PB.publish(spark, base, second)
    assert PB.manifest(spark, base).collect() == held
    assert PB.read_zone(spark, base, "features").count() == first["features"].count()
    assert PB.publish(spark, base, second) == 2
    assert {r.zone: r.rows for r in PB.verify(spark, base).collect()} == {
        "raw": 300, "features": 300, "predictions": 300, "feature_summary": 1, "detection_summary": 1}
    assert PB.manifest(spark, base, 1).collect() == held and PB.read_zone(spark, base, "raw", 1).count() == held[0].rows
    # rows that change after the commit are found
    path = next(r.path for r in PB.manifest(spark, base).collect() if r.zone == "predictions")
    spark.read.parquet(f"{base}/{path}").limit(1).write.mode("append").partitionBy("event_date").parquet(f"{base}/{path}")
    assert {r.zone for r in PB.verify(spark, base).where("NOT intact").collect()} == {"predictions"}
    with pytest.raises(ValueError):
        PB.publish(spark, base, {"raw": second["raw"]})


def test_empty_run(spark):
    base = scratch_path(spark, "published")
    none = trail(spark, SMALL).where("false")
    assert PB.publish(spark, base, zones(spark, none)) == 1
    assert all(r.intact for r in PB.verify(spark, base).collect())


def test_later_events_change_no_earlier_feature(spark):
    flat = trail(spark, SMALL)
    earlier, later = fitted.split_by_time(flat)
    train, test = DET.holdout_features(flat)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert earlier.count() + later.count() == flat.count() and 0 < later.count() <= 0.2 * flat.count()
    assert earlier.agg(F.max("event_time")).first()[0] < later.agg(F.min("event_time")).first()[0]
    assert rows(train) == rows(build_features(earlier))
    # nor do other later events change a later event's key counts
    some = later.where(F.col("event_id").cast("long") % 4 == 0)
    columns = ["event_id", *[c for counts in fitted.KEY_COUNTS.values() for c in counts]]
    alone = build_features(some, stats=fitted.applied(event_stats(earlier), some)).select(columns)
    assert rows(alone) == rows(test.where(F.col("event_id").cast("long") % 4 == 0).select(columns))


def test_unseen_and_null_keys(spark):
    flat = trail(spark, SMALL)
    one = flat.limit(1).withColumn("event_name", F.lit("NeverSeen"))
    new = one.withColumns({"user_name": F.lit("nobody yet"), "source_ip": F.lit(None).cast("string")}).checkpoint()
    row = build_features(new, stats=fitted.applied(event_stats(flat), new)).first()
    assert (row.user_total_events, row.user_error_rate, row.user_activity_diversity, row.is_new_user) == (0, 0.0, 0.0, 1)
    assert (row.event_type_frequency, row.is_rare_event, row.ip_event_count, row.is_shared_ip) == (0, 1, None, 0)
    gone = one.withColumn("user_name", F.lit(None).cast("string")).checkpoint()
    row = build_features(gone, stats=fitted.applied(event_stats(flat), gone)).first()
    assert (row.user_total_events, row.user_error_rate, row.is_new_user) == (None, None, 0)


def test_holdout_by_time(spark):
    flat = trail(spark, SMALL)
    row = DET.holdout_by_time(flat, trees=20).first()
    assert row.n_train + row.n_test == flat.count()
    assert row.true_positives + row.true_negatives + row.false_positives + row.false_negatives == row.n_test
    assert L.CONTAMINATION > 0 and 0 <= row.roc_auc <= 1
    none, untimed = fitted.split_by_time(flat.where("false")), fitted.split_by_time(flat.withColumn("event_time", F.lit(None).cast("timestamp")))
    assert none[1].count() == 0 and untimed[1].count() == 0 and untimed[0].count() == flat.count()
