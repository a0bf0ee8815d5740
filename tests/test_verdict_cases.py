"""Legal but awkward inputs: empty tables, missing labels, null ids, text that CSV must quote."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlake.ml import evaluate as EV
from auditlake.ml import ocsvm
from auditlake.ml.forest import sample_trees
from auditlake.ml.importance import permutation_importance
from auditlake.operators.threats import privilege_escalation
from auditlake.plans import catalog, detection, queries
from auditlake.plans.features import build_features
from auditlake.session import scratch_path
from auditlake.sources import sinks
from auditlake.sources.fixture import trail
from auditlake.streaming import ingest
from tests.conftest import SF001
from tests.helpers import flat_rows


def matrix(spark, n, parts, features=4, outliers=0):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(n, features))
    rows[:outliers] += 6
    data = [(f"e{i}", [float(x) for x in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "event_id string, features array<double>").repartition(parts)


@pytest.mark.parametrize("key", ["features_full", "sql_total_events", "sql_top_users", "sink_features", "ml_threshold_flag",
                                 "ml_roc_auc", "ml_confusion", "sink_parsed_csv", "alerts_high_severity", "stream_minute_counts",
                                 "stream_flatten", "user_total_events", "temp_time_since_prev", "user_events_last_hour",
                                 "threat_exfiltration", "stored_top_users", "feature_summary"])
def test_empty_events(spark, tmp_path, key):
    spark.read.parquet(f"{SF001}/events.parquet").limit(0).write.parquet(os.path.join(tmp_path, "events.parquet"))
    want = queries.registry()[key](spark, SF001)
    got = queries.registry()[key](spark, str(tmp_path))
    assert got.columns == want.columns
    assert len(got.collect()) <= 1


class Steep:
    """A forest stand-in whose score is the first feature."""

    def score_samples(self, rows):
        return rows[:, 0]


def test_importance_does_not_depend_on_batches(spark):
    rows = [(f"e{i:06d}", [i / 20000, 1.0]) for i in range(20000)]
    df = spark.createDataFrame(rows, "event_id string, features array<double>")
    found = []
    for parts, batch in ((1, 10000), (8, 10000), (3, 700)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        found.append([tuple(r) for r in permutation_importance(df.repartition(parts), ["a", "b"], Steep()).collect()])
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] == found[2]
    assert abs(dict(found[0])["a"] - 1 / 3) < 0.01 and dict(found[0])["b"] == 0


def test_one_class_svm_does_not_depend_on_partitions(spark):
    models = [ocsvm.fit(matrix(spark, 2000, parts, outliers=20), 4, 2000, nu=0.05, components=512) for parts in (1, 8)]
    assert np.array_equal(models[0].w, models[1].w) and models[0].rho == models[1].rho
    df = matrix(spark, 2000, 4, outliers=20)
    lowest = df.select("event_id", models[0].raw_udf()("features").alias("s")).orderBy("s").limit(20).collect()
    planted = {f"e{i}" for i in range(20)}
    assert len({r.event_id for r in lowest} & planted) >= 18


def test_forest_sample_of_rows_without_ids(spark):
    df = matrix(spark, 3000, 4).withColumn("event_id", F.lit(None).cast("string"))
    sizes = [r["count"] for r in sample_trees(df, 3000, 10, 64).groupBy("tree_id").count().collect()]
    assert sizes == [64] * 10


def test_auc_of_counts_beyond_a_long(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (1, 0.05)], "y int, s double")
    assert EV.roc_auc(df, "y", "s").first()["roc_auc"] == 0.5
    big = spark.createDataFrame([(4_000_000_000, 0, 0.1), (0, 4_000_000_000, 0.9)], "neg long, pos long, _s double")
    area = big.agg(F.sum(F.col("pos").cast("double") * F.lit(4_000_000_000)).alias("u")).first()["u"]
    assert area == 1.6e19


def test_detection_without_labels(spark):
    events = trail(spark, SF001).drop("is_anomaly_original", "anomaly_type_original").withColumns(
        {"is_anomaly_original": F.lit(None).cast("boolean"), "anomaly_type_original": F.lit(None).cast("string")})
    table = build_features(events).drop("is_anomaly_original")
    summary = detection.summary_frame(spark, detection.detect(table, trees=5)).first()
    assert summary["model"] == "Isolation Forest"


def test_csv_round_trip_is_exact(spark):
    from auditlake.operators.parse import parse_events
    from auditlake.sources.raw import flat_to_raw
    awkward = [" outer ", "two\nlines", 'a "quoted", text', "", None, "back\\slash", "\r\n", '""', "'"]
    rows = [{"event_id": f"e{i}", "event_time": "2025-01-01 10:00:00", "event_name": t, "user_name": t, "error_message": t,
             "source_ip": t} for i, t in enumerate(awkward)]
    parsed = parse_events(flat_to_raw(flat_rows(spark, rows)))
    back = sinks.read_parsed_csv(spark, sinks.write_parsed_csv(parsed, scratch_path(spark, "csv")), parsed)
    assert sorted(map(str, back.collect())) == sorted(map(str, parsed.collect()))
    assert sinks.read_parsed_csv(spark, sinks.write_parsed_csv(parsed.limit(0), scratch_path(spark, "csv")), parsed).count() == 0


def test_every_attach_policy_action_is_flagged(spark):
    names = ["AttachUserPolicy", "AttachRolePolicy", "AttachGroupPolicy", "AttachVolume", "DetachUserPolicy", "CreateUser"]
    df = flat_rows(spark, [{"event_id": n, "event_name": n} for n in names])
    assert {r.event_id for r in privilege_escalation(df).collect()} == {names[0], names[1], names[2], names[5]}


def test_alerts_without_ids_are_kept(spark):
    schema = "event_id string, event_time timestamp, user_name string, parser_risk_level string"
    path = scratch_path(spark, "alert-source")
    rows = [(None, f"u{i}", "high") for i in range(4)] + [("a", "u", "high"), ("a", "u", "high"), ("b", "u", "low")]
    spark.createDataFrame(rows, "event_id string, user_name string, parser_risk_level string").select(
        "event_id", F.lit("2025-01-01 00:00:00").cast("timestamp").alias("event_time"), "user_name", "parser_risk_level").write.parquet(path)
    stream = ingest.alerts(spark.readStream.schema(schema).parquet(path))
    out = ingest.read_batches(spark, ingest.run_foreach_batch(stream, "alerts-test"), stream)
    assert sorted(str(r.event_id) for r in out.collect()) == ["None"] * 4 + ["a"]


def test_report_texts_run_on_the_stored_table(spark):
    features = build_features(trail(spark, SF001))
    name = catalog.store_events(features, scratch_path(spark, "events"))
    for report in catalog.list_queries():
        want = catalog.run_query(spark, report, features)
        got = spark.sql(catalog.get_query(report, name))
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), report
    assert catalog.get_query("nothing") is None
