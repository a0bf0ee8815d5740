"""Isolation Forest: property checks (no library oracle is installed)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from auditlake.ml.forest import Forest, average_path_length, sample_trees, train
from auditlake.plans import detection as DET
from auditlake.plans.features import build_features
from auditlake.sources.fixture import trail
from tests.conftest import SF001


def _matrix(spark, n=600, outliers=6, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(0, 1, size=(n, 4))
    X[:outliers] += 8.0
    rows = [(f"e{i:04d}", [float(v) for v in X[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, features array<double>")


def test_average_path_length():
    c = average_path_length(np.array([0, 1, 2, 256]))
    assert c[0] == 0 and c[1] == 0 and c[2] == 1
    assert abs(c[3] - (2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256)) < 1e-9


def test_sample_is_deterministic_and_sized(spark):
    X = _matrix(spark)
    a = sample_trees(X, 600, trees=10, psi=64, seed=42)
    b = sample_trees(X.repartition(5), 600, trees=10, psi=64, seed=42)
    ca = a.groupBy("tree_id").count().collect()
    assert len(ca) == 10 and all(r["count"] == 64 for r in ca)
    key = lambda df: sorted((r["tree_id"], r["event_id"]) for r in df.select("tree_id", "event_id").collect())
    assert key(a) == key(b)


def test_identical_rows_are_drawn_one_by_one(spark):
    """A third of the table as one row: it takes about a third of every tree, never all or none."""
    rows = [(None, [0.0, 0.0])] * 1000 + [(None, [float(i), 1.0]) for i in range(2000)]
    X = spark.createDataFrame(rows, "event_id string, features array<double>")
    drawn = sample_trees(X, 3000, trees=12, psi=256)
    found = drawn.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("features")[1] == 0).alias("same")).collect()
    assert len(found) == 12 and all(r.n == 256 and 50 < r.same < 125 for r in found)
    assert len({r.same for r in found}) > 1


def test_equal_rows_beyond_one_chunk(spark, monkeypatch):
    from auditlake.ml import forest
    rows = [(None, [1.0])] * 500 + [("a", [2.0])]
    X = spark.createDataFrame(rows, "event_id string, features array<double>")
    want = sorted(map(str, sample_trees(X, 501, trees=5, psi=64).collect()))
    monkeypatch.setattr(forest, "COPIES", 7)
    assert sorted(map(str, sample_trees(X.repartition(6), 501, trees=5, psi=64).collect())) == want


def test_tree_of_rows_that_do_not_differ(spark):
    X = spark.createDataFrame([(f"e{i}", [1.0, 2.0]) for i in range(40)], "event_id string, features array<double>")
    nodes = train(sample_trees(X, 40, trees=3, psi=16), psi=16).toPandas()
    assert len(nodes) == 3 and (nodes["feature"] == -1).all() and (nodes["size"] == 16).all()
    assert X.select(Forest(nodes, 16).score(F.col("features")).alias("s")).distinct().count() == 1


def test_planted_outliers_rank_first(spark):
    X = _matrix(spark)
    nodes = train(sample_trees(X, 600, trees=50, psi=128, seed=42), seed=42, psi=128).toPandas()
    forest = Forest(nodes, 128)
    M = np.stack(X.toPandas()["features"].to_numpy())
    s = forest.score_samples(M)
    worst = set(np.argsort(s)[:6])
    assert worst == set(range(6))
    assert len(nodes.groupby("tree_id")) == 50
    assert nodes["depth"].max() <= 7


def test_detection_flags_contamination_share(spark):
    f = build_features(trail(spark, SF001))
    d = DET.detect(f, trees=30)
    p = DET.prediction_table(d)
    n = p.count()
    flagged = p.where(F.col("ml_anomaly_prediction") == 1).count()
    assert abs(flagged - 0.1 * n) <= 0.02 * n
    sc = p.agg(F.min("ml_anomaly_score"), F.max("ml_anomaly_score")).first()
    assert sc[0] == 0.0 and sc[1] == 100.0
    ev = d.evaluation().first()
    assert ev["true_positives"] + ev["false_positives"] == flagged


def test_one_class_svm_consensus_and_holdout(spark):
    f = build_features(trail(spark, SF001))
    d = DET.detect(f, trees=30)
    oc, model = DET.one_class_svm(d, epochs=3)
    n = oc.count()
    flagged = oc.where(F.col("ocsvm_prediction") == 1).count()
    assert n == d.n_rows
    assert abs(flagged - 0.1 * n) <= 0.03 * n          # offset set at the nu-quantile
    cons = DET.consensus(d).collect()
    assert all(r["consensus_prediction"] == r["forest_prediction"] * r["ocsvm_prediction"] for r in cons)
    h = DET.holdout_metrics(f, trees=30).first()
    assert h["n_train"] + h["n_test"] == f.count()
    assert h["true_positives"] + h["true_negatives"] + h["false_positives"] + h["false_negatives"] == h["n_test"]
    assert 0.0 <= h["roc_auc"] <= 1.0


def test_model_roundtrip_scores_identically(spark):
    from auditlake.session import scratch_path
    from auditlake.sources import sinks as K
    f = build_features(trail(spark, SF001))
    d = DET.detect(f, trees=20)
    path = K.save_model(spark, d.nodes, d.scaler, d.params, scratch_path(spark, "model-test"))
    forest, scaler, names, params = K.load_model(spark, path)
    assert names == d.names and params["n_estimators"] == 20
    M = np.stack(d.vectors().orderBy("event_id").toPandas()["features"].to_numpy())
    assert np.allclose(forest.score_samples(M), d.forest.score_samples(M), rtol=0, atol=0)
