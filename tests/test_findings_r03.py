"""Cost of the detector at size (findings of round 3): the work that grows with the table is done once."""

import numpy as np
from pyspark.sql import functions as F

from auditlake.functions import lists as L
from auditlake.ml import forest as FO
from auditlake.ml import importance, ocsvm
from auditlake.operators.features import is_scan
from auditlake.plans import detection as DET
from auditlake.plans.features import build_features
from auditlake.sources.fixture import trail
from tests.conftest import SF001


def small_forest(rng, rows=900, width=7, trees=9, psi=64):
    X = rng.normal(size=(rows, width))
    X[:, :3] = X[:, :3] > 0.8
    X[:, 3] = rng.integers(0, 4, rows)
    nodes = [n for t in range(trees) for n in FO._grow(X[rng.choice(rows, psi, replace=False)], 5, 6, t)]
    return X, FO.Forest(FO.pd.DataFrame(nodes, columns=FO.NODE_SCHEMA.names), psi)


def test_permuted_features_are_scored_in_one_walk(monkeypatch):
    """one walk gives what a scoring of every permuted matrix gives, to the bit."""
    rng = np.random.default_rng(11)
    X, forest = small_forest(rng)
    X[5, 2], X[6, 5] = np.nan, np.inf
    P = np.column_stack([rng.permutation(c) for c in X.T])
    want = []
    for j in range(X.shape[1]):
        Y = X.copy()
        Y[:, j] = P[:, j]
        want.append(forest.score_samples(Y))
    base = forest.score_samples(X)
    monkeypatch.setattr(FO.Forest, "score_samples", None)           # a matrix a feature is never scored
    got_base, got = importance.scores_of_permuted(forest, X, P)
    assert np.array_equal(got_base, base) and np.array_equal(got, np.column_stack(want))
    assert any((w != base).any() for w in want)
    one = forest.permuted_scores(X[:1], X[:1])
    assert np.array_equal(one[1], np.repeat(one[0][:, None], X.shape[1], axis=1))
    assert forest.permuted_scores(X[:0], P[:0])[1].shape == (0, X.shape[1])


def test_rows_of_one_hash_are_ordered_by_content(spark, monkeypatch):
    rows = [("a", [float(i % 2), 0.0, float(i % 7) - 3, float(i % 3)]) for i in range(60)] + [("b", [1.0, 0.0, 2.0, 2.0])] * 40
    _, forest = small_forest(np.random.default_rng(2), width=4)
    df = spark.createDataFrame(rows, "event_id string, features array<double>")
    one, two = (importance.permutation_importance(d, ["w", "x", "y", "z"], forest).collect() for d in (df, df.orderBy(F.desc("event_id"))))
    assert one == two and sum(r.importance for r in one) > 0


def test_features_are_written_once_and_scores_without_them(spark, monkeypatch):
    """One wide table is written; scores go with ids and labels alone."""
    wide = []
    write = DET.materialize

    def counted(df, name, **metrics):
        wide.append(name) if len(df.columns) > 30 else None
        return write(df, name, **metrics)

    monkeypatch.setattr(DET, "materialize", counted)
    table = build_features(trail(spark, SF001))
    d = DET.detect(table, trees=10)
    assert wide == ["features"]
    assert d.scored.columns == ["event_id", "is_anomaly_original", "_score_samples"] and is_scan(d.scored)
    cols = ["event_id", "ml_anomaly_prediction", "ml_anomaly_score", "ml_severity"]
    whole, narrow = (sorted(map(tuple, df.select(*cols).collect())) for df in (DET.prediction_table(d), d.decisions))
    assert whole == narrow and len(whole) == d.n_rows
    assert DET.prediction_table(d).columns == table.columns + cols[1:]
    wide.clear()
    DET.holdout_metrics(table, trees=5)
    assert wide == ["holdout-features"]


def test_quantile_of_the_one_class_svm_reads_written_scores(spark, monkeypatch):
    """every round of the quantile scans stored numbers; no row is embedded for it again."""
    stored = []
    quantile = ocsvm.exact_quantile
    monkeypatch.setattr(ocsvm, "exact_quantile", lambda df, c, q: stored.append(is_scan(df)) or quantile(df, c, q))
    rows = [(f"e{i}", [float(i % 11), float(i % 5)]) for i in range(500)]
    X = spark.createDataFrame(rows, "event_id string, features array<double>")
    ocsvm.fit(X, 2, 500, components=16, epochs=2)
    assert stored == [True]


def test_whole_numbers_are_cleaned_without_checks_for_nan(spark):
    df = spark.createDataFrame([(None, None, 7), (3, float("nan"), 8), (2**40, float("-inf"), 9)], "a long, b double, c int")
    rows = [tuple(r.features) for r in df.select(DET.vector(["a", "b", "c"], df.schema)).collect()]
    assert rows == [(0.0, 0.0, 7.0), (3.0, 0.0, 8.0), (float(2**40), 0.0, 9.0)]
    assert "isnan" not in DET.vector(["a", "c"], df.schema)._jc.toString().lower()
    assert len(L.ML_FEATURES) > 30
