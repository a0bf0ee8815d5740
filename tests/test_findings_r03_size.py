"""Cost of features, sample and model passes at size (F4 to F11 of round 3)."""

from pyspark.sql import functions as F

from auditlake.ml import forest as FO
from auditlake.ml import ocsvm
from auditlake.operators import lookup, ordered
from auditlake.operators.features import is_scan
from auditlake.plans.features import build_features
from auditlake.sources.fixture import trail
from tests.conftest import SF001


def test_rows_are_named_by_compiled_code_and_drawn_alike(spark, monkeypatch):
    """A known number of features needs no function over array elements, and groups of few copies
    that are looked through early give the same draws."""
    assert "lambda" not in FO.row_name(width=2)._jc.toString().lower()
    rows = [(None if i % 9 == 0 else f"e{i % 150}", [float(i % 5), (i % 3) / 7]) for i in range(400)] + [("x", [1.0, 2.0])] * 70
    X = spark.createDataFrame(rows, "event_id string, features array<double>").repartition(4)
    names = X.select(FO.row_name().alias("a"), FO.row_name(width=2).alias("b"))
    assert names.where("a <> b").count() == 0

    def drawn(**more):
        return sorted((r.tree_id, r.event_id or "", r.features) for r in FO.sample_trees(X, 470, trees=6, psi=8, **more).collect())

    got = drawn(width=2)
    monkeypatch.setattr(FO, "FEW_COPIES", 0)
    assert got == drawn() and len(got) == 48


def test_gaps_come_back_by_row_id(spark):
    spark.conf.set("auditlake.broadcast.maxBytes", "0")
    try:
        plan = build_features(trail(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("auditlake.broadcast.maxBytes")
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and not any("event_id" in line for line in joins)


def test_neighbouring_ranks_share_their_rounds(spark, monkeypatch):
    cut = []
    cuts = ordered.range_cuts
    monkeypatch.setattr(ordered, "SELECT_FINAL_ROWS", 20)
    monkeypatch.setattr(ordered, "SELECT_BUCKETS", 8)
    monkeypatch.setattr(ordered, "range_cuts", lambda df, *a, **k: cut.append(1) or cuts(df, *a, **k))
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    assert ordered.kth_smallest(df, "v", [500]) == {500: 500.0}
    once = len(cut)
    cut.clear()
    assert ordered.kth_smallest(df, "v", [499, 500]) == {499: 499.0, 500: 500.0}
    assert len(cut) < 2 * once


def test_passes_of_the_one_class_svm_read_a_written_matrix(spark, monkeypatch):
    """every epoch scans stored vectors."""
    stored = []
    sums = ocsvm.violation_sums
    monkeypatch.setattr(ocsvm, "violation_sums", lambda X, *a: stored.append(is_scan(X)) or sums(X, *a))
    X = spark.createDataFrame([(f"e{i}", [float(i % 11), float(i % 5)]) for i in range(200)], "event_id string, features array<double>")
    ocsvm.fit(X, 2, 200, components=16, epochs=2)
    assert stored == [True] * 3


def test_counted_lookups_have_a_budget_of_their_own(spark):
    schema = spark.createDataFrame([], "a long").schema
    rows = (20 << 20) // lookup.estimated_row_bytes(schema)
    assert lookup.fits_broadcast(spark, schema, rows) and not lookup.fits_broadcast(spark, schema, 4 * rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not lookup.fits_broadcast(spark, schema, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
