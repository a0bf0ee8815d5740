"""Anomaly-detection plan (M1-M12, K5-K7): features -> forest -> predictions.

Jobs: one write of the feature table (row count observed), one aggregate for scaler
statistics, one sampling + training job (bounded groups), one write of the scores with ids and
labels (min and max observed during the write), one single-column percentile. The forest is
collected (a bounded node table) and travels with the scoring UDF. It takes the
features in their own units; the One-Class SVM takes them scaled. The wide table is
written once: whoever wants all columns with their scores has the rows scored on the way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions import lists as L
from auditlake.ml import evaluate as EV
from auditlake.ml import prepare as PR
from auditlake.ml.forest import Forest, sample_trees, train
from auditlake.ml.importance import permutation_importance
from auditlake.operators.event_stats import event_stats
from auditlake.operators.fitted import applied, split_by_time
from auditlake.operators.lookup import materialize
from auditlake.plans.features import build_features


@dataclass
class Detection:
    predictions: DataFrame        # features + ml_anomaly_prediction, ml_anomaly_score, ml_severity
    decisions: DataFrame          # the same for event_id and label alone, from the written scores
    table: DataFrame              # written features
    scored: DataFrame             # written scores: event_id, label, _score_samples
    nodes: pd.DataFrame
    forest: Forest
    names: list
    scaler: dict
    offset: float
    n_rows: int
    params: dict = field(default_factory=dict)

    def matrix(self) -> DataFrame:
        """event_id + scaled feature vector of the scored rows."""
        return self.table.select("event_id", scaled_vector(self.names, self.scaler, self.table.schema))

    def vectors(self) -> DataFrame:
        """event_id + feature vector in the features' own units, as the forest takes it."""
        return self.table.select("event_id", vector(self.names, self.table.schema))

    def evaluation(self) -> DataFrame:
        y = PR.ground_truth(self.scored)
        if y is None:                  # without labels there is nothing to evaluate
            return self.scored.sparkSession.createDataFrame([], "accuracy double")
        lab = self.decisions.select(y.alias("y"), "ml_anomaly_prediction")
        return EV.metrics_from_confusion(EV.confusion(lab, "y", "ml_anomaly_prediction"))

    def roc_auc(self) -> DataFrame:
        y = PR.ground_truth(self.scored)
        if y is None:
            return self.scored.sparkSession.createDataFrame([], "roc_auc double")
        df = self.decisions.select(y.alias("y"), F.col("_score_raw"))
        return EV.roc_auc(df, "y", "_score_raw")


def cleaned(names: list[str], schema: T.StructType) -> list:
    return [PR.clean(c, schema[c].dataType) for c in names]


def vector(names: list[str], schema: T.StructType, out: str = "features"):
    return F.array(*cleaned(names, schema)).alias(out)


def scaled_vector(names: list[str], scaler: dict, schema: T.StructType, out: str = "features"):
    cols = []
    for c, x in zip(names, cleaned(names, schema)):
        mean, std = scaler[c]
        cols.append((x - F.lit(mean)) / F.lit(std) if std > 0 else F.lit(0.0))
    return F.array(*cols).alias(out)


def detect(features: DataFrame, trees: int = L.FOREST_TREES, psi: int = L.FOREST_SAMPLE,
           seed: int = L.FOREST_SEED, contamination: float = L.CONTAMINATION, written: bool = False) -> Detection:
    """`written`: the features are (rows of) a written table already."""
    names = [c for c in L.ML_FEATURES if c in features.columns]
    # 1) write the feature table once (row count observed), then one pass over
    #    the cleaned model columns of the written table for the scaler statistics
    table, n = (features, features.count()) if written else _written(features)
    scaler = PR.scaler_stats(table.select(*[x.alias(c) for c, x in zip(names, cleaned(names, table.schema))]), names)
    psi_eff = max(1, min(psi, n))

    # 2) sample and grow the trees (bounded groups), collect the bounded node table
    X = table.select("event_id", vector(names, table.schema))
    nodes = train(sample_trees(X, n, trees, psi, seed, width=len(names)), seed, psi_eff, trees=trees).toPandas()
    forest = Forest(nodes, psi_eff)

    # 3) score every row once, written without the features; min and max observed in the same job
    with_score = table.withColumn("_score_samples", forest.score(vector(names, table.schema)))
    label = [c for c in ("is_anomaly_original",) if c in table.columns]
    scored, m = materialize(with_score.select("event_id", *label, "_score_samples"), "scored",
                            smin=F.min("_score_samples"), smax=F.max("_score_samples"))
    # 4) the contamination quantile of the written scores (one column)
    st = EV.decision_stats(scored.select("_score_samples"), "_score_samples", contamination)
    offset = float(st["offset"]) if st["offset"] is not None else 0.0
    dmin = None if m.get("smin") is None else float(m["smin"]) - offset
    dmax = None if m.get("smax") is None else float(m["smax"]) - offset

    def decided(df: DataFrame) -> DataFrame:
        pred = df.withColumn("_decision", F.col("_score_samples") - F.lit(offset))
        return (pred.withColumn("ml_anomaly_prediction", EV.flag("_decision", 0.0))
                .withColumn("_score_raw", EV.minmax_score("_decision", dmin, dmax))
                .withColumn("ml_anomaly_score", F.bround("_score_raw", 2))
                .withColumn("ml_severity", EV.severity("ml_anomaly_score")))

    params = {"n_estimators": trees, "contamination": contamination, "random_state": seed,
              "max_samples": psi_eff}
    return Detection(decided(with_score), decided(scored), table, scored, nodes, forest, names, scaler, offset, n, params)


def _written(features: DataFrame) -> tuple[DataFrame, int]:
    table, row = materialize(features, "features", n=F.count(F.lit(1)))
    return table, int(row["n"] or 0)


def prediction_table(d: Detection) -> DataFrame:
    return d.predictions.drop("_score_samples", "_decision", "_score_raw")


def importance(d: Detection, seed: int = L.FOREST_SEED) -> DataFrame:
    return permutation_importance(d.vectors(), d.names, d.forest, seed, n_rows=d.n_rows)


def summary_frame(spark: SparkSession, d: Detection, top: int = 10) -> DataFrame:
    """K7: one row with model name, parameters, metrics and the top features."""
    ev = d.evaluation().first()
    auc = d.roc_auc().first()
    imp = importance(d).limit(top).collect()
    m = ev.asDict() if ev else {}
    if auc:
        m["roc_auc"] = float(auc["roc_auc"])
    row = {
        "model": "Isolation Forest",
        "parameters": {k: float(v) if isinstance(v, float) else int(v) for k, v in d.params.items()},
        "metrics": m,
        "top_features": [{"feature": r["feature"], "importance": round(float(r["importance"]), 4)}
                         for r in imp],
    }
    import json
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(row)]))


# ------------------------------------------------------------------ D11-D13
def one_class_svm(d: Detection, nu: float = L.CONTAMINATION, seed: int = L.FOREST_SEED,
                  epochs: int = 6) -> tuple[DataFrame, object]:
    """One-Class SVM (random Fourier features) on the detector's scaled
    matrix; returns event_id, decision, prediction (1 = outlier)."""
    from auditlake.ml.ocsvm import fit
    X = d.matrix()
    model = fit(X, len(d.names), d.n_rows, nu=nu, seed=seed, epochs=epochs)
    dec = model.raw_udf()(F.col("features")) - F.lit(model.rho)
    out = X.select("event_id", dec.alias("ocsvm_decision"))
    return out.withColumn("ocsvm_prediction", EV.flag("ocsvm_decision", 0.0)), model


def consensus(d: Detection, nu: float = L.CONTAMINATION, seed: int = L.FOREST_SEED) -> DataFrame:
    """Flag only what both models flag (one projection of the scored table,
    no join between the two models' outputs)."""
    from auditlake.ml.ocsvm import fit
    model = fit(d.matrix(), len(d.names), d.n_rows, nu=nu, seed=seed)
    oc = model.raw_udf()(scaled_vector(d.names, d.scaler, d.table.schema)) - F.lit(model.rho)
    both = d.predictions.select("event_id", EV.flag("_decision", 0.0).alias("forest_prediction"),
                                F.when(oc < 0, 1).otherwise(0).alias("ocsvm_prediction"))
    return both.withColumn("consensus_prediction",
                           (F.col("forest_prediction") * F.col("ocsvm_prediction")).cast("int"))


def holdout_metrics(features: DataFrame, test_share: float = 0.2, seed: int = L.FOREST_SEED,
                    trees: int = L.FOREST_TREES) -> DataFrame:
    """Fit on a hash split of the events, evaluate on the held-out rest. The
    feature table is written once and read by both; its whole-table counts
    (per user, event, address) cover both parts, as in the in-sample run."""
    features, _ = materialize(features, "holdout-features")
    is_test = F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(1000)) < F.lit(int(test_share * 1000))
    return judged(features.where(~is_test), features.where(is_test), seed, trees, written=True)


def holdout_by_time(flat: DataFrame, test_percent: int = 20, seed: int = L.FOREST_SEED,
                    trees: int = L.FOREST_TREES) -> DataFrame:
    """D13 without a leak: fit on the earlier events, evaluate on the later ones, whose
    key counts, scaling and threshold all come from the earlier part."""
    train, test = holdout_features(flat, test_percent)
    return judged(train, test, seed, trees)


def holdout_features(flat: DataFrame, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """Feature tables of the earlier and the later events (`fitted.split_by_time`)."""
    earlier, later = split_by_time(flat, test_percent)
    fit = event_stats(earlier)
    return build_features(earlier, stats=fit), build_features(later, stats=applied(fit, later))


def judged(train: DataFrame, test: DataFrame, seed: int, trees: int, written: bool = False) -> DataFrame:
    """Metrics on `test` of a detector fitted on `train`."""
    d = detect(train, trees=trees, seed=seed, written=written)
    y = PR.ground_truth(test)
    s = d.forest.score(vector(d.names, test.schema))
    scored, m = materialize(test.select((y if y is not None else F.lit(0)).alias("y"), s.alias("_s")),
                            "holdout", n=F.count(F.lit(1)))
    scored = scored.select("y", F.when(F.col("_s") < F.lit(d.offset), 1).otherwise(0).alias("pred"),
                           (-F.col("_s")).alias("anomaly_score"))
    metrics = EV.metrics_from_confusion(EV.confusion(scored, "y", "pred"))
    auc = EV.roc_auc(scored, "y", "anomaly_score").first()["roc_auc"]
    return metrics.select("*", F.lit(auc).alias("roc_auc"),
                          F.lit(d.n_rows).cast("bigint").alias("n_train"),
                          F.lit(int(m["n"] or 0)).cast("bigint").alias("n_test"))
