"""Decision threshold, 0-100 score, severity and evaluation.

All of them work on any `decision` column (higher = more normal), so they can
be checked exactly against SQL with a rule score as well as used with the
forest. Whole-table quantities (percentile, min, max, class counts) are single
aggregates; ROC AUC uses distinct scores and a range-bucketed running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.functions import lists as L
from auditlake.operators.lookup import materialize
from auditlake.operators.ordered import exact_quantile, prefix_sums_over_unique


def decision_stats(df: DataFrame, decision: str, contamination: float = L.CONTAMINATION) -> dict:
    """Offset (the contamination quantile, linear interpolation), min, max and rows. The
    quantile comes from distributed selection (`exact_quantile`) at every table size."""
    row = df.agg(F.min(decision).alias("dmin"), F.max(decision).alias("dmax"), F.count(decision).alias("n")).first()
    offset = exact_quantile(df, decision, contamination) if row["n"] else None
    return {"offset": offset, "dmin": row["dmin"], "dmax": row["dmax"], "n": row["n"]}


def flag(decision: str, offset: float) -> Column:
    """1 = anomaly when the decision falls below the offset."""
    return C.flag(F.col(decision) - F.lit(offset) < 0)


def minmax_score(decision: str, dmin: float, dmax: float) -> Column:
    """(1 - (d - min) / (max - min)) * 100, unrounded; null when max = min."""
    span = F.lit(dmax) - F.lit(dmin) if dmin is not None and dmax is not None else F.lit(None)
    frac = F.try_divide(F.col(decision) - F.lit(dmin), span)
    return (F.lit(1.0) - frac) * F.lit(100.0)


def severity(score_rounded: str) -> Column:
    return C.severity(score_rounded)


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """tn, fp, fn, tp in one aggregate."""
    yc, pc = F.col(y), F.col(pred)
    return df.agg(
        F.count_if((yc == 0) & (pc == 0)).alias("true_negatives"),
        F.count_if((yc == 0) & (pc == 1)).alias("false_positives"),
        F.count_if((yc == 1) & (pc == 0)).alias("false_negatives"),
        F.count_if((yc == 1) & (pc == 1)).alias("true_positives"))


def metrics_from_confusion(cm: DataFrame) -> DataFrame:
    tp, tn = F.col("true_positives"), F.col("true_negatives")
    fp, fn = F.col("false_positives"), F.col("false_negatives")
    z = F.lit(0.0)
    acc = F.coalesce(F.try_divide((tp + tn).cast("double"), tp + tn + fp + fn), z)
    prec = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), z)
    rec = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), z)
    out = cm.select("*", acc.alias("_a"), prec.alias("_p"), rec.alias("_r"))
    f1 = F.when(F.col("_p") + F.col("_r") > 0,
                F.lit(2.0) * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))).otherwise(z)
    return out.select(F.round("_a", 4).alias("accuracy"), F.round("_p", 4).alias("precision"),
                      F.round("_r", 4).alias("recall"), F.round(f1, 4).alias("f1_score"),
                      "true_positives", "true_negatives", "false_positives", "false_negatives")


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve (ties count one half); 0 when a class is absent.

    Equal scores collapse in a partial aggregate, the running count of
    negatives below each distinct score comes from the range-bucketed prefix
    sum, and the area is a final sum: no single-partition sort of the rows.
    """
    per_score = (df.where(F.col(score).isNotNull())
                 .groupBy(F.col(score).alias("_s"))
                 .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")))
    per_score, _ = materialize(per_score, "per-score")      # read by the cuts, the ranges and their totals
    cum = prefix_sums_over_unique(per_score, "_s", ["neg"], inclusive=False)
    pos = F.col("pos").cast("double")      # products of counts exceed a long
    area = cum.agg(
        F.sum(pos * F.col("cum_neg") + F.lit(0.5) * pos * F.col("neg")).alias("_u"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                 F.col("_u") / (F.col("_p").cast("double") * F.col("_n"))).otherwise(F.lit(0.0))
    return area.select(F.round(auc, 4).alias("roc_auc"))


def severity_distribution(pred: DataFrame, prediction: str = "ml_anomaly_prediction",
                          sev: str = "ml_severity") -> DataFrame:
    from auditlake.operators.summaries import level_distribution
    flagged = pred.where(F.col(prediction) == 1)
    return level_distribution(flagged, sev, L.SEVERITY_ORDER, out_col="severity").drop("pct")


def final_summary(pred: DataFrame, prediction: str = "ml_anomaly_prediction") -> DataFrame:
    agg = pred.agg(F.count(F.lit(1)).alias("total_events"),
                   F.count_if(F.col(prediction) == 1).alias("predicted_anomaly"))
    pct = lambda c: F.round(F.coalesce(F.try_divide(F.col(c) * F.lit(100.0), F.col("total_events")), F.lit(0.0)), 6)
    return (agg.withColumn("predicted_normal", F.col("total_events") - F.col("predicted_anomaly"))
            .select("total_events", "predicted_normal", "predicted_anomaly",
                    pct("predicted_normal").alias("normal_pct"), pct("predicted_anomaly").alias("anomaly_pct")))


def top_risk_events(pred: DataFrame, k: int = 5, score: str = "ml_anomaly_score") -> DataFrame:
    return (pred.orderBy(F.desc_nulls_last(score), F.asc("event_id"))
            .select("user_name", "event_name", "source_ip", score, "ml_severity").limit(k))
