"""Model inputs: feature selection, labels, standard scaling (M1-M3)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions import lists as L


def clean(c: str, kind: T.DataType | None = None) -> Column:
    """Feature value as DOUBLE with null, NaN and +-inf replaced by 0. A whole number is never
    NaN or infinite: where the type is known, its code is short enough to be compiled."""
    x = F.col(c).cast("double")
    if isinstance(kind, T.IntegralType):
        return F.coalesce(x, F.lit(0.0))
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return F.when(bad, F.lit(0.0)).otherwise(x)


def rows_of(lists: pa.Array) -> np.ndarray:
    """Feature lists of equal length as a matrix, a row each."""
    if lists.null_count:
        raise ValueError("a row without features")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1 if len(lists) else 0)


def select_features(df: DataFrame, candidates: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Present model columns (absent ones skipped), cleaned; keeps event_id."""
    names = [c for c in (candidates or L.ML_FEATURES) if c in df.columns]
    return df.select("event_id", *[clean(c).alias(c) for c in names]), names


def ground_truth(df: DataFrame, label: str = "is_anomaly_original") -> Column | None:
    """1 for a true label, 0 for false or missing; None without a label column."""
    if label not in df.columns:
        return None
    return F.when(F.col(label) == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def scaler_stats(X: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column in one pass: the columns are
    unpivoted (`stack`) and grouped by name, so the plan holds two aggregates
    instead of two per column; one row per feature reaches the driver."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in names)
    long = X.select(*names).selectExpr(f"stack({len(names)}, {pairs}) AS (feature, v)")
    rows = long.groupBy("feature").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    got = {r["feature"]: (float(r["m"] or 0.0), float(r["s"] or 0.0)) for r in rows}
    return {c: got.get(c, (0.0, 0.0)) for c in names}


def scale(X: DataFrame, names: list[str], stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a constant column becomes 0."""
    cols = []
    for c in names:
        mean, std = stats[c]
        cols.append(((F.col(c) - F.lit(mean)) / F.lit(std) if std > 0 else F.lit(0.0)).alias(c))
    others = [c for c in X.columns if c not in names]
    return X.select(*others, *cols)
