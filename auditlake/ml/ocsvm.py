"""One-Class SVM on Spark (D11): random Fourier features + a linear nu-objective.

The RBF kernel is approximated with random Fourier features (Rahimi & Recht,
2007): z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma). The one-class
objective of Schoelkopf et al. (2001) in that feature space,

    min_{w, rho}  1/2 |w|^2 + 1/(nu n) sum_i max(0, rho - w.z_i) - rho,

is solved by full-batch subgradient steps from the mean of z (the solution where every
row violates): each epoch is one pass that sums z over the violating rows. The sums are
of whole 2^-30 units, so they don't depend on partitions, batches or their order;
only D + 1 numbers per partition reach the shuffle. The offset is finally set to the
nu-quantile of w.z over the training rows, so the share of flagged training rows
equals nu, like the forest's contamination.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.ml.prepare import rows_of
from auditlake.operators.lookup import materialize
from auditlake.operators.ordered import exact_quantile


@dataclass
class OneClassModel:
    W: np.ndarray
    b: np.ndarray
    w: np.ndarray
    rho: float

    def embed(self, X: np.ndarray) -> np.ndarray:
        d = self.W.shape[1]
        return np.sqrt(2.0 / d) * np.cos(X @ self.W + self.b)

    def raw(self, X: np.ndarray) -> np.ndarray:
        return self.embed(X) @ self.w

    def decision(self, X: np.ndarray) -> np.ndarray:
        return self.raw(X) - self.rho

    def raw_udf(self):
        model = self

        @F.arrow_udf(T.DoubleType())
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for lists in batches:
                yield pa.array(model.raw(rows_of(lists)) if len(lists) else np.zeros(0))

        return score


UNIT = float(1 << 30)


def fit(X: DataFrame, n_features: int, n_rows: int, nu: float = 0.1, components: int = 128,
        gamma: float | None = None, epochs: int = 6, seed: int = 42,
        features: str = "features") -> OneClassModel:
    rng = np.random.default_rng([seed, 7])
    gamma = gamma or 1.0 / max(1, n_features)
    W = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_features, components))
    b = rng.uniform(0.0, 2.0 * np.pi, size=components)
    model = OneClassModel(W, b, np.zeros(components), 0.0)
    n = max(1, n_rows)
    X, _ = materialize(X.select(features), "ocsvm-matrix")       # cleaned and scaled once, read by every pass
    for epoch in range(epochs + 1):
        # no row reaches an infinite rho: the first pass sums all rows
        total, violating = violation_sums(X, OneClassModel(W, b, model.w, model.rho if epoch else np.inf), features)
        if not epoch:
            model.w = total / n
            model.rho = float(model.w @ model.w)
            continue
        step = 1.0 / (epoch + 1)
        model.w = model.w - step * (model.w - total / (nu * n))
        model.rho -= step * (violating / (nu * n) - 1.0) * abs(model.rho)
    # written once: the quantile reads them several times
    scores, _ = materialize(X.select(model.raw_udf()(F.col(features)).alias("s")), "ocsvm-scores")
    q = exact_quantile(scores, "s", nu)
    model.rho = float(q) if q is not None else model.rho
    return model


def violation_sums(X: DataFrame, model: OneClassModel, features: str) -> tuple[np.ndarray, int]:
    """Sum of z over the rows below rho, and their number."""
    size = model.W.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(size, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                Z = model.embed(rows_of(batch.column(0)))
                below = np.round(Z @ model.w * UNIT) < model.rho * UNIT
                total += np.round(Z[below] * UNIT).astype(np.int64).sum(axis=0)
                count += int(below.sum())
        yield pa.RecordBatch.from_pydict({"i": np.arange(size + 1), "v": [*total.tolist(), count]})

    rows = (X.select(features).mapInArrow(sums, "i long, v long").groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).orderBy("i").collect())
    if not rows:
        return np.zeros(size), 0
    return np.array([float(r["v"]) for r in rows[:size]]) / UNIT, int(rows[size]["v"])
