"""Permutation importance of the forest inputs (M10), in one pass.

Rows are dealt to blocks of about BLOCK_ROWS by a seeded hash of their content, so a
block is a random sample whatever the partitioning or the Arrow batch size. In a
block, ordered by that hash, each feature column is permuted in turn (seeded by the
block) and the absolute change of the decision is summed, in whole billionths. All features
are permuted in one walk of the trees (`Forest.permuted_scores`): only the rows that a permuted
value sends another way are walked again, from there. A final group-by over 34 partial rows per
block gives the importance.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.ml.forest import Forest

PARTIAL_SCHEMA = "feature string, change long, n long"
BLOCK_ROWS = 4096
BILLION = 1_000_000_000


def scores_of_permuted(forest, M: np.ndarray, P: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of M, and of M with each column in turn taken from P; a model other than a forest
    scores every such matrix."""
    if hasattr(forest, "permuted_scores"):
        return forest.permuted_scores(M, P)

    def replaced(j: int) -> np.ndarray:
        other = M.copy()
        other[:, j] = P[:, j]
        return forest.score_samples(other)
    return forest.score_samples(M), np.column_stack([replaced(j) for j in range(M.shape[1])])


def permutation_importance(X: DataFrame, names: list[str], forest: Forest, seed: int = 42,
                           features: str = "features", n_rows: int | None = None) -> DataFrame:
    rows = X.count() if n_rows is None else n_rows
    blocks = max(1, math.ceil(rows / BLOCK_ROWS))
    order = F.xxhash64("event_id", features, F.lit(seed))
    dealt = X.select("event_id", features, order.alias("_order")).withColumn("_block", F.pmod("_order", F.lit(blocks)))

    def per_block(pdf: pd.DataFrame) -> pd.DataFrame:
        M = np.stack(pdf[features].to_numpy()).astype(float)
        by_hash = pdf["_order"].to_numpy()
        at = np.argsort(by_hash)
        if (np.diff(by_hash[at]) == 0).any():
            at = np.lexsort((*M.T, by_hash))                    # rows of one hash: by content
        M = M[at]
        rng = np.random.default_rng([seed, int(pdf["_block"].iloc[0])])
        base, permuted = scores_of_permuted(forest, M, np.column_stack([rng.permutation(column) for column in M.T]))
        changes = np.round(np.abs(base[:, None] - permuted) * BILLION).astype(np.int64).sum(axis=0)
        return pd.DataFrame({"feature": names, "change": changes, "n": len(pdf)})

    partial = dealt.groupBy("_block").applyInPandas(per_block, PARTIAL_SCHEMA)
    return (partial.groupBy("feature")
            .agg((F.sum("change") / F.sum("n") / F.lit(float(BILLION))).alias("importance"))
            .orderBy(F.desc("importance"), F.asc("feature")))
