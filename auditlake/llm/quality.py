"""Quality rules and an isolation forest on their statistics.

Each document's rule statistics are exact counts over its whole text. Documents
that fail a base rule go. The others are scored by an isolation forest: random
splits on the statistics isolate unusual documents after few steps, so a short mean
path is an anomaly. The forest is grown on a bounded sample of the rows that passed
the base rules; the threshold comes from all labelled rows: among the scores in steps
of 1/1000 it is the one that parts good from bad best, under a bound on the good rows
it costs.

Defined cases: a null text is empty (no words, so the base rule fails); rows without
an id are scored and teach nothing; a document labelled twice has its smaller
label; without labelled rows that passed the base rules nothing is rejected by the
forest. Every input row gives one output row; ties at the threshold go.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import ID, TEXT, arrow_map, read, texts_of
from auditlake.operators.lookup import materialize
from auditlake.session import prepare

# characters of the symbol rule (fixed values)
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    rows_per_tree: int = 256
    sample: int = 8192           # rows the trees draw from
    most_lost: float = 0.02      # share of good rows the threshold may cost
    seed: int = 11


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = text.split()
    chars = len(text.translate(None, SPACE + CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = Counter(line for line in text.split(b"\n") if line and not line.isspace())
    return len(words), chars, symbols, sum(lines.values()) - len(lines), repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= again
    return int(covered.sum())


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the five counts, base_failed) of every row."""
    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [counts(t) for t in texts_of(batch)]
        yield {ID: batch.column(ID), **{c: [f[k] for f in found] for k, c in enumerate(COUNTS)}}

    rows_in = docs.select(F.col(id_col).cast("long").alias(ID), F.col(text_col).alias(TEXT))
    out = arrow_map(rows_in, rows, f"{ID} long, " + ", ".join(f"{c} long" for c in COUNTS)).withColumnRenamed(ID, id_col)
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def features(table: dict[str, np.ndarray]) -> np.ndarray:
    n = np.maximum(table["n_words"], 1).astype(float)
    chars = np.maximum(table["word_chars"], 1)
    return np.stack([np.log1p(table["n_words"]), table["word_chars"] / n, np.sqrt(table["n_symbols"] / chars),
                     np.log1p(table["n_symbols"] / n), (table["n_dup_lines"] + table["n_repeat_words"]) / n], 1)


def path_norm(n) -> np.ndarray:
    """Mean path of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


def grow(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A tree as rows (feature, split, left, right, path); feature -1 is a leaf."""
    limit = int(np.ceil(np.log2(max(2, len(rows)))))
    nodes: list[list[float]] = []

    def build(part: np.ndarray, depth: int) -> int:
        here = len(nodes)
        nodes.append([-1, 0, 0, 0, depth + float(path_norm(len(part)))])
        spread = np.flatnonzero(part.max(0) > part.min(0)) if len(part) > 1 and depth < limit else ()
        if len(spread):
            f = int(rng.choice(spread))
            split = rng.uniform(part[:, f].min(), part[:, f].max())
            low = part[:, f] <= split
            nodes[here][:4] = [f, split, build(part[low], depth + 1), build(part[~low], depth + 1)]
        return here

    build(rows, 0)
    return np.array(nodes)


def grow_forest(rows: np.ndarray, s: Settings = Settings()) -> tuple[list[np.ndarray], int]:
    rng = np.random.default_rng(s.seed)
    size = min(s.rows_per_tree, len(rows))
    return [grow(rows[rng.choice(len(rows), size, replace=False)], rng) for _ in range(s.trees)] if size > 1 else [], size


def anomaly(rows: np.ndarray, forest: tuple[list[np.ndarray], int]) -> np.ndarray:
    """Scores in 0..1 in steps of 1/1000: 2 ** -(mean path / expected path)."""
    trees, size = forest
    if not trees:
        return np.zeros(len(rows))
    total = np.zeros(len(rows))
    for tree in trees:
        at = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows)) if tree[0, 0] >= 0 else np.zeros(0, np.int64)
        while len(live):
            node = tree[at[live]]
            low = rows[live, node[:, 0].astype(np.int64)] <= node[:, 1]
            at[live] = np.where(low, node[:, 2], node[:, 3])
            live = live[tree[at[live], 0] >= 0]
        total += tree[at, 4]
    return np.round(2 ** -(total / len(trees) / float(path_norm(size))), 3)


def scored(stats: DataFrame, forest: tuple) -> DataFrame:
    """`stats` with `score`."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words):
        import pandas as pd
        table = dict(zip(COUNTS, (x.to_numpy() for x in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words))))
        return pd.Series(anomaly(features(table), shared.value))

    return stats.withColumn("score", score(*COUNTS))


def threshold(judged: DataFrame, s: Settings) -> float:
    """The score from which rows are rejected, from all (score, label) rows: the
    largest gap between the shares of bad and good rows rejected, where at
    most `most_lost` of the good ones are."""
    table = (judged.groupBy("score").agg(F.sum(F.col("label")).alias("good"), F.sum(1 - F.col("label")).alias("bad"))
             .orderBy(F.desc("score")).collect())      # at most 1001 rows
    good, bad = (np.array([r[k] for r in table], float) for k in ("good", "bad"))
    if not len(table) or not bad.sum():
        return 2.0
    lost, caught = np.cumsum(good) / max(good.sum(), 1), np.cumsum(bad) / bad.sum()
    gap = np.where(lost <= s.most_lost, caught - lost, -1)
    best = int(gap.argmax())
    return float(table[best]["score"]) if gap[best] > 0 else 2.0


def quality(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
            text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, the five counts, base_failed, score, kept) of every row. The narrow
    statistics are written once; the texts are read once."""
    prepare(docs.sparkSession)
    stats, seen = materialize(statistics(docs, id_col, text_col), "quality", rows=F.count_if(~F.col("base_failed")))
    known = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("label_id"))
             .agg(F.min(label_col).alias("label")))
    taught = stats.where("not base_failed").join(known, F.col(id_col) == F.col("label_id"))
    # ranked by id and counts, so equal counts are not neighbours; rows that agree in both count once
    ranked = stats.where("not base_failed").select(id_col, *COUNTS).distinct().withColumn("key", F.xxhash64(id_col, *COUNTS))
    # the lowest keys lie below a bound that about four samples pass, so tasks send few rows; repeated rows may leave less
    below = -(1 << 63) + min((1 << 64) - 1, (4 * s.sample << 64) // max(1, int(seen["rows"] or 0)))
    for rows in (ranked.where(F.col("key") <= below), ranked):
        picked = rows.orderBy("key", id_col, *COUNTS).limit(s.sample).collect()
        if len(picked) == s.sample or below == (1 << 63) - 1:
            break
    table = {c: np.array([r[c] for r in picked]) for c in COUNTS}
    forest = grow_forest(features(table), s)
    cut = threshold(scored(taught, forest).select("score", "label"), s)
    return scored(stats, forest).withColumn("kept", ~F.col("base_failed") & (F.col("score") < cut))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("score")
