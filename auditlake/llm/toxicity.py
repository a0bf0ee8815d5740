"""Toxicity scores from subword embeddings.

A word is the bag of its hashed character n-grams (and itself); its vector is
their mean, a passage's vector is the mean of its words', and a linear softmax reads
the passage's vector. A text's passages are all runs of `passage` words, and its score
is that of its most toxic passage: one slur in a long text is not averaged away.
Embeddings and softmax are trained jointly in numpy (Adam, full batches) on a
bounded sample of labelled rows; the first third of the steps reads the mean of
a text's passages, the rest its strongest one. An unseen misspelling shares
n-grams, and so most of its vector, with words that were seen.

The trained model is linear in the embeddings, so scoring needs one number
per n-gram bucket (a broadcast of fixed size) and a mean over each passage of
the whole text, with words' values kept in a bounded memo.

Defined cases: null or wordless texts get the score of the bias alone; labels
other than 0 and 1, and rows without an id, teach nothing; a document labelled
twice has the larger label; without labelled rows of both classes all scores are 0.
Every input row gives one output row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import Memo, id_remainder, read, release, sample_texts
from auditlake.session import prepare

LETTERS = re.compile(r"[^\W_]+")
MEMO_WORDS = 1 << 16             # words whose values a task keeps, twice over
TEXTS_AT_ONCE = 256


@dataclass(frozen=True)
class Settings:
    """Parameters of the model; the sample holds `per_class` rows of each label,
    those of at most `longest` characters first; of a longer text the passages of its first
    `cut` characters are learned."""
    per_class: int = 1000
    longest: int = 3000
    cut: int = 6000
    buckets: int = 1 << 17
    size: int = 4
    least_gram: int = 3
    most_gram: int = 4
    passage: int = 2
    least_texts: int = 5         # of the sample hold an n-gram that is trained
    scale: float = 20.0          # of the mean vector: one word of a passage decides
    steps: int = 120
    rate: float = 0.05
    decay: float = 0.01          # of the embeddings, per step
    seed: int = 7


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams(word: str, s: Settings) -> list[int]:
    """Bucket of the word and of each of its n-grams, word ends marked."""
    marked = f"<{word}>"
    parts = [marked] + [marked[i:i + n] for n in range(s.least_gram, s.most_gram + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(p.encode()) % s.buckets for p in parts]


class Bags:
    """Rows of indices, each row the mean of its vectors (CSR arrays), multiplied with a matrix and back."""

    def __init__(self, index: np.ndarray, owner: np.ndarray, weight: np.ndarray, rows: int):
        self.index, self.owner, self.weight, self.rows = index, owner, weight, rows

    def times(self, matrix: np.ndarray) -> np.ndarray:
        out = np.empty((self.rows, matrix.shape[1]))
        for k in range(matrix.shape[1]):
            out[:, k] = np.bincount(self.owner, self.weight * matrix[self.index, k], self.rows)
        return out

    def back(self, grad: np.ndarray, rows: int) -> np.ndarray:
        out = np.empty((rows, grad.shape[1]))
        for k in range(grad.shape[1]):
            out[:, k] = np.bincount(self.index, self.weight * grad[self.owner, k], rows)
        return out


def passages(sample: list[tuple[int, str]], s: Settings) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(words of each passage, first passage of each text, vocabulary). Every run of `passage` words is a passage; a
    shorter text is one, its words repeated; number 0 is the word of a text that has none."""
    vocabulary: dict[str, int] = {"": 0}
    parts, sizes = [], []
    for _, text in sample:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)] or [0], np.int32)
        if len(ids) < s.passage:
            ids = np.resize(ids, s.passage)
        parts.append(np.lib.stride_tricks.sliding_window_view(ids, s.passage).copy())
        sizes.append(len(parts[-1]))
    return np.concatenate(parts), np.cumsum([0, *sizes[:-1]]), list(vocabulary)


def word_bags(vocabulary: list[str], words: np.ndarray, begin: np.ndarray, s: Settings) -> tuple[Bags, np.ndarray]:
    """(the bag of each word, the buckets trained): n-grams that fewer than `least_texts` texts hold are left out of
    a bag, and keep their share of its mean."""
    of_word = [np.zeros(0, np.int32), *(np.array(grams(word, s), np.int32) for word in vocabulary[1:])]
    seen = np.zeros(s.buckets, np.int32)
    for part in np.split(words, begin[1:]):
        held = np.concatenate([of_word[w] for w in np.unique(part).tolist()])
        seen[np.unique(held)] += 1
    sizes = np.array([len(g) for g in of_word])
    index = np.concatenate(of_word)
    owner = np.repeat(np.arange(len(of_word), dtype=np.int32), sizes)
    kept = seen[index] >= s.least_texts
    used, local = np.unique(index[kept], return_inverse=True)
    owner = owner[kept]
    return Bags(local.astype(np.int32), owner, 1 / sizes[owner], len(of_word)), used


def train(sample: list[tuple[int, str]], s: Settings) -> tuple[np.ndarray, float]:
    """(value of each bucket, bias): a passage's log odds of label 1 are the bias
    plus the mean over its words of the mean value of their buckets. Passages are rows of word
    numbers, and steps work on one pair of logits a word or passage, so a sample of the
    largest size (2 * `per_class` * `cut` characters) takes a few hundred MB."""
    labels = np.array([label for label, _ in sample], float)
    if len(set(labels)) < 2:
        return np.zeros(s.buckets), -math.inf
    words, begin, vocabulary = passages(sample, s)
    parts, used = word_bags(vocabulary, words, begin, s)
    counts = np.diff([*begin, len(words)])
    owner = np.repeat(np.arange(len(labels), dtype=np.int32), counts)
    rng = np.random.default_rng(s.seed)
    weights = {"e": rng.normal(0, 0.1, (len(used), s.size)), "w": rng.normal(0, 1, (s.size, 2)), "b": np.zeros(2)}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    truth = np.stack([1 - labels, labels], 1)
    for step in range(1, s.steps + 1):
        vectors = parts.times(weights["e"]) * s.scale
        of_word = (vectors @ weights["w"]).astype(np.float32)
        logits = of_word[words[:, 0]]
        for k in range(1, s.passage):
            logits += of_word[words[:, k]]
        logits /= s.passage
        if step * 3 <= s.steps:
            part = (1 / counts).astype(np.float32)[owner]
        else:
            strength = logits[:, 1] - logits[:, 0]
            part = (strength == np.maximum.reduceat(strength, begin)[owner]).astype(np.float32)
            part /= np.add.reduceat(part, begin)[owner]
        read = np.add.reduceat(logits * part[:, None], begin) + weights["b"]
        odds = np.exp(read - read.max(1, keepdims=True))
        error = (odds / odds.sum(1, keepdims=True) - truth) / len(labels)
        to_words = np.zeros((len(vocabulary), 2))
        for c in range(2):
            of_passage = error[:, c].astype(np.float32)[owner] * part / s.passage
            for k in range(s.passage):
                to_words[:, c] += np.bincount(words[:, k], of_passage, len(vocabulary))
        grad = {"w": vectors.T @ to_words, "b": error.sum(0),
                "e": parts.back(to_words @ weights["w"].T * s.scale, len(used))}
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] -= s.rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        weights["e"] *= 1 - s.decay
    values = np.zeros(s.buckets)
    values[used] = weights["e"] @ (weights["w"][:, 1] - weights["w"][:, 0]) * s.scale
    return values, float(weights["b"][1] - weights["b"][0])


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, float]:
    known = (labels.where(F.col(label_col).isin(0, 1) & (id_remainder(id_col, 3) != 1))
             .groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).alias("label")))
    return train(sample_texts(docs, known, s.per_class, 1, s.longest, s.cut, id_col, text_col), s)


def score_of(docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), text_col: str = "text") -> Column:
    """Score of each row's text."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from score_batches(batches, shared.value, s)

    return score(F.col(text_col))


def score_batches(batches: Iterator[pa.Array], model: tuple[np.ndarray, float], s: Settings) -> Iterator[pa.Array]:
    """Scores of a task's batches of texts."""
    release()
    values, bias = model

    def value(word: str) -> float:
        g = grams(word, s)
        return float(values[g].sum()) / len(g)

    memo = Memo(value, MEMO_WORDS)
    for batch in batches:
        yield pa.array(scores_of(batch, bias, memo, s.passage), pa.float64())


def scores_of(batch: pa.Array, bias: float, memo: Memo, passage: int) -> list[float]:
    """Scores of a batch, which may hold thousands of texts: a few at a time become Python's."""
    return [sigmoid(bias + strongest(words_of(t or ""), memo, passage))
            for at in range(0, len(batch), TEXTS_AT_ONCE) for t in batch.slice(at, TEXTS_AT_ONCE).to_pylist()]


def strongest(words: list[str], memo: Memo, passage: int) -> float:
    """The largest mean of `passage` words in a row (of all words, where there are fewer)."""
    known = memo.young.get
    found = [known(w) for w in words]
    if None in found:
        found = [memo.add(w) if v is None else v for w, v in zip(words, found)]
    if len(found) <= passage:
        return sum(found) / max(1, len(found))
    if passage == 2:
        return max(map(float.__add__, found, found[1:])) / 2
    return max(sum(found[at:at + passage]) for at in range(len(found) - passage + 1)) / passage


def scored(docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), id_col: str = "doc_id",
           text_col: str = "text", least: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    out = docs.select(F.col(id_col), score_of(docs, model, s, text_col).alias("score"))
    return out.select(id_col, F.coalesce(id_remainder(id_col, 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= least).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), least: float = 0.7) -> DataFrame:
    """`docs` without the rows whose text scores `least` or more."""
    return docs.where(score_of(docs, fit(docs, labels, s), s) < least)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read(spark, sf_dir, "labels")))
