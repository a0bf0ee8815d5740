"""Importance resampling of documents towards a target collection.

Features are the runs of one and two words; a feature's bucket is the CRC-32 of its
bytes modulo `buckets`. Counts per bucket over all documents and over the target
give each bucket a gain (its log odds, in whole thousandths), a document's weight is
the floored mean gain of its features, and a Gumbel number drawn from a hash of its
id turns the best scores into a draw without replacement.

CRC-32 is linear: the CRC of a span is the XOR of one contribution for each byte, which
depends on the byte and on its distance from the span's end alone, and of a
constant of the span's length (the CRC of as many zero bytes). Contributions come from a
table of `DEPTH` distances, and `bitwise_xor.reduceat` folds them over all spans of
a block at once. A span longer than the table is folded block by block: the
state so far is XORed into the next block's first four bytes.

Counts are summed per task before they shuffle (`buckets` rows a task at most), and the
gains (one number a bucket) travel as a broadcast. Ranks come from a range-partitioned
sort and one row count per range, never from one window over all rows.

Defined cases: a null text has no words; a document without features has weight 0. Rows
without an id draw as if the id were empty text and come last among equal scores;
rows that share an id are documents of their own with the same draw. Without documents
or without a target all gains are 0 or follow from the counts alone. Columns beyond id and
text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import ID, TEXT, pieces, read, texts_of
from auditlake.operators.lookup import materialize
from auditlake.session import prepare

# A-Z to a-z, digits, a-z and bytes beyond ASCII as they are, all else to a space
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
POLYNOMIAL = np.uint32(0xEDB88320)    # fixed value: CRC-32, reflected
DEPTH = 128
FLAT_BYTES = 1 << 20                  # span bytes laid out at a time
BLOCK_BYTES = 1 << 20                 # text bytes worked on at a time


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


class SpanCrc:
    """CRC-32 of many spans of one byte array."""

    def __init__(self, depth: int = DEPTH):
        first = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            first = (first >> 1) ^ np.where(first & 1, POLYNOMIAL, np.uint32(0))
        table = [first]
        for _ in range(depth - 1):
            table.append((table[-1] >> 8) ^ first[table[-1] & 255])
        self.depth = depth
        self.table = np.concatenate(table)                    # 256 * distance + byte
        self.zeros = np.array([zlib.crc32(bytes(n)) for n in range(depth + 1)], np.uint32)

    def linear(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """XOR of the contributions of each span's bytes (sizes from 1 to `depth`)."""
        stops = np.cumsum(sizes, dtype=np.int32)
        back = np.repeat(stops, sizes)
        back -= np.arange(1, len(back) + 1, dtype=np.int32)   # distance from the span's end
        at = np.repeat((starts + sizes - 1).astype(np.int32), sizes)
        at -= back
        back <<= 8
        back |= data[at]
        return np.bitwise_xor.reduceat(self.table[back], stops - sizes)

    def short(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.empty(len(sizes), np.uint32)
        total = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, before + FLAT_BYTES, "right")))
            part = slice(at, stop)
            out[part] = self.linear(data, starts[part], sizes[part]) ^ self.zeros[sizes[part]]
            at = stop
        return out

    def long(self, data: np.ndarray, start: int, size: int) -> int:
        """One span beyond the table, folded in blocks of `depth` bytes."""
        head = (size - 1) % self.depth + 1
        state = int(self.linear(data, np.array([start]), np.array([head]))[0])
        ends = (self.depth - 1 - np.arange(4)) << 8
        for lo in range(start + head, start + size, FLAT_BYTES // self.depth * self.depth):
            hi = min(start + size, lo + FLAT_BYTES // self.depth * self.depth)
            starts = np.arange(lo, hi, self.depth)
            for part in self.linear(data, starts, np.full(len(starts), self.depth)).tolist():
                last = [state & 255, state >> 8 & 255, state >> 16 & 255, state >> 24]
                state = part ^ int(np.bitwise_xor.reduce(self.table[ends + last]))
        return state ^ zlib.crc32(bytes(size))

    def spans(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.empty(len(sizes), np.uint32)
        fits = sizes <= self.depth
        if fits.any():
            out[fits] = self.short(data, starts[fits], sizes[fits])
        for k in np.flatnonzero(~fits):
            out[k] = self.long(data, int(starts[k]), int(sizes[k]))
        return out


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words, one space behind each, as one array of bytes; start and size of each
    word in it, and the number of its text."""
    raw = np.frombuffer((b"\n".join(texts) + b"\n").translate(PLAIN), np.uint8)
    word = raw != 32
    kept = word.copy()
    kept[1:] |= word[:-1]                                     # a word's bytes and the one after
    ends_of_texts = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    begins = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    owner = np.searchsorted(ends_of_texts, begins, "right")
    data = raw[kept]
    space = np.flatnonzero(data == 32)                        # one behind each word
    starts = np.concatenate([[0], space[:-1] + 1]).astype(np.int64)[:len(space)]
    return data, starts, space - starts, owner


def features(texts: list[bytes], crc: SpanCrc, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of whole texts: the block's first text and its end, the words of each text,
    and for each feature the number of its text in the block and its bucket."""
    at = 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at])
        while stop < len(texts) and size + len(texts[stop]) <= BLOCK_BYTES:
            size += len(texts[stop])
            stop += 1
        data, starts, sizes, owner = word_spans(texts[at:stop])
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        of = np.concatenate([owner, owner[pair]])
        from_ = np.concatenate([starts, starts[pair]])
        long = np.concatenate([sizes, sizes[pair] + 1 + sizes[pair + 1]])
        found = crc.spans(data, from_, long) % np.uint32(buckets)
        yield at, stop, np.bincount(owner, minlength=stop - at), of, found.astype(np.int64)
        at = stop


def bucket_counts(texts: DataFrame, s: Settings, text_col: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = SpanCrc(), np.zeros(s.buckets, np.int64)
        for batch in batches:
            for small in pieces(batch):
                for *_, found in features(texts_of(small), crc, s.buckets):
                    total += np.bincount(found, minlength=s.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return (texts.select(F.col(text_col).alias(TEXT)).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, s: Settings, text_col: str, target_text: str) -> np.ndarray:
    """The gain of every bucket, in whole thousandths (`buckets` numbers)."""
    spark = docs.sparkSession
    both = bucket_counts(docs, s, text_col).withColumn("target", F.lit(False)).unionByName(
        bucket_counts(target, s, target_text).withColumn("target", F.lit(True)))
    counts = {True: np.zeros(s.buckets, np.int64), False: np.zeros(s.buckets, np.int64)}
    for r in both.collect():             # 2 * buckets rows at most
        counts[r["target"]][r["bucket"]] = r["n"]
    S, T = (float(counts[k].sum()) for k in (False, True))
    table = spark.createDataFrame([(k, int(a), int(b)) for k, (a, b) in enumerate(zip(counts[False], counts[True]))],
                                  "bucket long, s long, t long")
    odds = ((F.col("t") + 1).cast("double") * F.lit(S + s.buckets)) / ((F.col("s") + 1).cast("double") * F.lit(T + s.buckets))
    out = np.zeros(s.buckets, np.int64)
    for r in table.select("bucket", F.floor(1000 * F.log(odds)).cast("long").alias("gain")).collect():
        out[r["bucket"]] = r["gain"]
    return out


def weighted(docs: DataFrame, target: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
             text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(gains(docs, target, s, text_col, target_text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, gain = SpanCrc(), shared.value
        for batch in batches:
            for small in pieces(batch):
                n_words, n_features, weight = [], [], []
                for at, stop, words, of, found in features(texts_of(small), crc, s.buckets):
                    n = np.bincount(of, minlength=stop - at)
                    # sums of whole numbers far below 2^53
                    total = np.bincount(of, gain[found], stop - at).astype(np.int64)
                    n_words += words.tolist()
                    n_features += n.tolist()
                    weight += np.where(n > 0, total // np.maximum(n, 1), 0).tolist()
                yield pa.RecordBatch.from_arrays(
                    [small.column(ID), *(pa.array(v, pa.int64()) for v in (n_words, n_features, weight))],
                    names=[ID, "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias(ID), F.col(text_col).alias(TEXT))
    return rows.mapInArrow(run, f"{ID} long, n_words long, n_features long, weight long").withColumnRenamed(ID, id_col)


def resample(docs: DataFrame, target: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
             text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; `rank` is null where the row
    is not drawn."""
    spark = prepare(docs.sparkSession)
    name = F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    able = F.col("n_words") >= s.least_words
    table, seen = materialize(weighted(docs, target, s, id_col, text_col, target_text).withColumn("score", F.col("weight") + gumbel),
                              "resample-scores", able=F.count_if(able))
    draws = s.percent * int(seen["able"] or 0) // 100
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("n_features").desc(), F.col("n_words").desc()]
    part = F.spark_partition_id()
    dealt = table.where(able).repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", part.alias("part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("place"))
    ordered, _ = materialize(dealt, "resample-order")
    sizes = sorted(tuple(r) for r in ordered.groupBy("part").agg(F.count(F.lit(1))).collect())    # a row for each range
    before, offsets = 0, []
    for k, n in sizes:
        offsets.append((k, before))
        before += n
    starts = spark.createDataFrame(offsets, "part int, before long")
    rank = F.col("before") + F.col("place") + 1
    ranked = ordered.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= draws, rank))
    columns = [id_col, "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(
        table.where(~able).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# the CRC of each distinct feature, byte by byte: a recursive join with the table of 256 steps
OP13_SQL = rf"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
steps AS (SELECT i, c FROM bits WHERE k = 8),
worded AS (SELECT false AS target, doc_id, {WORDS_SQL} AS w FROM documents
  UNION ALL SELECT true, NULL, {WORDS_SQL} FROM benchmark),
numbered AS (SELECT *, row_number() OVER () AS num FROM worded),
found AS (SELECT num, target, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM numbered),
counted AS (SELECT num, target, f, count(*) AS n FROM found GROUP BY ALL),
names AS (SELECT f, hex(encode(f)) AS bytes FROM (SELECT DISTINCT f FROM counted)),
run AS (
  SELECT f, bytes, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM names
  UNION ALL
  SELECT f, bytes, k + 1, xor(r.c >> 8, s.c) FROM run r
  JOIN steps s ON s.i = xor(r.c & 255, CAST('0x' || substr(bytes, 2 * k + 1, 2) AS BIGINT))
  WHERE 2 * k < length(bytes)),
hashed AS (SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM run WHERE 2 * k = length(bytes)),
bucketed AS (SELECT num, target, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (NOT target), 0) AS s, coalesce(sum(n) FILTER (target), 0) AS t
  FROM bucketed GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE))
    / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM sums, totals),
summed AS (SELECT num, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM bucketed JOIN gains USING (bucket) GROUP BY num),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296)))
      AS BIGINT) AS score
  FROM numbered LEFT JOIN summed USING (num) WHERE NOT target),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN place END AS rank FROM placed
"""
