"""Substring dedup on words: remove every word covered by a window of `width`
words whose word sequence also starts anywhere else, all copies included.

Candidates are dealt to buckets by `repeats.repeated_spans`. In a bucket each
string is a reference: its non-overlapping blocks of half a window are indexed by
hash, every rolling block of every string probes the index, and each hit is
extended left and right to the maximal exact repeat (binary search over prefix
hashes). Any window of `width` words holds a whole reference block of `block` =
(width + 1) // 2 words, so no repeat is missed. Words get exact ids per bucket
and the extended repeats are compared word by word, so hashes decide nothing.

Defined cases: a null text has no words; texts with fewer than `width` words are
kept; removed texts keep their words joined by one space; repeated or null ids
as in `common.run_keyed`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from auditlake.llm.common import ID, arrow_map, read, run_keyed
from auditlake.llm.repeats import BASES, Hashes, merged, mix, repeated_spans, unpacked, with_spans
from auditlake.llm.suffix_dedup import window_ranges

WIDTH = 35
GRAM = 12
HOT = 64
U64 = np.uint64


def repeated_windows(rid: np.ndarray, s: np.ndarray, strings: list[bytes], keep_first: bool, width: int = WIDTH):
    """Rows and half-open window ranges of the strings' repeated windows.
    `keep_first` is not used: all copies count."""
    block = (width + 1) // 2
    ids: dict[bytes, int] = {}
    words = [np.fromiter((ids.setdefault(w, len(ids)) for w in x.split()), np.int64) for x in strings]
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes)
    flat = np.concatenate(words)
    hashes = Hashes(BASES[0])
    prefixes = hashes.prefixes(mix(flat.astype(U64) + U64(1)))
    begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    rolling = np.flatnonzero(np.arange(len(flat)) + block <= end)
    indexed = rolling[(rolling - begin[rolling]) % block == 0]
    keys = hashes.of(prefixes, indexed, indexed + block)
    order = np.argsort(keys, kind="stable")
    keys, indexed = keys[order], indexed[order]
    probes = hashes.of(prefixes, rolling, rolling + block)
    lo, hi = np.searchsorted(keys, probes, "left"), np.searchsorted(keys, probes, "right")
    again = np.zeros(len(flat) + 1, np.int64)
    counts = hi - lo
    cuts = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum(), 500_000), "left") if counts.sum() else []
    for at, to in zip(cuts, [*cuts[1:], len(rolling)]):
        n = counts[at:to]
        p = np.repeat(rolling[at:to], n)
        q = indexed[np.repeat(lo[at:to] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        p, q = p[p != q], q[p != q]
        for _ in (0, 1):     # a repeat marks both of its places
            left = extend(hashes, prefixes, p, q, np.minimum(p - begin[p], q - begin[q]), width - block, -1)
            right = extend(hashes, prefixes, p + block, q + block,
                           np.minimum(end[p] - p, end[q] - q) - block, width - block, 1)
            long = left + block + right >= width
            p, q, left, n_all = p[long], q[long], left[long], (left + block + right)[long]
            exact = np.ones(len(p), bool)
            for k in range(int(n_all.max(initial=0))):
                inside = k < n_all
                exact &= ~inside | (flat[np.where(inside, p - left + k, 0)] == flat[np.where(inside, q - left + k, 0)])
            if not exact.all():
                raise RuntimeError("hash collision of word sequences")
            np.add.at(again, p - left, 1)
            np.add.at(again, p - left + n_all - width + 1, -1)
            p, q = q, p
    starts = np.flatnonzero(np.arange(len(flat)) + width <= end)
    marked = np.cumsum(again[:-1])[starts] > 0
    return window_ranges(np.searchsorted(ends, starts, "right"), starts - begin[starts], marked)


def extend(hashes: Hashes, prefixes: np.ndarray, p: np.ndarray, q: np.ndarray, room: np.ndarray, most: int,
           way: int) -> np.ndarray:
    """How far the sequences at p and q agree to the right (way 1) or left (-1) of them."""
    room = np.minimum(room, most)
    length = np.zeros(len(p), np.int64)
    step = 1 << max(0, most.bit_length() - 1)
    while step:
        n = np.where(length + step <= room, step, 0)
        x, y = (p + length, q + length) if way > 0 else (p - length - n, q - length - n)
        same = (n > 0) & (hashes.of(prefixes, x, x + n) == hashes.of(prefixes, y, y + n))
        length += np.where(same, step, 0)
        step >>= 1
    return length


def dedup_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    names = ("n_words", "n_removed", "kept")
    out: dict = {k: [] for k in names}
    for text, spans in zip(unpacked(batch), batch.column("spans").to_pylist()):
        words = text.split()
        kept, at, removed = [], 0, 0
        for s, e in merged(spans):
            kept += words[at:s]
            at, removed = e, removed + e - s
        kept += words[at:]
        for k, v in zip(names, (len(words), removed, b" ".join(kept))):
            out[k].append(v)
    yield {ID: batch.column(ID), **out, "sha": [hashlib.sha256(x).hexdigest() for x in out["kept"]],
           "kept": [x.decode() for x in out["kept"]]}


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    gram: int = GRAM) -> DataFrame:
    """(id, n_words, n_removed, kept, kept_sha256) per document."""
    def kernel(rid, s, strings, keep_first):
        return repeated_windows(rid, s, strings, keep_first, width)

    def work(rows: DataFrame) -> DataFrame:
        spans = repeated_spans(rows, "words", width, gram, kernel, keep_first=False, hot=HOT)
        return arrow_map(with_spans(rows, spans), dedup_rows,
                         f"{ID} long, n_words long, n_removed long, kept string, sha string"
                         ).withColumnRenamed("sha", "kept_sha256")
    return run_keyed(docs, work, id_col, text_col)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents")).drop("kept")
