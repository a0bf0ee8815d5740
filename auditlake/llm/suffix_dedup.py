"""Suffix-array dedup: remove every byte covered by a string of `width` bytes
that also starts earlier in the corpus (smaller id, or same document before).

Candidates are dealt to buckets by `repeats.repeated_spans`. In a bucket the
window suffixes are sorted by a bottom-up mergesort whose comparisons look up
prefix polynomial hashes: binary search over lengths finds the common
extension of two suffixes in log(width) probes, and the next byte decides.
Neighbours that share `width` bytes form a run; its earliest window stays, the
others are repeats. The bytes of neighbours called equal are compared
(collision verification); a collision restarts the bucket with another base.

Defined cases: a null text is empty; texts shorter than `width` are kept whole;
matches never cross documents; repeated or null ids as in `common.run_keyed`;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.llm.common import ID, TEXT, arrow_map, odd_ids, of_row, read, run_keyed
from auditlake.llm.repeats import BASES, Hashes, merged, mix, repeated_spans, unpacked, with_spans
from auditlake.session import prepare

WIDTH = 100
GRAM = 24
HOT = 4096
U64 = np.uint64


class SuffixOrder:
    """Suffixes of `data` at `places`, compared on their first `width` bytes."""

    def __init__(self, data: np.ndarray, places: np.ndarray, width: int, base: int):
        self.data, self.places, self.width = data, places, width
        self.hashes = Hashes(base)
        self.prefixes = self.hashes.prefixes(mix(data.astype(U64) + U64(1)))
        self.whole = self.hashes.of(self.prefixes, places, places + width)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of places a and b, below `width`."""
        length = np.zeros(len(a), np.int64)
        step = 1 << (self.width - 1).bit_length() - 1
        while step:
            fits = length + step < self.width
            n = np.where(fits, step, 0)
            x, y = a + length, b + length
            same = fits & (self.hashes.of(self.prefixes, x, x + n) == self.hashes.of(self.prefixes, y, y + n))
            length += np.where(same, step, 0)
            step >>= 1
        return length

    def compare(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for suffixes i and j."""
        out = np.zeros(len(i), np.int8)
        differ = np.flatnonzero(self.whole[i] != self.whole[j])
        a, b = self.places[i[differ]], self.places[j[differ]]
        n = self.common(a, b)
        out[differ] = np.sign(self.data[a + n].astype(np.int16) - self.data[b + n].astype(np.int16))
        return out

    def sort(self) -> np.ndarray:
        """Order of the suffixes: by their first eight bytes, then mergesort of each run of ties."""
        head = np.zeros(len(self.places), U64)
        for k in range(8):
            head = head << U64(8) | self.data[self.places + k].astype(U64)
        order = np.argsort(head, kind="stable")
        head = head[order]
        first = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        sizes = np.diff(np.append(first, len(order)))
        most = int(sizes.max(initial=0))
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        width = 1
        while width < most:
            at = np.flatnonzero(size > width)     # ties that still have two runs
            own = at - base[at]
            left = own // (2 * width) * (2 * width)
            in_right = own - left >= width
            lo = base[at] + np.where(in_right, left, left + width)
            lo = np.minimum(lo, base[at] + size[at])
            hi = np.minimum(lo + width, base[at] + size[at])
            start = lo.copy()
            open_ = lo < hi
            while open_.any():
                k = np.flatnonzero(open_)
                mid = (lo[k] + hi[k]) >> 1
                sign = self.compare(order[mid], order[at[k]])
                before = (sign < 0) | ((sign == 0) & in_right[k])   # stable: equal left elements go first
                lo[k] = np.where(before, mid + 1, lo[k])
                hi[k] = np.where(before, hi[k], mid)
                open_[k] = lo[k] < hi[k]
            to = base[at] + left + (own - left - np.where(in_right, width, 0)) + (lo - start)
            moved = order.copy()
            moved[to] = order[at]
            order, width = moved, 2 * width
        return order

    def runs(self, order: np.ndarray) -> np.ndarray | None:
        """Starts of the runs of suffixes equal in `width` bytes; None after a hash collision."""
        same = self.whole[order[1:]] == self.whole[order[:-1]]
        pairs = np.flatnonzero(same)
        for at in range(0, len(pairs), 50_000):
            a, b = (self.places[order[pairs[at:at + 50_000] + k]][:, None] + np.arange(self.width) for k in (0, 1))
            if not np.array_equal(self.data[a], self.data[b]):
                return None
        return np.flatnonzero(np.concatenate(([True], ~same)))


def repeated_windows(rid: np.ndarray, s: np.ndarray, strings: list[bytes], keep_first: bool, width: int = WIDTH):
    """Rows and half-open window ranges of the strings' repeated windows."""
    sizes = np.array([len(x) for x in strings])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(strings), np.uint8)
    counts = sizes - width + 1
    owner = np.repeat(np.arange(len(strings)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = (ends - sizes)[owner] + offset
    for base in (BASES[0], BASES[1], 0x165667B19E3779F9, 0x27D4EB2F165667C5):
        suffixes = SuffixOrder(data, places, width, base)
        order = suffixes.sort()
        starts = suffixes.runs(order)
        if starts is not None:
            break
    else:
        raise RuntimeError("hash collisions under every base")
    rank = np.unique(rid, return_inverse=True)[1].astype(np.int64)
    when = (rank[owner] << 32) + s.astype(np.int64)[owner] + offset
    sizes_of = np.diff(np.append(starts, len(order)))
    again = np.zeros(len(owner), bool)
    if keep_first:
        again[order] = when[order] > np.repeat(np.minimum.reduceat(when[order], starts), sizes_of)
    else:
        again[order] = np.repeat(sizes_of, sizes_of) > 1
    return window_ranges(owner, offset, again)


def window_ranges(owner: np.ndarray, offset: np.ndarray, again: np.ndarray):
    """Maximal ranges of marked windows per string: (row, first, one past the last)."""
    at = np.flatnonzero(again)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.concatenate(([True], (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])))
    first = at[cut]
    last = at[np.concatenate((np.flatnonzero(cut)[1:], [len(at)])) - 1]
    return owner[first], offset[first], offset[last] + 1


def dedup_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    names = ("n_bytes", "n_removed", "n_spans", "kept")
    out: dict = {k: [] for k in names}
    for text, spans in zip(unpacked(batch), batch.column("spans").to_pylist()):
        runs = merged(spans)
        kept, at = [], 0
        for s, e in runs:
            kept.append(text[at:s])
            at = e
        kept.append(text[at:])
        for k, v in zip(names, (len(text), sum(e - s for s, e in runs), len(runs), b"".join(kept))):
            out[k].append(v)
    further = {c: batch.column(c) for c in batch.schema.names if c not in (ID, "packed", "spans")}
    yield {ID: batch.column(ID), **out, "sha": [hashlib.sha256(x).hexdigest() for x in out["kept"]], **further}


def deduplicated(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """Results of (rid, body) rows with unique ids; further columns come along."""
    def kernel(rid, s, strings, keep_first):
        return repeated_windows(rid, s, strings, keep_first, width)

    spans = repeated_spans(rows, "bytes", width, gram, kernel, keep_first=True, hot=HOT)
    schema = T._parse_datatype_string(f"{ID} long, n_bytes long, n_removed long, n_spans long, kept binary, sha string")
    further = [f for f in rows.schema.fields if f.name not in (ID, TEXT)]
    return arrow_map(with_spans(rows, spans), dedup_rows, T.StructType([*schema.fields, *further])).withColumnRenamed("sha", "kept_sha256")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                 gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary, kept_sha256) per document.
    `kept` is the remaining bytes; a cut may fall inside a UTF-8 character."""
    return run_keyed(docs, lambda rows: deduplicated(rows, width, gram), id_col, text_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   gram: int = GRAM) -> DataFrame:
    """`docs` with the repeated bytes taken out of the texts (UTF-8 fragments that a
    cut leaves go as well); a null text stays null. The other columns travel with
    the text as one struct, so names can't clash and nothing is joined back."""
    prepare(docs.sparkSession)
    text = F.when(F.col("n_removed") > 0, whole_characters("kept")).otherwise(F.col("kept").cast("string"))
    if odd_ids(docs, id_col):
        made = run_keyed(docs, lambda rows: deduplicated(rows, width, gram), id_col, text_col, "kept_of")
        made = made.select(F.col(id_col).alias("kept_id"), "kept_of", text.alias("kept_text")).distinct()
        joined = docs.join(made, of_row(docs, made, id_col, "kept_id", "kept_of", text_col), "left")
        return joined.select(*[F.when(docs[c].isNotNull(), made["kept_text"]).alias(c) if c == text_col else docs[c] for c in docs.columns])
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.col(text_col).isNull().alias("no text"))
    made = deduplicated(docs.select(F.col(id_col).cast("long").alias(ID), F.col(text_col).alias(TEXT), rest.alias("rest")), width, gram)
    return made.select(*[F.when(~F.col("rest")["no text"], text).alias(c) if c == text_col else F.col("rest")[c].alias(c)
                         for c in docs.columns])


def whole_characters(column: str):
    """Text of a binary column without broken UTF-8 sequences."""
    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))
    return decode(F.col(column))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents")).drop("kept")
