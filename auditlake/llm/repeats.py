"""Exact repeats of a fixed length, found on Spark by content-chosen anchors.

Both repeat operators ask the same question: which windows of `width` symbols
(bytes or words) also start somewhere else in the corpus? Every window has one
*anchor*: its gram of `gram` symbols with the smallest hash, the leftmost on a
tie. Equal windows have equal anchors at equal offsets, so only windows with
the same anchor hash can be equal. A maximal run of windows with the same
anchor is a *segment* (`width` to about twice `width` symbols). The plan:

1. `anchors`: one row (h, u, rid, s, n) per segment: anchor hash, hash of the whole
   segment, document, start, length.
2. Anchor hashes with a single row cannot repeat; they go in an aggregate (map-side
   combined) and a semi-join, which leaves the repeated part of the corpus.
3. Equal segments collapse to their first occurrence (aggregate on (h, u)). All
   other occurrences are repeats as a whole; they come from an anti-join on
   the unique (h, u, position), so a segment shared by a third of all rows
   spreads evenly.
4. Distinct segments that share an anchor may repeat in part. Their strings are
   fetched and dealt to buckets by anchor; in each bucket the operator's kernel
   (suffix sort, or block index) finds the repeated windows. An anchor with more
   than `hot` distinct segments is not one group: each of its windows becomes a row,
   keyed by a 128-bit hash of the window, and the same aggregate and anti-join as
   in step 3 decide them.

Symbols hash by prefix polynomials modulo 2^64 with two random odd bases.
Segments are identified by 128 hash bits and the length; kernels verify symbols.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.llm.common import ID, TEXT, arrow_map, texts_of
from auditlake.operators.lookup import materialize

U64 = np.uint64
SPAN = 1 << 19          # windows of a document handled at once
SHIFT = U64(21)         # bits for a place in an array of at most 2 * SPAN + width symbols
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BUCKET_SEGMENTS = 20_000
KERNEL_SEGMENTS = 2_000


class Hashes:
    """Prefix polynomial hashes of symbol arrays for one odd base."""

    def __init__(self, base: int):
        self.base = U64(base)
        self.inverse = U64(pow(base, -1, 1 << 64))
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, step in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, step, U64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def prefixes(self, values: np.ndarray) -> np.ndarray:
        self.grow(len(values))
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out

    def of(self, prefixes: np.ndarray, start, stop) -> np.ndarray:
        """Hash of symbols [start, stop), whatever stands before them."""
        return (prefixes[stop] - prefixes[start]) * self.down[start]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(29))) * U64(0xA0761D6478BD642F)
    return x ^ (x >> U64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASES[0]))
LONG_WORD = 64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = Hashes(BASES[1])


def byte_symbols(text: bytes) -> np.ndarray:
    return BYTE_VALUES[np.frombuffer(text, np.uint8)]


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a text."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ~SPACE[np.frombuffer(text, np.uint8)]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_symbols(text: bytes) -> np.ndarray:
    """A number for each word: a polynomial hash of short words; of words over `LONG_WORD` bytes, where words of
    a regular build could meet under any base, the first 8 bytes of a BLAKE2b digest."""
    start, stop = word_bounds(text)
    _BYTES.grow(len(text))
    prefixes = _BYTES.prefixes(byte_symbols(text))
    out = mix(_BYTES.of(prefixes, start, stop) + (stop - start).astype(U64))
    for k in np.flatnonzero(stop - start > LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(text[start[k]:stop[k]], digest_size=8).digest(), "little")
    return out


SYMBOLS = {"bytes": byte_symbols, "words": word_symbols}


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[:len(values) - width + 1], out[width - span:])
    return out


def segments(pieces: list[np.ndarray], width: int, gram: int, hashes: tuple[Hashes, Hashes]):
    """(piece, start, length, h, u) arrays of the segments of symbol arrays."""
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    values = np.concatenate(pieces)
    total = len(values)
    one, two = hashes
    a, b = one.prefixes(values), two.prefixes(values)
    places = np.arange(total - gram + 1)
    grams = mix(one.of(a, places, places + gram))
    ranked = (grams >> SHIFT << SHIFT) | places.astype(U64)
    least = sliding_min(ranked, width - gram + 1)
    anchor = (least & U64((1 << int(SHIFT)) - 1)).astype(np.int64)
    starts = np.concatenate([np.arange(e - n, e - width + 1) for n, e in zip(sizes, ends)])
    owner = np.repeat(np.arange(len(sizes)), sizes - width + 1)
    chosen = anchor[starts]
    first = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.concatenate((first[1:], [len(starts)])) - 1
    lo, hi = starts[first], starts[last] + width
    u = mix(two.of(b, lo, hi) + (hi - lo).astype(U64))
    return owner[first], lo - (ends - sizes)[owner[first]], hi - lo, grams[chosen[first]].view(np.int64), u.view(np.int64)


def anchor_rows(kind: str, width: int, gram: int) -> Callable[[pa.RecordBatch], Iterator[dict]]:
    symbols = SYMBOLS[kind]
    state: dict = {}

    def flush(held: list) -> dict:
        owner, s, n, h, u = segments([x for _, _, x in held], width, gram, state["h"])
        rid = np.array([r for r, _, _ in held], np.int64)
        base = np.array([o for _, o, _ in held], np.int64)
        return {"h": h, "u": u, ID: rid[owner], "s": (base[owner] + s).astype(np.int32), "n": n.astype(np.int32)}

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        state.setdefault("h", (Hashes(BASES[0]), Hashes(BASES[1])))
        held, size = [], 0
        for rid, text in zip(batch.column(ID).to_pylist(), texts_of(batch)):
            values = symbols(text)
            for at in range(0, max(0, len(values) - width + 1), SPAN):
                piece = values[at:at + SPAN + width - 1]
                if size and size + len(piece) > SPAN:
                    yield flush(held)
                    held, size = [], 0
                held.append((rid, at, piece))
                size += len(piece)
        if held:
            yield flush(held)

    return rows


def position():
    """(rid, s) as one number that keeps their order."""
    return (F.col(ID).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("s")).cast("decimal(32,0)")


def placed(df: DataFrame) -> DataFrame:
    """rid and s from `at` (s < 2^31, so the quotient's fraction is under one half)."""
    big = F.lit(1 << 32).cast("decimal(10,0)")
    df = df.withColumn(ID, F.floor(F.col("at") / big).cast("long"))
    return df.withColumn("s", (F.col("at") - F.col(ID).cast("decimal(20,0)") * big).cast("int"))


def repeated_spans(docs: DataFrame, kind: str, width: int, gram: int, kernel: Callable, keep_first: bool,
                   hot: int = 256) -> DataFrame:
    """(rid, s, e): spans of symbols of (rid, body) rows covered by windows of
    `width` symbols that also start elsewhere: earlier, if `keep_first`, else
    anywhere. Spans may overlap and repeat. `kernel(rid, s, strings, keep_first)`
    gets rows of whole anchors of a bucket, KERNEL_SEGMENTS or up to `hot` more at a time (its
    memory is bounded by that, not by the bucket), and yields (row, from window, to window)
    of repeated windows."""
    spark = docs.sparkSession
    occ = arrow_map(docs.select(ID, TEXT).where(F.length(TEXT) > 0), anchor_rows(kind, width, gram), f"h long, u long, {ID} long, s int, n int")
    live, _ = materialize(occ.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "anchors")
    found, _ = materialize(occ.join(live, "h", "left_semi").withColumn("at", position()).select("h", "u", "n", "at"), "segments")
    firsts, _ = materialize(found.groupBy("h", "u", "n").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("c")), "distinct")
    whole = found.join(firsts.select("h", "u", "n", "at"), ["h", "u", "n", "at"], "left_anti")
    spans = placed(whole).select(ID, "s", (F.col("s") + F.col("n")).alias("e"))
    if not keep_first:
        spans = spans.union(placed(firsts.where("c > 1")).select(ID, "s", (F.col("s") + F.col("n")).alias("e")))

    shared, seen = materialize(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared",
                               total=F.sum("m"), most=F.max("m"))
    if not seen["total"]:
        return spans
    want = (placed(firsts.select("h", "n", "at").join(shared, "h").select("h", "n", "at", (F.col("m") > hot).alias("hot")))
            .groupBy(ID).agg(F.collect_list(F.struct("h", "s", "n", "hot")).alias("want")))
    strings, _ = materialize(
        arrow_map(packed(docs.select(ID, TEXT)).join(want, ID), string_rows(kind, width), f"hot boolean, h long, w long, {ID} long, s int, string binary"), "strings")
    buckets = max(1, math.ceil(seen["total"] / BUCKET_SEGMENTS))

    def bucket(table: pa.Table) -> pa.Table:
        table = table.sort_by("h")
        h, rids, places = (np.asarray(table.column(c)) for c in ("h", ID, "s"))
        edges = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))
        out, at = [], 0
        while at < len(h):       # whole anchors, KERNEL_SEGMENTS or the next anchor's end at a time
            to = int(edges[np.searchsorted(edges, min(at + KERNEL_SEGMENTS, len(h)), "left")])
            rid, s = rids[at:to], places[at:to]
            row, lo, hi = kernel(rid, s, table.column("string").slice(at, to - at).to_pylist(), keep_first)
            out.append(pa.table({ID: rid[row], "s": (s[row] + lo).astype(np.int32), "e": (s[row] + hi + width - 1).astype(np.int32)}))
            at = to
        return pa.concat_tables(out)

    part = (strings.where("not hot").select(F.pmod(F.col("h"), F.lit(buckets)).alias("bucket"), "h", ID, "s", "string")
            .groupBy("bucket").applyInArrow(bucket, f"{ID} long, s int, e int"))
    spans = spans.union(part)
    if seen["most"] > hot:
        windows = strings.where("hot").withColumn("at", position()).select("h", "w", "at")
        first = windows.groupBy("h", "w").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("c"))
        if not keep_first:
            first, _ = materialize(first, "windows")
        again = windows.join(first.select("h", "w", "at"), ["h", "w", "at"], "left_anti").select("at")
        if not keep_first:
            again = again.union(first.where("c > 1").select("at"))
        spans = spans.union(placed(again).select(ID, "s", (F.col("s") + width).alias("e")))
    return spans


def string_rows(kind: str, width: int) -> Callable[[pa.RecordBatch], Iterator[dict]]:
    """The strings of the wanted segments; of hot anchors, the windows' hashes."""
    symbols = SYMBOLS[kind]
    state: dict = {}

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        one, two = state.setdefault("h", (Hashes(BASES[0]), Hashes(BASES[1])))
        names = ("hot", "h", "w", ID, "s", "string")
        out: dict = {k: [] for k in names}

        def add(*values) -> None:
            for k, v in zip(names, values):
                out[k].append(v)

        for rid, text, want in zip(batch.column(ID).to_pylist(), unpacked(batch), batch.column("want").to_pylist()):
            if kind == "words":
                lo, hi = word_bounds(text)
            for x in want:
                if not x["hot"]:
                    s, e = x["s"], x["s"] + x["n"]
                    add(False, x["h"], 0, rid, s, text[s:e] if kind == "bytes" else text[lo[s]:hi[e - 1]])
            warm = [x for x in want if x["hot"]]
            if warm:
                values = symbols(text)
                a, b = one.prefixes(values), two.prefixes(values)
                for x in warm:
                    at = np.arange(x["s"], x["s"] + x["n"] - width + 1)
                    for h, w, s in zip(mix(one.of(a, at, at + width) + U64(x["h"] % (1 << 64))).view(np.int64).tolist(),
                                       mix(two.of(b, at, at + width)).view(np.int64).tolist(), at.tolist()):
                        add(True, h, w, rid, s, None)
            if len(out["h"]) > 20_000:
                yield out
                out = {k: [] for k in names}
        if out["h"]:
            yield out

    return rows


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted, disjoint, non-adjacent runs of (s, e) spans."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def packed(docs: DataFrame) -> DataFrame:
    """(rid, packed) and any further columns of `docs`: the texts as zstd frames, a
    third of their size in a shuffle."""
    rest = [f for f in docs.schema.fields if f.name not in (ID, TEXT)]

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        yield {ID: batch.column(ID), "packed": [squeeze(t) for t in texts_of(batch)],
               **{f.name: batch.column(f.name) for f in rest}}
    return arrow_map(docs, rows, T.StructType([T.StructField(ID, T.LongType()), T.StructField("packed", T.BinaryType()), *rest]))


def unpacked(batch: pa.RecordBatch) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(t) for t in batch.column("packed").to_pylist()]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(rid, packed, spans, further columns): every document with its spans, null without any."""
    per_doc = spans.groupBy(ID).agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    return packed(docs).join(per_doc, ID, "left")
