"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A text is cut by the vocabulary's pattern; a piece that is a token is taken
whole, any other is merged pair by pair. A segment tree over the piece's byte
positions keeps the leftmost pair of least rank: the root names the next merge,
and each merge makes three point updates (the merged pair, its right part, its
left neighbour), each logarithmic in the piece. Pieces without white space
runs are short, but a piece may be as long as its text, which stays n log n.

Ids of short pieces are kept in caches of bounded size per Python worker, which serve all
its tasks until one of another operator frees them.

Defined cases: a null text is empty and has no tokens; special tokens are
ordinary text; bytes that aren't UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import _HELD as _CODECS  # noqa: F401  one thing is held at a time
from auditlake.llm.common import ID, TEXT, Memo, arrow_map, held, read, texts_of
from auditlake.session import prepare

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_PIECES = 1 << 18
NEVER = 1 << 60


def load_ranks(name: str = VOCABULARY, path: str | None = None) -> dict[bytes, int]:
    """Ranks of a vocabulary file: `path`, or `name` among the public tokenizers."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(name)
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a piece: merges by least rank, leftmost first. A tree node
    holds the least `rank * leaves + position` below it."""
    n = len(piece)
    leaves = 1 << max(0, n - 1).bit_length()
    none = NEVER * leaves
    known = ranks.get
    tree = [none] * (2 * leaves)
    for i in range(n - 1):
        found = known(piece[i:i + 2])
        if found is not None:
            tree[leaves + i] = found * leaves + i
    for node in range(leaves - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    stop = list(range(1, n + 1))              # end of the live token that starts at i
    left = list(range(-1, n))                 # start of the live token before it

    def put(i: int, value: int) -> None:
        node = leaves + i
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
            if tree[node] == value:
                return
            tree[node] = value

    def pair(i: int, end: int) -> int:
        found = known(piece[i:end])
        return none if found is None else found * leaves + i

    while (least := tree[1]) < none:
        i = least & leaves - 1
        j = stop[i]
        stop[i] = end = stop[j]
        left[end] = i
        if tree[leaves + j] < none:
            put(j, none)
        put(i, pair(i, stop[end]) if end < n else none)
        before = left[i]
        if before >= 0:
            put(before, pair(before, end))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:stop[at]]])
        at = stop[at]
    return out


class Codec:
    """Encodes texts to little-endian unsigned 32-bit ids and back.

    A single space between two characters that aren't white space always starts
    a new match of the pattern, so a text is first cut there, and the cuts'
    ids are kept; only new ones go through the pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.odd_space = re.compile(r"\A\s|\s\s|\s\Z").search
        self.cut = re.compile(r"(?<=\S)(?= \S)").split
        self.words, self.pieces = Memo(self.word, CACHE_PIECES), Memo(self.piece, CACHE_PIECES)
        order = sorted(ranks, key=ranks.get)
        most = max(ranks.values(), default=-1) + 1
        self.sizes, self.places = np.zeros(most, np.int64), np.zeros(most, np.int64)
        where = [ranks[t] for t in order]
        self.sizes[where] = sizes = [len(t) for t in order]
        self.places[where] = np.cumsum(sizes) - sizes
        self.blob = np.frombuffer(b"".join(order), np.uint8)

    def piece(self, text: str) -> bytes:
        raw = text.encode()
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else merge(raw, self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, text: str) -> bytes:
        known, add = self.pieces.young.get, self.pieces.add
        return b"".join([known(p) or add(p) for p in self.find(text)])

    def encode(self, text: str) -> bytes:
        if self.odd_space(text):
            cuts = self.cut(text)
        else:
            first, *rest = text.split(" ")
            cuts = [first, *map(" ".__add__, rest)]
        add = self.words.add
        out = []
        for at in range(0, len(cuts), 4096):
            known = self.words.young.get
            out += [known(w) or add(w) for w in cuts[at:at + 4096]]
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4")
        sizes = self.sizes[tokens]
        shift = self.places[tokens] - (np.cumsum(sizes) - sizes)
        return self.blob[np.repeat(shift, sizes) + np.arange(sizes.sum())].tobytes()


def worker_codec(name: str, load: Callable[[], tuple]) -> Codec:
    """The codec of this Python worker, with the memos of the tasks before, until a task of another operator."""
    return held(name, lambda: Codec(*load()))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """(id, ids binary, n_tokens, decoded binary): ids little-endian unsigned 32-bit,
    decoded from them again. One row per input row, whatever its id. The ranks
    (a fixed file below 1 MB) go to the executors once, as a broadcast."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast((load_ranks(path=ranks_path), load_pattern()))
    name = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}" if ranks_path else VOCABULARY

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        codec = worker_codec(name, lambda: shared.value)
        ids = [codec.encode(t.decode("utf-8", "replace")) for t in texts_of(batch)]
        yield {ID: batch.column(ID), "ids": ids, "n_tokens": [len(x) // 4 for x in ids],
               "decoded": [codec.decode(x) for x in ids]}

    rows_in = docs.select(F.col(id_col).cast("long").alias(ID), F.col(text_col).alias(TEXT))
    return arrow_map(rows_in, rows, f"{ID} long, ids binary, n_tokens long, decoded binary", keeps=True).withColumnRenamed(ID, id_col)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
