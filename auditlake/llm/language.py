"""Language identification by cross-parsing.

For every language a suffix automaton holds all substrings of a bounded sample
of its labelled texts. A text is parsed greedily into the longest phrases that
occur in the sample; a phrase costs the logarithm of the letters learned (what pointing into
that sample takes), and the language with the least cost wins: its text is the cheapest code
book (cross-parsing entropy). A language of little labelled text so isn't beaten for being short.

The automaton's transitions lie in one hashed row, at the place of their state plus
the letter, so a step is a look-up and its memory follows the sample, not the number of
letters; a letter that a state lacks ends the phrase and restarts at the root. Texts
are walked in blocks of `block` letters, thousands side by side in numpy; phrases
end at block ends, for every language alike, so long texts cost no more per letter.

Defined cases: texts that are null or have no letters are `und` with score 0;
a tie goes to the first language in sort order; rows without id or lang teach
nothing; without any usable row everything is `und`. The score is the
gap to the second-best language, 1 - cost / cost (1 with a single language).
Every input row gives one output row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import ID, TEXT, arrow_map, id_remainder, read, sample_texts, texts_of
from auditlake.session import prepare

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """The sample holds, of each language, `rows` texts, those of `shortest` to `longest`
    characters first (of a longer text the first `longest` characters), of which whole texts up to `letters` letters in all are learned
    (fewer if more than `languages` languages share the space)."""
    rows: int = 64
    shortest: int = 100
    longest: int = 4000
    letters: int = 12_000
    languages: int = 8
    block: int = 1024


class Table(NamedTuple):
    """The step of state s with letter c is `step[place[s] + c]` where s owns that place;
    else the open phrase ends and `root[c]` starts the next."""
    root: np.ndarray
    place: np.ndarray
    owner: np.ndarray
    step: np.ndarray
    bits: float           # what a phrase costs: the logarithm of the letters learned

    def after(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        at = self.place.take(state) + code
        return np.where(self.owner.take(at) == state, self.step.take(at), self.root.take(code) + (state > 0))


class Automaton:
    """Suffix automaton of a sequence of letter codes."""

    def __init__(self, codes: list[int]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        last = 0
        for c in codes:
            last = self.add(last, c)

    def add(self, last: int, c: int) -> int:
        now = self.state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = now
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            if self.size[q] == self.size[p] + 1:
                self.link[now] = q
            else:
                twin = self.state(self.size[p] + 1, dict(self.step[q]), self.link[q])
                self.link[q] = self.link[now] = twin
                while p >= 0 and self.step[p].get(c) == q:
                    self.step[p][c] = twin
                    p = self.link[p]
        return now

    def state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def table(self, letters: int) -> Table:
        """Steps as 4 * next state + phrases ended. Code 0 pads: it ends an open phrase."""
        root = np.full(letters, 1, np.int32)      # a letter the root lacks is a phrase by itself
        root[0] = 0
        for c, to in self.step[0].items():
            root[c] = 4 * to
        size = 1 << (8 * sum(map(len, self.step))).bit_length()
        place = np.zeros(len(self.step), np.int32)
        owner, step = np.full(size + letters, -1, np.int32), np.zeros(size + letters, np.int32)
        taken = bytearray(size + letters)
        for s in sorted(range(1, len(self.step)), key=lambda s: -len(self.step[s])):
            at = s * 2654435761 % size
            while any(taken[at + c] for c in self.step[s]):
                at = (at + 1) % size
            place[s] = at
            for c, to in self.step[s].items():
                taken[at + c], owner[at + c], step[at + c] = 1, s, 4 * to
        return Table(root, place, owner, step, float(np.log2(max(2, max(self.size)))))


def letter_codes(texts: list[str]) -> np.ndarray:
    """Code of every code point: 1 between words, 2 for a letter of no text, then
    all letters of `texts`, lower-cased. Codes are as many bytes wide as their number
    needs; 0 is left for padding."""
    found = sorted({c for t in texts for c in t.lower() if c.isalpha()})
    table = np.ones(0x110000, np.min_scalar_type(len(found) + 2))
    table[[p for p in range(0x110000) if chr(p).isalpha()]] = 2
    for k, c in enumerate(found):
        table[ord(c)] = k + 3
    return table


def coded(text: str, codes: np.ndarray) -> np.ndarray:
    """Letter codes of a text, runs of other characters as one gap, without gaps at the ends."""
    out = codes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    gap = out == 1
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    out = out[keep]
    if len(out) and out[-1] == 1:
        out = out[:-1]
    return out


def learn(sample: list[tuple[str, str]], s: Settings = Settings()) -> tuple[np.ndarray, int, dict[str, Table]]:
    """(letter codes, number of codes, automaton table of each language)."""
    codes = letter_codes([t for _, t in sample])
    letters = int(codes.max(initial=2)) + 1
    languages = sorted({lang for lang, _ in sample})
    most = s.letters * s.languages // max(s.languages, len(languages))
    tables = {}
    for lang in languages:
        learned: list[int] = []
        for of, text in sample:
            if of == lang:
                one = coded(text, codes).tolist()
                if one and (not learned or len(learned) + len(one) < most):
                    learned += [*one, 1]
        tables[lang] = Automaton(learned).table(letters)
    return codes, letters, tables


def phrases(texts: list[np.ndarray], letters: int, tables: dict[str, Table], block: int) -> np.ndarray:
    """[language, text] numbers of phrases."""
    counts = [-(-len(t) // block) for t in texts]
    owner = np.repeat(np.arange(len(texts)), counts)
    sizes = np.concatenate([np.minimum(block, len(t) - np.arange(0, len(t), block)) for t in texts]) if sum(counts) else np.zeros(0, int)
    order = np.argsort(-sizes, kind="stable")             # longest first: a step walks a shrinking front
    width = int(sizes.max(initial=0))
    grid = np.zeros((len(order), width + 1), np.min_scalar_type(letters - 1))
    flat = [t[at:at + block] for t in texts for at in range(0, len(t), block)]
    for row, k in enumerate(order):
        grid[row, :len(flat[k])] = flat[k]
    grid = np.ascontiguousarray(grid.T).astype(np.int32)
    live = np.searchsorted(-sizes[order], -np.arange(width + 1), "right")   # blocks with at least that many letters
    out = np.zeros((len(tables), len(texts)), np.int64)
    for at, table in enumerate(tables.values()):
        state, total = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
        for k in range(width + 1):
            n = live[k]
            found = table.after(state[:n], grid[k, :n])
            total[:n] += found & 3
            state[:n] = found >> 2
        np.add.at(out[at], owner[order], total)
    return out


def judge(texts: list[str], model: tuple, block: int) -> tuple[list[str], list[float]]:
    codes, letters, tables = model
    read = [coded(t, codes) for t in texts]
    names = list(tables)
    bits = np.array([t.bits for t in tables.values()])
    found = phrases(read, letters, tables, block) if names else np.zeros((0, len(texts)))
    langs, scores = [], []
    for k, text in enumerate(read):
        if not names or not (text >= 2).any():
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        column = found[:, k] * bits
        best = int(column.argmin())
        rest = np.delete(column, best)
        langs.append(names[best])
        scores.append(float(1 - column[best] / rest.min()) if len(rest) else 1.0)
    return langs, scores


def fit(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple:
    label = (docs.where(F.col(lang_col).isNotNull() & (id_remainder(id_col, 5) != 0))
             .groupBy(F.col(id_col).alias("label_id")).agg(F.min(lang_col).alias("label")))
    return learn(sample_texts(docs, label, s.rows, s.shortest, s.longest, s.longest, id_col, text_col), s)


def identified(docs: DataFrame, model: tuple, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        langs, scores = judge([t.decode("utf-8", "replace") for t in texts_of(batch)], shared.value, s.block)
        yield {ID: batch.column(ID), "lang_pred": langs, "score": scores}

    rows_in = docs.select(F.col(id_col).cast("long").alias(ID), F.col(text_col).alias(TEXT))
    out = arrow_map(rows_in, rows, f"{ID} long, lang_pred string, score double").withColumnRenamed(ID, id_col)
    return out.select(id_col, F.coalesce(id_remainder(id_col, 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identified(docs, fit(docs))
