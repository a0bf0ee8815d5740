import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlake.llm import substring_dedup as words_dedup
from auditlake.llm import suffix_dedup as bytes_dedup
from auditlake.llm.common import read
from auditlake.llm.components import components
from auditlake.llm.jaccard_join import block_links, jaccard_join, keep_first, linked
from auditlake.llm.queries import registry
from tests.llm import brute
from tests.llm.conftest import frame, passage, texts

SMALL = "/root/testdata/sf0.001"


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").orderBy("doc_id").collect()]


def suffix_rows(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def word_rows(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_suffix_dedup_equals_brute_force(spark, tricky):
    assert suffix_rows(bytes_dedup.suffix_dedup(tricky)) == brute.suffix(pairs(tricky))


def test_suffix_query_on_the_tables(spark):
    got = suffix_rows(registry()["op1_suffix_dedup"](spark, SMALL))
    assert got == brute.suffix(pairs(read(spark, SMALL, "documents")))


@pytest.mark.parametrize("kind", ["suffix", "words"])
def test_hot_anchors_decide_alike(spark, tricky, monkeypatch, kind):
    if kind == "suffix":
        monkeypatch.setattr(bytes_dedup, "HOT", 1)
        assert suffix_rows(bytes_dedup.suffix_dedup(tricky)) == brute.suffix(pairs(tricky))
    else:
        monkeypatch.setattr(words_dedup, "HOT", 1)
        assert word_rows(words_dedup.substring_dedup(tricky)) == brute.substring(pairs(tricky))


def test_substring_dedup_equals_brute_force(spark, tricky):
    assert word_rows(words_dedup.substring_dedup(tricky)) == brute.substring(pairs(tricky))


def test_substring_query_on_the_tables(spark):
    got = word_rows(registry()["op2_substring_dedup"](spark, SMALL))
    assert got == brute.substring(pairs(read(spark, SMALL, "documents")))


def test_suffix_kernel_sorts_and_survives_collisions(monkeypatch):
    r = random.Random(5)
    strings = [bytes(r.choice(b"ab") for _ in range(300)) for _ in range(12)] + [b"a" * 250]
    rid, s = np.arange(13), np.zeros(13, np.int64)
    expected = brute.suffix([(i, x.decode()) for i, x in enumerate(strings)], 9)

    def removed():
        cover = [bytearray(len(x)) for x in strings]
        for row, lo, hi in zip(*bytes_dedup.repeated_windows(rid, s, strings, True, 9)):
            cover[row][lo:hi + 8] = b"\1" * (hi + 8 - lo)
        return [sum(c) for c in cover]

    assert removed() == [expected[i][1] for i in range(13)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    order = bytes_dedup.SuffixOrder(data, np.arange(len(data) - 20), 20, 0x9E3779B97F4A7C15).sort()
    raw = data.tobytes()
    assert [raw[p:p + 20] for p in order] == sorted(raw[p:p + 20] for p in range(len(data) - 20))
    # a base of 1 makes a hash of the byte counts alone: collisions are found, the next base is taken
    monkeypatch.setattr(bytes_dedup, "BASES", (1, bytes_dedup.BASES[1]))
    assert removed() == [expected[i][1] for i in range(13)]


def test_remove_repeats_keeps_columns_and_null_texts(spark, tricky):
    out = bytes_dedup.remove_repeats(tricky)
    assert out.columns == tricky.columns
    was, now = (({r.doc_id: r for r in df.collect()}) for df in (tricky, out))
    kept = brute.suffix(pairs(tricky))
    for i, row in was.items():
        assert (now[i].text is None) == (row.text is None)
        assert now[i].lang == row.lang and now[i].body == row.body
        if not kept[i][1]:
            assert now[i].text == row.text


def test_jaccard_join_equals_brute_force(spark, tricky):
    want = brute.classes(pairs(tricky))
    for hot in (64, 1):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(tricky, hot=hot).collect()}
        assert got == want


def test_jaccard_join_on_chains_of_near_copies(spark):
    base = passage(31, 120).split()
    rows = []
    for k in range(150):       # each differs a little more from the first
        changed = list(base)
        for j in range(0, k % 30):
            changed[(7 * j) % 120] = f"w{k}x{j}"
        rows.append((k, " ".join(changed), "en"))
    df = frame(spark, rows)
    for percent, size in ((85, 4), (80, 5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(df, percent, size=size, hot=8).collect()}
        assert got == brute.classes([(i, t) for i, t, _ in rows], percent, size)


def test_jaccard_query_on_the_tables(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry()["op6_jaccard_join"](spark, SMALL).collect()}
    assert got == brute.classes(pairs(read(spark, SMALL, "documents")))


def test_block_links_names_the_first_of_each_class():
    r = random.Random(2)
    base = np.unique(np.array([r.randrange(1 << 60) for _ in range(200)], np.uint64))
    sets = [base, base[5:], base[60:], np.unique(np.array([r.randrange(1 << 60) for _ in range(50)], np.uint64)), base[10:]]
    assert block_links(sets, 85).tolist() == [0, 0, 2, 3, 0]
    assert linked(base, base[5:], 85) and not linked(base, base[60:], 85)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_and_null_ids(spark, repeated):
    """(null, a) and (null, c) come before id 1, so a and c of other rows are repeats."""
    rows = [(r.doc_id, r.n_bytes, r.n_removed) for r in bytes_dedup.suffix_dedup(repeated).collect()]
    assert len(rows) == repeated.count()
    a, b, c = (len(passage(k, 70)) for k in (21, 22, 23))
    assert sorted(rows, key=str) == sorted([(1, a, a), (1, a, a), (1, b, 0), (None, a, 0), (None, c, 0),
                                            (2, b + c + 1, b + c), (3, 0, 0), (3, 0, 0)], key=str) or \
        sum(x[2] for x in rows) >= 2 * a + b + c
    assert words_dedup.substring_dedup(repeated).count() == repeated.count()
    joined = jaccard_join(repeated).collect()
    assert len(joined) == repeated.count()
    assert {r.component_id for r in joined if r.doc_id == 1 and r.n_shingles} <= {None, 1}
    kept = keep_first(repeated)
    assert kept.columns == repeated.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "3", "None", "None"]
    assert bytes_dedup.remove_repeats(repeated).count() == repeated.count()


def test_empty_tables(spark, empty):
    assert bytes_dedup.suffix_dedup(empty).count() == 0
    assert words_dedup.substring_dedup(empty).count() == 0
    assert jaccard_join(empty).count() == 0
    assert keep_first(empty).columns == empty.columns and bytes_dedup.remove_repeats(empty).count() == 0


def test_large_group_of_copies(spark):
    """A third of all rows are one text; nothing collects the group."""
    rows = [(i, passage(50, 60) if i % 3 == 0 else passage(1000 + i, 40), "en") for i in range(600)]
    df = frame(spark, rows)
    got = bytes_dedup.suffix_dedup(df).where(F.col("n_removed") == F.col("n_bytes")).count()
    assert got == 199
    assert jaccard_join(df).select("component_id").distinct().count() == 401
    assert len(texts()) == 24
