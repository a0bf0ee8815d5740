"""Cases of the second review."""

import random
from collections import Counter

from auditlake.llm import language, quality
from auditlake.llm.common import sample_texts
from auditlake.llm.decontaminate import decontaminate
from auditlake.llm.jaccard_join import keep_first
from tests.llm.conftest import frame, passage


def test_one_of_identical_rows_is_left(spark):
    """With and without an id, and beside near copies; rows without words all stay."""
    a, b, c = (passage(k, 70) for k in (61, 62, 63))
    near = " ".join([*c.split()[:-1], "changed"])
    rows = [*[(1, a, "en")] * 5, *[(None, b, "en")] * 5, *[(7, c, "en")] * 3, (8, near, "en"), (None, None, "en"), (None, None, "en"), (9, " ", "en")]
    left = keep_first(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(
        [(1, a), (None, b), (7, c), (None, None), (None, None), (9, " ")], key=str)


def similar(text, item, percent=80):
    """{start: similarity} of the best first window of the item's words, or of a shorter text as a whole."""
    w, v = text.lower().split(), item.lower().split()
    k, n = min(5, len(v)), min(len(v), len(w))
    want = Counter(tuple(v[a:a + k]) for a in range(len(v) - k + 1))
    best = (0, 0)
    for s in range(len(w) - n + 1):
        have = Counter(tuple(w[a:a + k]) for a in range(s, s + n - k + 1))
        common, total = sum((have & want).values()), sum(have.values()) + sum(want.values())
        if common and common * (100 + percent) >= percent * total and common / (total - common) > best[0]:
            best = (common / (total - common), s)
    return best if best[0] else None


def test_documents_shorter_than_the_item(spark):
    """Items less words at an end, in the middle or both, down to too few; longer documents as before."""
    rows, items = [], []
    for k, n in enumerate([5, 6, 9, 10, 13, 14, 24, 39, 60]):
        words = passage(700 + k, n).split()
        items.append((k, " ".join(words)))
        cuts = [words[:-1], words[1:], words[1:-1], words[:-2], words[:n * 3 // 4], words[:n // 2] + words[n // 2 + 1:], words[:4],
                [*words[:-2], "changed"], words, ["before", *words[:-1]]]
        rows += [(100 * k + j, " ".join(cut), "en") for j, cut in enumerate(cuts)]
    want = {(d, i): found for d, t, _ in rows for i, item in items if (found := similar(t, item))}
    assert sum(len(t.split()) < len(items[i][1].split()) for d, t, _ in rows for i in [d // 100] if (d, i) in want) > 15
    got = decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in got} == want


def test_languages_of_many_letters():
    """Three scripts of over 250 letters each; the two that sort last were one symbol."""
    r = random.Random(5)

    def words(first, n):
        pool = ["".join(chr(first + r.randrange(400)) for _ in range(r.randint(1, 3))) for _ in range(500)]
        return lambda: " ".join(r.choice(pool) for _ in range(n))

    make = {"ml": words(0x3400, 300), "yy": words(0x4E00, 300), "zz": words(0xAC00, 300)}
    sample = [(lang, make[lang]()) for lang in make for _ in range(20)]
    model = language.learn(sample)
    letters = {c for _, t in sample for c in t if c.isalpha()}
    assert len(letters) > 3 * 250
    assert len({int(model[0][ord(c)]) for c in letters} - {0, 1, 2}) == len(letters)
    texts = [make[lang]() for lang in make for _ in range(5)]
    assert language.judge(texts, model, 1024)[0] == [lang for lang in make for _ in range(5)]


def test_copies_do_not_fill_a_sample(spark):
    """The text that hashes lowest has many copies, with other ids, the same id or none."""
    rows = [(i, passage(800 + i, 30), "en") for i in range(12)]
    df = frame(spark, rows)
    first = min(df.selectExpr("xxhash64(text)", "text").collect())[1]
    df = frame(spark, rows + [(100 + k, first, "en") for k in range(30)] + [(0, first, "en"), (None, first, "en")] * 5)
    label = spark.createDataFrame([(i, "en") for i in [*range(12), *range(100, 130)]], "label_id long, label string")
    got = [t for _, t in sample_texts(df, label, 8, 1, 4000, 4000)]
    assert len(got) == len(set(got)) == 8 and first in got


def test_equal_rows_do_not_fill_the_forest(spark, monkeypatch):
    """Of 60 rows 40 have the counts that hash lowest."""
    texts = [passage(830 + i, 60 + i) for i in range(20)]
    found = [(spark.range(1).selectExpr("xxhash64(%s)" % ", ".join(f"{x}L" for x in quality.counts(t.encode()))).first()[0], t) for t in texts]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100 + i, min(found)[1], "en") for i in range(20)] + [(None, min(found)[1], "en")] * 20
    seen = []
    monkeypatch.setattr(quality, "grow_forest", lambda table, s, grow=quality.grow_forest: seen.append(table) or grow(table, s))
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    quality.quality(frame(spark, rows), labels, quality.Settings(sample=20)).count()
    assert len({tuple(row) for row in seen[0]}) > 5


def test_labels_without_a_text_of_the_wanted_length(spark):
    """All texts of `aa` are short, all of `bb` long; `cc` takes its wanted ones first."""
    rows = [(i, passage(860 + i, 3), "aa") for i in range(5)] + [(10 + i, passage(870 + i, 900), "bb") for i in range(5)]
    rows += [(20 + i, passage(880 + i, 40 if i % 2 else 3), "cc") for i in range(8)] + [(30, " ", "aa"), (31, "", "aa"), (32, None, "aa")]
    label = spark.createDataFrame([(i, lang) for i, _, lang in rows], "label_id long, label string")
    got = sample_texts(frame(spark, rows), label, 5, 100, 4000, 500)
    assert Counter(lang for lang, _ in got) == {"aa": 5, "bb": 5, "cc": 5}
    assert {len(t) for lang, t in got if lang == "bb"} == {500}
    assert [len(t) >= 100 for lang, t in got if lang == "cc"] == [True] * 4 + [False]
