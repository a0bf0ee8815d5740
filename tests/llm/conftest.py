import random

import pytest

# names that the operators use inside
CLASHING = ["rid", "body", "h", "s", "n", "spans", "packed", "kept", "score", "rest", "sid"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def passage(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def texts():
    """Texts with every awkward case: null, empty, blank, short, very long, repeated lines,
    exact and near copies, shared passages, words beyond ASCII, one long run."""
    shared, other = passage(1, 60), passage(2, 45)
    near = passage(3, 80).split()
    almost = [*near[:40], "changed", *near[41:]]
    return [None, "", " \t\n ", "a", "two words", "Été à Zürich — ñandú 😀 " * 12, shared, shared, passage(4, 30) + " " + shared,
            shared + "\n" + other + "\n" + shared, "x" * 700, "ab" * 400, passage(5, 20_000), other + " " + passage(6, 10),
            " ".join(near), " ".join(almost), " ".join(near).upper(), "a b c d e f", "a b c d e f g h i j", passage(7, 300),
            "same line of words\n" * 40, passage(5, 20_000)[:3000] + " " + passage(8, 50), passage(9, 36), "$$$ ### " * 80]


def frame(spark, rows):
    """(doc_id, text, lang) rows with all the other columns filled or null."""
    full = [(i, t, lang, "s" if k % 2 else None, None if t is None else len(t), *["x" if k % 3 else None] * len(CLASHING))
            for k, (i, t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def tricky(spark):
    return frame(spark, [(100 - i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts())])


@pytest.fixture(scope="session")
def repeated(spark):
    """Null ids, rows that repeat as a whole, and ids shared by different texts."""
    a, b, c = passage(21, 70), passage(22, 70), passage(23, 70)
    rows = [(1, a, "en"), (1, a, "en"), (1, b, "en"), (None, a, None), (None, c, None), (2, c + " " + b, "en"), (3, None, "en"), (3, None, "en")]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
