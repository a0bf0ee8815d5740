import numpy as np

from auditlake.llm import bpe, jaccard_join, toxicity
from auditlake.llm.components import components
from tests.llm.conftest import frame, passage


def morse(flip, n=1024):
    """The Thue-Morse word or its complement, which polynomial hashes modulo 2^64 can't tell apart."""
    return "".join("ab"[(bin(k).count("1") + flip) % 2] for k in range(n))


def test_structured_long_words_differ(spark):
    around = passage(31, 40).split()
    rows = [(k, " ".join([*around[:20], morse(k), *around[20:]]), "en") for k in range(2)]
    docs = frame(spark, rows)
    assert {r.component_id for r in jaccard_join.jaccard_join(docs, 85).collect()} == {0, 1}


def test_frequent_shingles_come_last_and_change_no_class(spark, monkeypatch):
    shared = passage(41, 30)
    rows = [(k, f"{shared} {passage(100 + k // 3, 60)} tail{k % 3}", "en") for k in range(60)]
    docs = frame(spark, rows)
    want = {k: k - k % 3 for k in range(60)}
    plain = docs.selectExpr("doc_id AS rid", "text AS body")
    known, counts = jaccard_join.frequent_shingles(plain, 60, 4)
    assert counts.max() == 60 and len(known) >= 27
    hashes = jaccard_join.shingle_set(rows[0][1].encode())
    ordered = jaccard_join.in_order(hashes, (known, counts))
    assert sorted(ordered) == hashes.tolist() and set(known[counts == 60]) == set(ordered[-27:])
    for hot in (1, 64):
        got = jaccard_join.jaccard_join(docs, 80, hot=hot)
        assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_edges_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)
    edges = spark.range(0, 40, numPartitions=2)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    made = edges.mapInArrow(count, "id long").selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in components(made).collect()} == {0} and seen.value == 40


def sample():
    rng = np.random.default_rng(3)
    clean = [passage(1000 + k, 60) for k in range(60)]
    bad = [" ".join(np.insert(t.split(), rng.integers(0, 59), ["zzgrunk", "vqquark"])) for t in clean]
    return [(0, t) for t in clean] + [(1, t) for t in bad]


def test_a_leading_word_moves_no_score():
    s = toxicity.Settings(steps=60, buckets=1 << 12)
    values, bias = toxicity.train(sample(), s)
    memo = toxicity.Memo(lambda w: float(values[toxicity.grams(w, s)].mean()), 1 << 10)
    score = lambda t: bias + toxicity.strongest(toxicity.words_of(t), memo, s.passage)
    for label, text in sample():
        assert (score(text) > 0) == bool(label)
        assert abs(score("the " + text) - score(text)) < 1e-9 or score("the " + text) > score(text)


def test_passages_are_all_runs_of_words():
    words, begin, vocabulary = toxicity.passages([(1, "a b c"), (0, "d"), (1, "!!"), (0, "b a")], toxicity.Settings())
    assert [[vocabulary[w] for w in row] for row in words] == [["a", "b"], ["b", "c"], ["d", "d"], ["", ""], ["b", "a"]]
    assert begin.tolist() == [0, 2, 3, 4]


def test_codec_stays_with_the_worker():
    made = []
    load = lambda: made.append(1) or ({bytes([c]): c for c in range(256)}, bpe.load_pattern())
    assert bpe.worker_codec("x", load) is bpe.worker_codec("x", load) and made == [1]
    assert bpe.worker_codec("y", load) is not None and list(bpe._CODECS) == ["y"]
