import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from auditlake.llm import near_vectors, resample, whitening
from auditlake.llm.common import read
from auditlake.llm.queries import registry
from tests.llm.conftest import passage, texts

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, rid string, unit string, digest string, entries string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], VECTORS).repartition(3)


def around(rng, centre, n, spread):
    out = centre + spread * rng.normal(size=(n, len(centre)))
    return out / np.linalg.norm(out, axis=1, keepdims=True)


# ------------------------------------------------------------------ near duplicates
def brute_groups(rows, least=0.93):
    """{position: (n_links, component)} by comparing all pairs."""
    unit = [near_vectors.unit(v) if label is not None else None for _, v, label in rows]
    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                if float(unit[a] @ unit[b]) >= least:
                    links[a].add(b), links[b].add(a)
    out = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x), todo.append(x)
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        out[k] = (len(links[k]), min(ids) if ids else None)
    return out


@pytest.fixture(scope="module")
def mixed():
    """Chains and dense groups, copies, scaled copies, other labels, and every odd vector."""
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for k in range(6):
        centre = around(rng, np.zeros(12), 1, 1)[0]
        for v in np.concatenate([around(rng, centre, 15, 0.06), around(rng, centre, 10, 0.3)]):
            rows.append((at, v.tolist(), k % 2))
            at += 1
    first = rows[0][1]
    rows += [(at + i, first, 0) for i in range(9)] + [(at + 20, [4 * x for x in first], 0), (at + 21, first, 1), (at + 22, first, None),
             (at + 23, None, 0), (at + 24, [], 0), (at + 25, [0.0] * 12, 0), (at + 26, [None] + first[1:], 0),
             (at + 27, [float("nan")] + first[1:], 0), (at + 28, [float("inf")] + first[1:], 0), (at + 29, first[:5], 0),
             (at + 30, first[:5], 0), (None, first, 0), (None, [1.0] + [0.0] * 11, 7), (3, first, 0), (3, first, 0)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("settings", [
    near_vectors.Settings(), near_vectors.Settings(block=16), near_vectors.Settings(spread=None, block=20, sample=40, most_cells=9)])
def test_groups_equal_all_pairs(spark, mixed, settings):
    got = near_vectors.near_groups(vectors(spark, mixed), settings).collect()
    want = brute_groups(mixed)
    key = lambda i, n, c, k: (-1 if i is None else i, n, -1 if c is None else c, k)
    assert sorted(key(r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted(
        key(i, *want[k], i == want[k][1]) for k, (i, _, _) in enumerate(mixed))


def test_full_margin_loses_no_link_over_many_cells(spark):
    rng = np.random.default_rng(6)
    base = around(rng, np.zeros(6), 300, 1)
    rows = [(k, v.astype(np.float32).tolist(), 1) for k, v in enumerate(np.concatenate([base, base + 0.08 * rng.normal(size=base.shape)]))]
    s = near_vectors.Settings(spread=None)
    reps = near_vectors.points(vectors(spark, rows), "vec_id", "embedding", "label")
    assert len(near_vectors.fit_cells(reps.withColumnRenamed("vec", "rid"), 40_000, s)[6]) == 25
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_groups(vectors(spark, rows), s).collect()}
    assert got == dict(enumerate(brute_groups(rows).values()))


def test_near_dedup_query_and_recall(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in read(spark, SMALL, "embeddings").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in registry()["op11_embedding_near_dedup"](spark, SMALL).collect()}
    want = brute_groups(rows)
    assert got == {rows[k][0]: w for k, w in want.items()}


def test_near_dedup_without_rows(spark):
    assert near_vectors.near_groups(vectors(spark, [])).count() == 0
    only = near_vectors.near_groups(vectors(spark, [(4, None, 1), (None, [1.0], None)])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in only) == [(0, 0, True), (4, 0, True)]


# ------------------------------------------------------------------------ whitening
def numpy_whitening(x, count):
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, total)) for row in x]
    return deviation, centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def assert_whitened(rows, ids, x, count):
    deviation, white, explained = numpy_whitening(x, count)
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(by) == len(ids) * count
    for c in range(count):
        column = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign(column @ white[:, c])
        assert np.abs(column * sign - white[:, c]).max() < 1e-9
        assert abs(by[ids[0], c + 1].explained / explained[c] - 1) < 1e-10
    assert [by[i, 1].deviation for i in ids] == deviation
    assert {r.n for r in rows} == {len(ids)} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def whole(v):
    return np.floor(1024 * np.array(v, float)).astype(np.int64) + 100_000


def test_whitening_query_equals_eigenvectors(spark):
    table = read(spark, LARGER, "embeddings").orderBy("vec_id").collect()
    rows = registry()["op12_embedding_whitening"](spark, LARGER).collect()
    assert_whitened(rows, [r.vec_id for r in table], np.stack([whole(r.embedding) for r in table]), 8)


def exploded(df):
    from pyspark.sql import functions as F
    return df.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("white").alias("at", "whitened")).selectExpr(
        "vec_id", "n", "CAST(deviation AS bigint) AS deviation", "identity_error", "at + 1 AS component", "whitened", "explained[at] AS explained").collect()


def test_whitening_leaves_out_what_it_says(spark):
    rng = np.random.default_rng(8)
    good = [(k, rng.normal(size=3).astype(np.float32).tolist(), 1) for k in range(50)]
    bad = [(100, None, 1), (101, [], 1), (102, [1.0, None, 2.0], 1), (103, [1.0, float("nan"), 2.0], 1), (104, [1.0, float("inf"), 0.0], 1),
           (105, [1.0, 2.0], 1), (106, [1.0, 1e30, 0.0], 1)]
    assert_whitened(exploded(whitening.whiten(vectors(spark, good + bad))), list(range(50)), np.stack([whole(v) for _, v, _ in good]), 3)
    assert exploded(whitening.whiten(vectors(spark, bad[:5]))) == []
    assert exploded(whitening.whiten(vectors(spark, []))) == []
    assert exploded(whitening.whiten(vectors(spark, good[:1]))) == []
    same = [(k, [1.0, 2.0, 3.0 + k % 2], 1) for k in range(4)]          # one component has variance
    assert [r.component for r in exploded(whitening.whiten(vectors(spark, same)))] == [1] * 4
    repeated = exploded(whitening.whiten(vectors(spark, good[:9] + [good[0], (None, good[1][1], None)])))
    assert len(repeated) == 33 and sum(r.vec_id is None for r in repeated) == 3


def test_deviation_stays_exact_beyond_64_bits():
    rng = np.random.default_rng(9)
    for size in (1 << 20, 1 << 40, 1 << 55, 1 << 60):
        y = rng.integers(-size, size, (20, 16))
        assert whitening.squares(y) == [sum(int(v) ** 2 for v in row) for row in y]
    far = whitening.centred([np.array([2 ** 52, 7])], 1 << 30, [5, 2 ** 70])
    assert far.tolist() == [[2 ** 82 - 5, 7 * 2 ** 30 - 2 ** 70]]


@pytest.mark.parametrize("make", [
    lambda g: np.triu(g.normal(size=(24, 24))), lambda g: np.eye(9), lambda g: np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]), lambda g: np.ones((6, 6)),
    lambda g: np.diag(np.ones(20)) + np.diag(np.ones(19), 1) * 1e-3, lambda g: np.diag(np.arange(1.0, 31)) + np.diag(np.ones(29), 1),
    lambda g: np.linalg.qr(g.normal(size=(20, 20)))[0] @ np.diag(np.r_[np.ones(8) + 1e-9 * g.random(8), 10.0 ** -np.arange(12)]),
    lambda g: np.zeros((4, 4)), lambda g: np.array([[-2.0]])])
def test_directions_of_awkward_matrices(make):
    a = make(np.random.default_rng(10))
    values, z = whitening.directions(a)
    exact = np.linalg.svd(a, compute_uv=False) ** 2
    size = max(float(exact.max()), 1e-300)
    assert np.abs(values - exact).max() <= 1e-13 * size
    assert np.abs(z.T @ z - np.eye(len(z))).max() < 1e-13 and np.abs(a.T @ (a @ z) - z * values).max() <= 1e-13 * size


def test_small_values_are_relatively_accurate():
    """A graded bidiagonal matrix whose product of values (its determinant) is known."""
    q, e = 10.0 ** -np.arange(0, 24, 2), np.full(11, 0.3) * 10.0 ** -np.arange(0, 22, 2)
    values = whitening.dqds(q, e)
    assert abs(np.log(values).sum() - np.log(q).sum()) < 1e-12


def test_triangles_meet_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = [(k, v, 0) for k, v in enumerate(np.random.default_rng(11).normal(size=(200, 4)).astype(np.float32).tolist())]
    got = exploded(whitening.whiten(vectors(spark, rows).repartition(7)))
    assert_whitened(got, list(range(200)), np.stack([whole(v) for _, v, _ in rows]), 4)


# ----------------------------------------------------------------------- resampling
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_resample(rows, target, s=resample.Settings()):
    def counts(text):
        w = WORDS.findall((text or "").translate(LOWER))
        return len(w), Counter(zlib.crc32(f.encode()) % s.buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    docs = [counts(t) for _, t in rows]
    S, T = sum((c for _, c in docs), Counter()), sum((counts(t)[1] for t in target), Counter())
    n_s, n_t = S.total() + s.buckets, T.total() + s.buckets
    gain = {b: math.floor(1000 * math.log((T[b] + 1) * n_s / ((S[b] + 1) * n_t))) for b in S}
    out = []
    for (i, _), (n, c) in zip(rows, docs):
        weight = sum(gain[b] * k for b, k in c.items()) // c.total() if c else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n])
    able = sorted((r for r in out if r[4] >= s.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[:s.percent * len(able) // 100])}
    return Counter((*r[:4], drawn.get(id(r))) for r in out)


def found(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_span_crcs_equal_zlib():
    rng = np.random.default_rng(12)
    data = rng.integers(0, 256, 60_000).astype(np.uint8)
    sizes = np.concatenate([np.arange(1, 400), [5_000, 20_001]])
    starts = rng.integers(0, 39_000, len(sizes))
    for depth in (4, 128):
        got = resample.SpanCrc(depth).spans(data, starts, sizes)
        assert got.tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts.tolist(), sizes.tolist())]


def test_long_spans_cross_the_blocks_of_the_table(monkeypatch):
    monkeypatch.setattr(resample, "FLAT_BYTES", 1000)
    data = np.random.default_rng(13).integers(0, 256, 9_000).astype(np.uint8)
    assert resample.SpanCrc(16).spans(data, np.array([5, 17]), np.array([8_000, 3])).tolist() == [
        zlib.crc32(data[5:8_005].tobytes()), zlib.crc32(data[17:20].tobytes())]


def test_resampling_equals_brute_force(spark, tricky, repeated, empty, monkeypatch):
    target = spark.createDataFrame([(passage(1, 40),), (None,), ("x" * 700 + " été",)], "text string")
    words = [r.text for r in target.collect()]
    long = spark.createDataFrame([(5, ("word " * 40 + "ñ" * 60_000 + " ") * 3), (6, "Z" * 300_000), (7, " ".join(texts()[11:13]))], "doc_id long, text string")
    for docs in (tricky, repeated, long, empty):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        s = resample.Settings(least_words=3, percent=40)
        assert found(resample.resample(docs, target, s)) == brute_resample(rows, words, s)
    rows = [(r.doc_id, r.text) for r in tricky.collect()]
    assert found(resample.resample(tricky, empty)) == brute_resample(rows, [])


def test_resampling_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SMALL, "documents").collect()]
    target = [r.text for r in read(spark, SMALL, "benchmark").collect()]
    assert found(registry()["op13_importance_resampling"](spark, SMALL)) == brute_resample(rows, target)
