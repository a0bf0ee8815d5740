import zlib

import numpy as np
import tiktoken

from auditlake.llm import bpe, language, quality, toxicity, url_filter
from auditlake.llm.common import read
from auditlake.llm.queries import registry
from tests.llm import brute
from tests.llm.conftest import texts

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def encoding():
    ranks = bpe.load_ranks()
    return ranks, tiktoken.Encoding("own", pat_str=bpe.load_pattern(), mergeable_ranks=ranks, special_tokens={})


def test_codec_equals_tiktoken_and_round_trips():
    ranks, exact = encoding()
    codec = bpe.Codec(ranks, bpe.load_pattern())
    odd = ["a\x1cb \x85c", "  lead", "trail \n", "a  b\n\n c\t d", "it's we'LL", "<|endoftext|>", "e\u0301 \u200b x", "\u3000a b"]
    for text in [t or "" for t in texts()] + odd:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == exact.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_merge_of_a_piece_takes_the_leftmost_least_rank():
    ranks = {bytes([c]): c for c in range(256)} | {b"ab": 300, b"bc": 299, b"aa": 301}
    assert bpe.merge(b"abc", ranks) == [97, 299]
    assert bpe.merge(b"aaaaa", ranks) == [301, 301, 97]
    assert bpe.merge(b"x", ranks) == [120]


def test_memo_stays_small():
    ranks, _ = encoding()
    memo = bpe.Memo(lambda t: t.encode(), 10)
    for k in range(100):
        memo.add(str(k))
    assert len(memo.young) <= 10 and len(memo.old) <= 10


def test_bpe_query(spark, empty, repeated):
    _, exact = encoding()
    got = {r.doc_id: r for r in registry()["op5_bpe"](spark, SMALL).collect()}
    for r in read(spark, SMALL, "documents").select("doc_id", "text").collect():
        ids = np.array(exact.encode_ordinary(r.text or ""), "<u4").tobytes()
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids) // 4, brute.sha(ids))
        assert got[r.doc_id].decoded_sha256 == brute.sha((r.text or "").encode())
    assert bpe.encoded(empty).count() == 0 and bpe.encoded(repeated).count() == repeated.count()


def test_language_parse_equals_brute_force():
    sample = [("xx", "abcabd abd cab"), ("yy", "hello world, hold"), ("zz", "Été où ça")]
    codes, letters, tables = language.learn(sample)
    learned = [bytes(language.coded(t, codes).tolist() + [1]) for _, t in sample]
    probes = [language.coded(t, codes) for t in ("abdabc hello zq", "world hold", "", "1 2 3", "ça où abd" * 5)]
    got = language.phrases(probes, letters, tables, 1024)
    for k, probe in enumerate(probes):
        assert got[:, k].tolist() == [brute.languages_phrases(bytes(probe), x) for x in learned]
    # blocks cut phrases: at most one more per cut
    cut = language.phrases(probes, letters, tables, 4)
    assert (cut >= got).all() and (cut <= got + np.array([-(-len(p) // 4) for p in probes])).all()


def test_language_query(spark, empty):
    docs = read(spark, LARGER, "documents")
    got = {r.doc_id: r for r in registry()["op7_language_id"](spark, LARGER).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(truth)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identified(empty, language.fit(empty)).count() == 0


def test_language_of_odd_texts(spark, tricky, repeated):
    docs = read(spark, SMALL, "documents")
    rows = {r.doc_id: r for r in language.identified(tricky, language.fit(docs)).collect()}
    assert all(rows[100 - k].lang_pred == "und" and rows[100 - k].score == 0 for k in (0, 1, 2, 23))
    assert rows[96].lang_pred != "und"
    assert language.identified(repeated, language.fit(docs)).count() == repeated.count()


def test_quality_counts_equal_brute_force():
    for t in texts():
        assert quality.counts((t or "").encode()) == brute.quality(t)
    assert quality.counts("a b c a b c".encode()) == brute.quality("a b c a b c")


def test_quality_query(spark, empty, repeated):
    labels = read(spark, LARGER, "labels")
    rows = registry()["op4_quality_rules"](spark, LARGER).join(labels, "doc_id").collect()
    texts_of = {r.doc_id: r.text for r in read(spark, LARGER, "documents").collect()}
    for r in rows[:60]:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(texts_of[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert not any(r.kept and r.base_failed for r in rows)
    passed = [r for r in rows if not r.base_failed]
    good, bad = ([r for r in passed if r.quality == q] for q in (1, 0))
    assert sum(not r.kept for r in good) <= 0.02 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)
    assert quality.quality(empty, labels).count() == 0
    assert quality.quality(repeated, labels.limit(0)).count() == repeated.count()


def test_isolation_forest_puts_outliers_first():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(0, 1, (2000, 3)), rng.normal(9, 1, (10, 3))])
    score = quality.anomaly(rows, quality.grow_forest(rows))
    assert set(np.argsort(-score)[:10]) == set(range(2000, 2010))


def test_toxicity_query(spark, empty, repeated):
    labels = read(spark, LARGER, "labels")
    got = registry()["op9_toxicity"](spark, LARGER)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == read(spark, LARGER, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    caught = [r.predicted for r in held if r.toxic]
    assert right > 0.9 and sum(caught) / len(caught) > 0.6
    model = toxicity.fit(empty, labels)
    assert toxicity.scored(empty, model).count() == 0
    assert toxicity.scored(repeated, model).where("score != 0").count() == 0


def test_misspellings_share_ngrams():
    import random
    r = random.Random(4)
    clean = ["".join(r.choice("aeiounrt") for _ in range(r.randint(3, 8))) for _ in range(200)]
    sample = []
    for k in range(400):
        words = [r.choice(clean) for _ in range(30)]
        if k % 2:
            words[r.randrange(30)] = "stupid" if k % 4 == 1 else "worthless"
        sample.append((k % 2, " ".join(words)))
    s = toxicity.Settings(steps=80)
    values, bias = toxicity.train(sample, s)

    def score(word):
        g = toxicity.grams(word, s)
        return bias + values[g].sum() / len(g)

    assert min(score("stuupid"), score("worthles"), score("stupidd")) > max(score(w) for w in clean)


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/1", "x://example.net/es/", "x://example.net/es",
            "x://net/fr/a", "a://b.org", "a://b.org?x://c", "://", "http://notexample.com/en/", "http://com/", "http://xcom/", "h://É.org/ß é"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(None, urls[3], "<p>x</p>"), (3, urls[3], "")],
                               "page_id long, url string, html string")
    rows = url_filter.url_filter(df).collect()
    assert len(rows) == len(urls) + 2
    by = {r.page_id: r for r in rows}
    for i, u in enumerate(urls):
        assert (by[i].host, by[i].path) == brute.url(u)
    assert [by[i].rule for i in (3, 4, 5, 6, 7, 11, 12, 13)] == [
        "example.com/en/", "www.example.com/en/", "net/es/", None, "net/fr/", "com/", "com/", None]
    assert [by[i].verdict for i in (3, 4, 5, 7, 11)] == ["block", "allow", "block", "block", "allow"]
    assert url_filter.url_filter(df.limit(0)).count() == 0


def test_segmentation():
    counts = {"cheap": 50, "pills": 40, "the": 500, "rapist": 3, "therapist": 20, "a": 300}

    def split(part):
        found = {(i, j): counts[part[i:j]] for i in range(len(part)) for j in range(i + 1, len(part) + 1) if part[i:j] in counts}
        return url_filter.segment(part, found, sum(counts.values()) + url_filter.UNSEEN)

    assert split("cheappills") == ["cheap", "pills"]
    assert split("therapist") == ["therapist"]
    assert split("qqcheap") == ["qq", "cheap"]
    assert split("") == []


def test_url_query_equals_naive_bayes_in_python(spark):
    import math
    import re
    from collections import Counter
    pages = read(spark, SMALL, "pages")
    words = Counter(w for r in pages.collect() for w in re.split(r"[\W_]+", re.sub(r"<[^>]*>", " ", r.html or "").lower()) if w)
    total = sum(words.values()) + url_filter.UNSEEN

    def tokens(host, path):
        out = []
        for part in filter(None, re.split(r"[._\-]+", host)):
            found = {(i, j): words[part[i:j]] for i in range(len(part)) for j in range(i + 1, min(len(part), i + 24) + 1) if part[i:j] in words}
            out += url_filter.segment(part, found, total)
        return out + ["/" + ("0" if t.isdigit() else t) for t in re.split(r"[\W_]+", path.lower()) if t]

    rows = registry()["op3_url_filter"](spark, SMALL).collect()
    seen = {"block": Counter(), "allow": Counter()}
    ruled = Counter()
    for r in rows:
        if r.rule:
            seen[r.verdict].update(tokens(r.host, r.path))
            ruled[r.verdict] += 1
    known = set()
    for r in rows:
        known.update(tokens(r.host, r.path))
    size = {k: sum(c.values()) + len(known) for k, c in seen.items()}
    for r in rows:
        if not r.rule:
            score = round(1e6 * math.log(ruled["block"] / ruled["allow"])) + sum(
                round(1e6 * (math.log((seen["block"][t] + 1) / size["block"]) - math.log((seen["allow"][t] + 1) / size["allow"])))
                for t in tokens(r.host, r.path))
            assert r.verdict == ("block" if score > 0 else "allow")
