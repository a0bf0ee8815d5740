import json
import os

import duckdb

import corpus_pipeline
from auditlake.llm import chat_format
from auditlake.llm.common import read
from auditlake.llm.decontaminate import decontaminate, drop_contaminated
from auditlake.llm.queries import oracle_sql, registry
from tests.llm import brute
from tests.llm.conftest import frame, passage

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def found(df):
    return {(r.doc_id, r.item_id): (r.similarity, r.start) for r in df.collect()}


def pairs(df, i="doc_id"):
    return [(r[0], r[1]) for r in df.select(i, "text").collect()]


def test_decontamination_equals_brute_force(spark, tricky):
    item = passage(7, 300).split()
    items = [(1, " ".join(item[20:60])), (2, " ".join(item[100:140]).upper()), (3, " ".join([*item[200:215], "zzz", *item[216:260]])),
             (4, "two words"), (5, None), (6, " "), (None, " ".join(item[20:60])), (7, passage(99, 40)), (1, " ".join(item[30:70])), (8, "a")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contaminated(pairs(tricky), items)
    assert {i for _, i in want} >= {1, 2, 4, 8}
    assert found(decontaminate(tricky, bench)) == want
    left = drop_contaminated(tricky, bench)
    assert left.columns == tricky.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in pairs(tricky)} - {d for d, _ in want}


def test_decontamination_of_slightly_changed_passages(spark):
    """Changed words near the ends keep 0.8; recall of the fingerprints is complete."""
    rows, items = [], []
    for k in range(60):
        words = passage(500 + k, 50).split()
        items.append((k, " ".join(words)))
        changed = list(words)
        for j in range(k % 4):
            changed[(0, 49, 1)[j]] = "changed"
        if k % 5 == 0:
            changed.insert(2, "added")
        rows.append((k, passage(900 + k, 30) + " " + " ".join(changed) + " " + passage(950 + k, 20), "en"))
    want = brute.contaminated([(i, t) for i, t, _ in rows], items)
    assert len(want) > 40
    assert found(decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))) == want


def test_decontamination_query(spark, empty, repeated):
    bench = read(spark, SMALL, "benchmark")
    got = found(registry()["op10_decontaminate"](spark, SMALL))
    assert got == brute.contaminated(pairs(read(spark, SMALL, "documents")), pairs(bench, "item_id"))
    assert decontaminate(empty, bench).count() == 0
    assert decontaminate(repeated, bench.limit(0)).count() == 0
    item = spark.createDataFrame([(1, passage(22, 70))], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in drop_contaminated(repeated, item).collect()) == ["1", "1", "3", "3", "None", "None"]


def test_decontamination_runs_no_python(spark):
    plan = registry()["op10_decontaminate"](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_chat_query_equals_sql(spark):
    got = registry()["op8_chat_format"](spark, LARGER)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{LARGER}/conversations.parquet'")
    want = con.sql(f"select {', '.join(got.columns)} from ({oracle_sql()['op8_chat_format']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_calls_are_ordered_validated_and_canonical(spark):
    schemas = {"add": {"x": {"type": "integer", "minimum": 0, "required": True}, "note": {"type": "string", "minLength": 2}}}
    calls = [(1, "a", None, 1, "add", '{"x": 1}'), (1, "b", "a", 2, "add", '{"note": "é<", "x": 2}'), (1, "c", "b", 3, "add", '{"x": -1}'),
             (1, "d", "gone", 4, "add", '{"x": true}'), (1, "e", "f", 5, "add", '{"x": 1}'), (1, "f", "e", 6, "add", '{"x": 1}'),
             (1, "g", "e", 7, "other", "{}"), (2, "b", "a", 1, "add", "[1]"), (2, "h", None, 2, "add", "{"), (2, "i", None, 3, "add", None),
             (2, "j", None, 4, "add", '{"x": 1, "y": 2}'), (2, "j", None, 4, "add", '{"x": 1, "y": 2}'), (None, "k", None, 1, "add", "{}"),
             (2, None, None, 1, "add", "{}"), (2, "l", None, 4, "add", '{"x": 1, "note": "n"}')]
    results = [(1, "b", "fine", 3), (1, "b", "also", 4), (1, "x", None, 9), (1, "a", None, 2), (None, "a", "z", 1)]
    out = chat_format.link_calls(
        spark.createDataFrame(calls, "conv_id long, call_id string, after string, turn long, name string, arguments string"),
        spark.createDataFrame(results, "conv_id long, call_id string, content string, turn long"), schemas)
    rows = {(r.conv_id, r.call_id): r for r in out.collect()}
    assert len(rows) == 13
    assert [rows[1, c].depth for c in "abcdefg"] == [0, 1, 2, 0, None, None, None]
    assert rows[1, "b"].json == '{"after":"a","arguments":{"note":"é<","x":2},"call_id":"b","name":"add","result":"also"}'
    assert (rows[1, "b"].status, rows[1, "b"].n_results, rows[1, "a"].status, rows[1, "c"].status, rows[1, "x"].status) == (
        "linked", 2, "linked", "no_result", "no_call")
    problems = {k: r.problem for k, r in rows.items()}
    assert problems[1, "a"] is None and problems[1, "b"] is None and rows[1, "a"].valid
    assert (problems[1, "c"], problems[1, "d"], problems[1, "e"], problems[1, "g"]) == (
        "x is too small", "x is no integer", "cycle", "unknown tool")
    assert (problems[2, "b"], problems[2, "h"], problems[2, "i"], problems[2, "j"], problems[2, "l"]) == (
        "not an object", "not JSON", "not an object", "unknown argument y", "note is too short")
    assert rows[2, "j"].n_calls == 2
    assert json.loads(rows[1, "x"].json)["result"] is None
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    none_calls, none_results, none_context = chat_format.turns_as_calls(none)
    assert chat_format.link_calls(none_calls, none_results, chat_format.REPLY, none_context).count() == 0


def test_long_chain_of_calls(spark):
    calls = [(1, str(k), str(k - 1) if k else None, k, "t", "{}") for k in range(200)]
    out = chat_format.link_calls(
        spark.createDataFrame(calls, "conv_id long, call_id string, after string, turn long, name string, arguments string"),
        spark.createDataFrame([], "conv_id long, call_id string, content string, turn long"), {"t": {}})
    assert {r.call_id: r.depth for r in out.collect()} == {str(k): k for k in range(200)}


def test_pipeline_stages_agree_with_brute_force(spark):
    docs = read(spark, SMALL, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination", "encoding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = pairs(docs.orderBy("doc_id"))
        out = corpus_pipeline.materialize(stage(spark, docs, SMALL), "test")[0]
        assert out.columns == columns
        after = dict(pairs(out))
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in registry()["op9_toxicity"](spark, SMALL).collect()}
            assert set(after) == {i for i, p in scores.items() if not p}
        elif name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in brute.classes(before, 80, 5).items() if i == c}
        elif name == "suffix_dedup":
            want = brute.suffix(before)
            assert all((after[i] == t) == (not want[i][1]) for i, t in before)
            assert all(len((after[i] or "").encode()) <= want[i][0] - want[i][1] for i, _ in before)
        else:
            bad = {d for d, _ in brute.contaminated(before, pairs(read(spark, SMALL, "benchmark"), "item_id"))}
            assert set(after) == {i for i, _ in before} - bad
        docs = out
    kept = dict(pairs(docs))
    done = {r.doc_id: bytes(r.decoded).decode() for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()}
    assert done == {i: t or "" for i, t in kept.items()}


def test_pipeline_on_odd_tables(spark, tmp_path, tricky, repeated, empty):
    read(spark, SMALL, "benchmark").write.parquet(os.path.join(tmp_path, "benchmark.parquet"))
    read(spark, SMALL, "labels").write.parquet(os.path.join(tmp_path, "labels.parquet"))
    for docs in (tricky, repeated, empty):
        docs.write.mode("overwrite").parquet(os.path.join(tmp_path, "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert out.count() <= docs.count()
