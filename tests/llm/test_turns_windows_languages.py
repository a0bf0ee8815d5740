import json
import time

from auditlake.llm import chat_format, language
from auditlake.llm.common import read
from auditlake.llm.decontaminate import decontaminate
from auditlake.llm.queries import registry
from tests.llm import brute
from tests.llm.conftest import frame


def test_every_turn_is_in_the_result(spark):
    """Other roles, null roles, conversations, turns and texts, with columns whose names the operator uses."""
    rows = [(1, 0, "system", "be brief", "x"), (1, 1, "user", "hi", "x"), (1, 2, "assistant", "ho", None), (1, 3, None, None, "x"), (1, 3, None, None, "x"),
            (None, 1, "user", "lost", "x"), (2, None, "assistant", "", "x"), (2, 1, "tool", "a\u0001\"é😀", "x"), (2, 2, "user", None, "x")]
    table = spark.createDataFrame([(*r, *[r[4]] * 3) for r in rows],
                                  "conv_id long, turn long, role string, text string, name string, status string, content string, depth string")
    calls, results, context = chat_format.turns_as_calls(table)
    got = chat_format.link_calls(calls, results, chat_format.REPLY, context).collect()
    kept = sorted((r.json for r in got if r.status == "context"))
    assert kept == sorted(['{"role":"system","text":"be brief","turn":0}', *['{"role":null,"text":null,"turn":3}'] * 2,
                           '{"role":"user","text":"lost","turn":1}', '{"role":"assistant","text":"","turn":null}',
                           '{"role":"tool","text":"a\\u0001\\"é😀","turn":1}'])
    assert all(r.valid is None and r.call_id is None and r.n_calls == 0 for r in got if r.status == "context")
    assert sorted((r.call_id, r.status, r.problem) for r in got if r.status != "context") == [
        ("1:1", "linked", None), ("2:2", "no_result", "missing argument text")]


def test_chat_query_covers_all_turns(spark):
    turns = read(spark, "/root/testdata/sf0.01", "conversations")
    got = registry()["op8_chat_format"](spark, "/root/testdata/sf0.01")
    rows = got.selectExpr("sum(if(status = 'context', 1, n_calls + n_results)) AS n").first().n
    assert rows == turns.count()


def test_arguments_of_any_json(spark):
    deep, schemas = "[" * 200_000 + "]" * 200_000, {"t": {"x": {"type": "number"}, "y": {"type": "array"}}}
    texts = {"surrogate": '{"x": 1, "\\ud800": 2}', "value": '{"y": ["\\ud83d", "\\ud83d\\ude00"]}', "deep": deep,
             "levels": '{"y": ' + "[" * 150 + "]" * 150 + "}", "nan": '{"x": NaN}', "infinite": '{"x": -Infinity}', "huge": '{"x": 1e999}',
             "whole": '{"x": 1.0}', "small": '{"x": 1e-7}', "twice": '{"x": "a", "x": 2}', "long": '{"x": ' + "9" * 30 + "}"}
    calls = spark.createDataFrame([(1, k, None, 1, "t", v) for k, v in texts.items()],
                                  "conv_id long, call_id string, after string, turn long, name string, arguments string")
    none = spark.createDataFrame([], "conv_id long, call_id string, content string, turn long")
    got = {r.call_id: (r.problem, json.loads(r.json)["arguments"], r.json) for r in chat_format.link_calls(calls, none, schemas).collect()}
    assert got["surrogate"][:2] == ("unknown argument \\ud800", {"x": 1, "\ud800": 2})
    assert got["value"][0] is None and '["\\ud83d","😀"]' in got["value"][2]
    assert got["deep"][0] == got["levels"][0] == "nested too deeply"
    assert {got[k][0] for k in ("nan", "infinite", "huge")} == {"not JSON"}
    assert [got[k][2].split('"x":')[1].split("}")[0] for k in ("whole", "small", "twice", "long")] == ["1", "1e-07", "2", "9" * 30]


def test_long_repetitive_text_is_decontaminated_in_linear_time(spark):
    """A text that repeats the words of an item: every window of it is a candidate."""
    item = " ".join(["a b"] * 20)
    docs = frame(spark, [(1, "x " * 50 + "a b " * 50_000, "en"), (2, "a b " * 15 + "c d", "en"), (3, "b a " * 30, "en")])
    start = time.monotonic()
    got = {r.doc_id: (r.similarity, r.start) for r in decontaminate(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert time.monotonic() - start < 90
    want = brute.contaminated([(1, "x " * 50 + "a b " * 100), (2, "a b " * 15 + "c d"), (3, "b a " * 30)], [(9, item)])
    assert got == {d: v for (d, _), v in want.items()}


def test_language_of_one_short_text_is_predicted(spark):
    """A phrase costs the logarithm of the letters learned, so a small sample doesn't lose for being small."""
    docs = read(spark, "/root/testdata/sf0.1", "documents").where("text IS NOT NULL AND lang IS NOT NULL AND length(text) BETWEEN 100 AND 4000")
    rows = sorted((r.lang, r.doc_id, r.text) for r in docs.where("doc_id % 23 = 0").select("lang", "doc_id", "text").collect())
    rest, short = [r for r in rows if r[1] % 2], "fr"
    for lang in sorted({r[0] for r in rows}):
        learned = [(of, t) for of, i, t in rows if not i % 2 and of != short]
        learned.append((short, next(t for of, i, t in rows if not i % 2 and of == short)[:115]))
        texts = [t for of, _, t in rest if of == lang][:100]
        right = sum(p == lang for p in language.judge(texts, language.learn(learned), 1024)[0])
        assert right > 0.9 * len(texts), lang
