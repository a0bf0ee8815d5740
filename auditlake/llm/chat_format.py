"""Chat formatting: links tool calls with their results and serialises them.

Calls (conv_id, call_id, after, turn, name, arguments as JSON text) and results (conv_id,
call_id, content) meet in a hash join on the identifier. A call may come
`after` one other call of its conversation; its depth in that order is found by
pointer jumping (log2 of the longest chain joins), so a conversation is never collected
into one task however long it is, and (depth, turn, call_id) is a topological order.
Arguments are checked against the schema of the call's tool and written as canonical
JSON: keys sorted, no white space, UTF-8, whole numbers without a fraction (1.0 is 1), lone
surrogates as \\u escapes. Turns that are neither calls nor results are `context`:
one row each, with the canonical JSON of role, turn and text.

Defined cases: a call without result is `no_result`, a result without call `no_call`
(depth 0, no name, not valid); a repeated identifier keeps its least arguments or
content, and `n_calls` and `n_results` say how many rows it had; a call that follows an
unknown one, or none, has depth 0; calls on a cycle have depth null and are not valid;
arguments that aren't a JSON object, unknown tools, and null arguments are not
valid (`problem` says why), nor are texts that nest deeper than `DEEPEST` or hold numbers
beyond a double, NaN or Infinity; the last of equal keys of an object counts. Calls and results with a null
conversation or identifier are left out of `link_calls`; `turns_as_calls` makes such turns, and those of
any other role or none, context (valid null), so every row of a conversation is in the result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import arrow_map, read
from auditlake.operators.lookup import materialize
from auditlake.session import prepare

# the tool that a plain user turn calls, as a schema
REPLY = {"reply": {"text": {"type": "string", "minLength": 1, "required": True},
                   "turn": {"type": "integer", "minimum": 0, "required": True}}}
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}
DEEPEST = 100
SURROGATE = re.compile("[\ud800-\udfff]")


def number(text: str) -> int | float:
    value = float(text)
    if math.isinf(value):
        raise ValueError("beyond a double")
    return int(value) if value.is_integer() and abs(value) < 1 << 53 else value


def no_number(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


def depth_of(value: object) -> int:
    """Levels of arrays and objects."""
    level, here = 0, [value]
    while here := [x for x in here if isinstance(x, (dict, list))]:
        level += 1
        here = [y for x in here for y in (x.values() if isinstance(x, dict) else x)]
    return level


def problem(name: str | None, arguments: str | None, schemas: dict) -> tuple[str | None, object]:
    """(what is wrong with a call's arguments or None, the parsed arguments)."""
    if name not in schemas:
        return "unknown tool", None
    try:
        given = json.loads(arguments, parse_float=number, parse_constant=no_number) if arguments is not None else None
    except ValueError:
        return "not JSON", None
    except RecursionError:
        return "nested too deeply", None
    if depth_of(given) > DEEPEST:
        return "nested too deeply", None
    if not isinstance(given, dict):
        return "not an object", given
    known = schemas[name]
    for key in sorted(known.keys() | given.keys()):
        rule = known.get(key)
        if rule is None:
            return f"unknown argument {key}", given
        value = given.get(key)
        if value is None:
            if rule.get("required"):
                return f"missing argument {key}", given
            continue
        if not isinstance(value, TYPES[rule["type"]]) or isinstance(value, bool) and rule["type"] != "boolean":
            return f"{key} is no {rule['type']}", given
        if len(value) < rule.get("minLength", 0) if isinstance(value, str) else False:
            return f"{key} is too short", given
        if "minimum" in rule and value < rule["minimum"]:
            return f"{key} is too small", given
    return None, given


def escaped(text: str) -> str:
    return SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: object) -> str:
    return escaped(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")))


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): links from each call to the one it follows are doubled
    in every round until all have reached the start; those that never do are on or
    behind a cycle and get null."""
    known = calls.select("conv_id", F.col("call_id").alias("to"))
    now = calls.select("conv_id", "call_id", F.col("after").alias("to")).join(
        known.withColumn("there", F.lit(True)), ["conv_id", "to"], "left")
    now = now.select("conv_id", "call_id", F.when(F.col("there"), F.col("to")).alias("to"),
                     F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"))
    now, seen = materialize(now, "calls", open=F.count("to"), rows=F.count(F.lit(1)))
    rounds = 0
    while seen["open"] and 1 << rounds <= seen["rows"]:
        rounds += 1
        done, ahead = now.where("to IS NULL"), now.where("to IS NOT NULL")
        target = now.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"))
        jumped = ahead.join(target, ["conv_id", "to"]).select(
            "conv_id", "call_id", F.col("next").alias("to"), (F.col("depth") + F.col("more")).alias("depth"))
        now, seen = materialize(done.unionByName(jumped), "calls", open=F.count("to"), rows=F.count(F.lit(1)))
    return now.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict, context: DataFrame | None = None) -> DataFrame:
    """(conv_id, call_id, turn, depth, name, status, n_calls, n_results, valid, problem, json);
    `context` are (conv_id, turn, role, content) rows to carry along."""
    prepare(calls.sparkSession)
    keys = ["conv_id", "call_id"]
    calls = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    results = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    one = calls.groupBy(*keys).agg(F.min(F.struct("arguments", "name", "turn", "after")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    one, _ = materialize(one.select(*keys, "c.*", "n_calls"), "tool-calls")
    answer = results.groupBy(*keys).agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n_results"), F.min("turn").alias("result_turn"))
    joined = one.join(answer.hint("shuffle_hash"), keys, "full").join(depths(one), keys, "left")
    joined = joined.withColumns({
        "status": F.when(F.col("n_calls").isNull(), "no_call").when(F.col("n_results").isNull(), "no_result").otherwise("linked"),
        "turn": F.coalesce("turn", "result_turn"), "depth": F.when(F.col("n_calls").isNull(), 0).otherwise(F.col("depth")),
        "n_calls": F.coalesce("n_calls", F.lit(0).cast("long")), "n_results": F.coalesce("n_results", F.lit(0).cast("long"))})
    given = [*keys, "turn", "depth", "name", "status", "n_calls", "n_results"]
    joined = joined.select(*given, "arguments", "after", "content", F.lit(None).cast("string").alias("role"))
    if context is not None:
        none = F.lit(0).cast("long")
        joined = joined.unionByName(context.select("conv_id", "turn", "role", "content", F.lit("context").alias("status"),
                                                   none.alias("n_calls"), none.alias("n_results")), allowMissingColumns=True)

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        found, text, valid = [], [], []
        column = [batch.column(c).to_pylist() for c in
                  ("call_id", "turn", "name", "arguments", "after", "content", "depth", "status", "role")]
        for call, turn, name, arguments, after, content, depth, status, role in zip(*column):
            if status == "context":
                wrong, shown = None, {"role": role, "text": content, "turn": turn}
            else:
                wrong, parsed = ("no call", None) if status == "no_call" else problem(name, arguments, schemas)
                wrong = escaped(wrong) if wrong else "cycle" if depth is None else None
                shown = {"after": after, "arguments": parsed, "call_id": call, "name": name, "result": content}
            found.append(wrong)
            text.append(canonical(shown))
            valid.append(None if status == "context" else wrong is None)
        yield {**{c: batch.column(c) for c in given}, "valid": valid, "problem": found, "json": text}

    kinds = dict(joined.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in given) + ", valid boolean, problem string, json string"
    return arrow_map(joined, rows, schema)


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and context of a (conv_id, turn, role, text) table: a user turn calls `reply`,
    the assistant's turn after it is the result, and the next user turn follows that call. All other
    rows (other roles or none, no conversation or turn) are context."""
    name = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    spoken = F.coalesce(placed & F.col("role").isin("user", "assistant"), F.lit(False))
    calls = conversations.where(placed & (F.col("role") == "user")).select(
        "conv_id", name(0).alias("call_id"), name(2).alias("after"), "turn", F.lit("reply").alias("name"),
        F.to_json(F.struct("text", "turn"), {"ignoreNullFields": "false"}).alias("arguments"))
    results = conversations.where(placed & (F.col("role") == "assistant")).select(
        "conv_id", name(1).alias("call_id"), F.col("text").alias("content"), "turn")
    return calls, results, conversations.where(~spoken).select("conv_id", "turn", "role", F.col("text").alias("content"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, context = turns_as_calls(read(spark, sf_dir, "conversations"))
    return link_calls(calls, results, REPLY, context)


OP8_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, min(text) AS text, count(*) AS n_calls FROM conversations
  WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
results AS (
  SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
depths AS (
  SELECT c.conv_id, c.turn, 0::BIGINT AS depth FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, d.depth + 1 FROM depths d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2),
both_sides AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS at, c.turn AS call_turn, c.text,
         r.content, n_calls, n_results, r.turn + 1 AS result_turn
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.turn)
SELECT b.conv_id, concat(b.conv_id, ':', b.at) AS call_id, coalesce(call_turn, result_turn) AS turn,
       CASE WHEN n_calls IS NULL THEN 0 ELSE depth END AS depth,
       CASE WHEN n_calls IS NOT NULL THEN 'reply' END AS name,
       CASE WHEN n_calls IS NULL THEN 'no_call' WHEN n_results IS NULL THEN 'no_result' ELSE 'linked' END AS status,
       coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
       coalesce(length(text) > 0 AND call_turn >= 0, false) AS valid,
       CASE WHEN n_calls IS NULL THEN 'no call' WHEN text IS NULL THEN 'missing argument text'
            WHEN text = '' THEN 'text is too short' WHEN call_turn < 0 THEN 'turn is too small' END AS problem,
       concat('{"after":', CASE WHEN n_calls IS NULL THEN 'null' ELSE concat('"', b.conv_id, ':', b.at - 2, '"') END,
              ',"arguments":', CASE WHEN n_calls IS NULL THEN 'null'
                ELSE concat('{"text":', coalesce(to_json(text)::VARCHAR, 'null'), ',"turn":', call_turn, '}') END,
              ',"call_id":"', b.conv_id, ':', b.at, '","name":', CASE WHEN n_calls IS NULL THEN 'null' ELSE '"reply"' END,
              ',"result":', coalesce(to_json(content)::VARCHAR, 'null'), '}') AS json
FROM both_sides b LEFT JOIN depths d ON d.conv_id = b.conv_id AND d.turn = b.at
UNION ALL
SELECT conv_id, NULL, turn, NULL, NULL, 'context', 0, 0, NULL, NULL,
       concat('{"role":', coalesce(to_json(role)::VARCHAR, 'null'), ',"text":', coalesce(to_json(text)::VARCHAR, 'null'),
              ',"turn":', coalesce(turn::VARCHAR, 'null'), '}')
FROM conversations WHERE NOT coalesce(role IN ('user', 'assistant') AND conv_id IS NOT NULL AND turn IS NOT NULL, false)
"""
