"""Hand-written cases of the call checks and the scorecard."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import call_checks, scoring, verdicts
from tessera.sources.jsonl import MESSAGE


def call(i, name, args):
    return {"id": i, "type": "function", "function": {"name": name, "arguments": args if isinstance(args, str) else json.dumps(args)}}


def turn(role, content=None, calls=None, tool_call_id=None):
    return {"role": role, "content": content, "tool_calls": calls, "tool_call_id": tool_call_id}


def frame(spark, *samples):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("messages", T.ArrayType(MESSAGE))])
    return spark.createDataFrame(list(enumerate(samples)), schema)


READ = [turn("user", "show it"), turn("assistant", "", [call("c1", "tool_search_read", {"model": "a"})])]


@pytest.mark.parametrize(
    "messages, want",
    [
        ([*READ, turn("tool", '[{"state": "Done"}]', None, "c1"), turn("assistant", "The state is now done.")], []),
        ([*READ, turn("tool", '{"result": true, "id": 3}', None, "c1"), turn("assistant", "its state is now 'scrapped'")], ["unsupported_state_claim"]),
        ([*READ, turn("tool", "{}", None, "c2"), turn("assistant", "Here.")], ["orphan_tool_result"]),
        ([*READ, turn("tool", "{}", None, None), turn("assistant", "Here.")], ["orphan_tool_result"]),
        ([*READ, turn("tool", "[]", None, "c1"), turn("assistant", "I confirmed purchase order P01992.")], ["claimed_unmade_write"]),
        ([*READ, turn("tool", "[]", None, "c1"), turn("assistant", "No journal entries have been posted yet.")], []),
        ([turn("user", "x"), turn("assistant", "I confirmed purchase order P01992.")], []),
        ([turn("user", "x"), turn("assistant", "", [call("c", "tool_write", {})]), turn("assistant", "I confirmed it.")], []),
    ],
)
def test_transcripts(spark, messages, want):
    got = frame(spark, messages).select(call_checks.transcript_reasons(F.col("messages")).alias("r")).first()["r"]
    assert got == want


def test_call_reasons(spark):
    run = "tool_execute_method"
    samples = [
        [turn("assistant", "", [call("1", run, {"model": "a", "method": "go"})])],
        [turn("assistant", "", [call("1", run, {"model": "a", "method": "fly"}), call("2", run, "[1]")])],
        [turn("assistant", "", [call("1", run, {"model": "zz", "method": "go"})]), turn("assistant", "", [call("2", run, "{bad")])],
        [turn("assistant", "", [call("1", "tool_create", {"model": "zz", "values": {"name": "Sample Name #1"}})])],
        [turn("user", "none")],
        [turn("assistant", "", [call("1", run, "[1]"), call("2", run, "null")])],
        [turn("assistant", "", [call("1", run, {"model": "a", "method": "write"})])],
    ]
    methods = spark.createDataFrame([("a", "go"), ("a", "go"), ("b", "fly")], "model string, method string")
    got = {r["id"]: r["reasons"] for r in call_checks.call_reasons(frame(spark, *samples), "id", methods).collect()}
    assert got == {1: ["hallucinated_method"], 2: ["unknown_model", "bad_tool_args"], 3: ["placeholder_values"], 5: ["bad_tool_args"]}
    free = {r["id"]: r["reasons"] for r in call_checks.call_reasons(frame(spark, *samples), "id").collect()}
    assert free == {1: ["bad_tool_args"], 2: ["bad_tool_args"], 3: ["placeholder_values"], 5: ["bad_tool_args"]}


def test_json_length(spark):
    def bare(m):
        return {k: ([{**c} for c in v] if k == "tool_calls" else v) for k, v in m.items() if v is not None}

    samples = [READ, [turn("user", 'a "quoted" é')], [*READ, turn("tool", "x", None, "c1"), turn("assistant", "", [call("1", "n", {}), call("2", "m", {"a": 1})])], []]
    got = [r[0] for r in frame(spark, *samples).orderBy("id").select(call_checks.message_json_length(F.col("messages"))).collect()]
    assert got == [len(json.dumps([bare(m) for m in s], ensure_ascii=False)) for s in samples]


def test_scorecard(spark):
    from pyspark.sql import types as T

    run = "tool_execute_method"
    go = turn("assistant", "", [call("1", run, {"model": "a", "method": "go"})])
    pairs = [
        (go, go),
        (go, turn("assistant", "Which one?")),
        (go, turn("assistant", '{"name": "tool_execute_method", "arguments": {"model": "a", "method": "cancel_all"}}')),
        (turn("assistant", "Which one?"), turn("assistant", "Which?")),
        (turn("assistant", "", [call("1", "tool_search_read", {"model": "a"})]), turn("assistant", "", [call("1", "tool_search_read", {"model": "a", "fields": ["id", "zz"]})])),
    ]
    schema = T.StructType([T.StructField("gold", MESSAGE), T.StructField("reply", MESSAGE)])
    surface = spark.createDataFrame([("a", ["go"], ["id", "name"])], "model string, methods array<string>, fields array<string>")
    row = scoring.score(spark.createDataFrame(pairs, schema), surface, [run, "tool_search_read"]).first().asDict()
    got = {k: v for k, v in row.items() if not k.endswith("_pct")}
    assert got == {
        "samples": 5, "right_method": 1, "right_tool": 1, "asked_when_unsure": 1, "held_destructive": 0, "emitted_structured_call": 2,
        "invented_method": 1, "invented_field": 1, "no_call_when_needed": 1, "fired_destructive": 1, "call_recovered_from_text": 1,
    }


def test_all_reasons(spark):
    answer = "The transfer waits for stock that is due on Friday, so nothing needs to be done before then, and its state is now 'scrapped' as far as I see."
    samples = [
        [turn("user", "please show the transfer"), READ[1], turn("tool", "{}", None, "c9"), turn("assistant", answer)],
        [turn("user", "please show the transfer"), turn("assistant", "word " * 7000 + ".")],
        [turn("user", "alone")],
        [turn("user", "please show the transfer"), turn("assistant", "Looking", [call("c1", "tool_search_read", {"model": "a"})])],
        [turn("user", "please show the transfer"), turn("assistant", "Looking")],
    ]
    rows = frame(spark, *samples).select("id", verdicts.reasons(F.col("messages")).alias("r")).orderBy("id").collect()
    assert [r["r"] for r in rows] == [["orphan_tool_result", "unsupported_state_claim"], ["over_length"], ["malformed"], [], ["thin_assistant_turn", "truncated"]]


def test_calls_as_text_need_calls(spark):
    said = "Use it like this:\ntool_create('x')\n" + "which makes the record and returns its number for later use, so that nothing else has to be done by hand afterwards."
    samples = [[turn("user", "how do I create one"), turn("assistant", said)], [turn("user", "how do I create one"), turn("assistant", "", [call("c", "tool_create", {})]), turn("assistant", said)]]
    rows = frame(spark, *samples).select("id", verdicts.reasons(F.col("messages")).alias("r")).orderBy("id").collect()
    assert [r["r"] for r in rows] == [[], ["tool_call_as_text"]]
