"""Hand-written cases of the gate, sources, streams and samplers."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx
from tessera.operators import gate, relations, sampling, verdicts
from tessera.sources import jsonl, source_tree
from tessera.streaming import ingest

LONG = "The order was checked against stock and every line is available for delivery today, so the next step is the transfer of the goods to the customer."


def failed(spark, *turns):
    df = spark.createDataFrame([([{"role": r, "content": c} for r, c in turns],)], T.StructType([T.StructField("messages", T.ArrayType(jsonl.MESSAGE))]))
    return df.select(verdicts.reasons(F.col("messages"), "Acme", "acme_").alias("r")).first()["r"]


def test_clean_transcript_passes(spark):
    assert failed(spark, ("user", "please confirm order 12 now"), ("assistant", LONG)) == []


def test_business_modals_are_no_echo(spark):
    text = LONG + " The order must be confirmed before the delivery can be created."
    assert failed(spark, ("user", "please confirm order 12 now"), ("assistant", text)) == []


def test_malformed_ends_the_check(spark):
    assert failed(spark, ("user", "x")) == ["malformed"]
    assert failed(spark, ("user", "x"), ("robot", "y")) == ["malformed"]


def test_several_reasons_in_order(spark):
    got = failed(spark, ("user", "hi"), ("assistant", "<think>As an AI"))
    assert got == ["thin_user_turn", "broken_think", "thin_assistant_turn", "truncated", "prompt_artifact"]


def test_truncation(spark):
    cases = {"It stops mid": True, "Done.": False, "All fine 🙂": False, "| a | b": False, "": True, "a() – one\nb() – two\nc() – three": False}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", gate.truncated(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


def test_write_claims(spark):
    cases = {"I confirmed purchase order P01992": True, "No journal entries have been posted yet": False, "I will confirm it": False}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", gate.unnegated_write(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


def test_clean_reasoning(spark):
    text = "No emojis here. " + LONG + " " + LONG
    row = spark.createDataFrame([(text,)], "t string").select(tx.clean_reasoning(F.col("t"), gate.instruction_echo("Acme")).alias("x")).first()["x"]
    assert row["removed"] == 1 and "emojis" not in row["text"]


def test_jsonl_and_streams(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    good = {"messages": [{"role": "user", "content": "é"}], "_meta": {"key": "k1", "family": "f", "generator_version": "2.0", "index": 1}}
    (src / "a.jsonl").write_text(json.dumps(good, ensure_ascii=False) + "\n\n" + '{"messages": [{"ro')
    rows = jsonl.read_jsonl(spark, str(src))
    assert rows.count() == 1 and jsonl.valid_cache(rows).count() == 1
    jsonl.write_jsonl(rows, str(tmp_path / "out"))
    assert jsonl.read_jsonl(spark, str(tmp_path / "out")).first()["messages"][0]["content"] == "é"
    flat = T.StructType([T.StructField("key", T.StringType())])
    log = tmp_path / "flat"
    log.mkdir()
    (log / "a.jsonl").write_text('{"key": "a"}\n{"key": "b"}\n{"key": "a"}\n')
    for k in range(2):
        ingest.append_new(ingest.follow_log(spark, str(log), flat, "key"), str(tmp_path / "t"), "key", str(tmp_path / f"c{k}")).awaitTermination(60)
    assert sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b"]


def test_split_does_not_leak(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 37).alias("g"))
    out = sampling.leak_free_split(rows, "g", 0.1, F.sha2(F.col("g").cast("string"), 256))
    assert out.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert out.where("split = 'eval'").count() >= 100


def test_method_names(spark):
    df = spark.createDataFrame([("_hidden", None), ("action_confirm", "sale"), ("button_cancel", "cancel")], "n string, s string")
    got = [tuple(r) for r in df.select(relations.is_public(F.col("n")), relations.is_action(F.col("n")), relations.is_destructive(F.col("n"), F.col("s"))).collect()]
    assert got == [(False, False, False), (True, True, False), (True, True, True)]


def test_null_keys_keep_their_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a"), (5, "")], "id int, t string")
    got = {r["id"]: (r["duplicate"], r["near_duplicate"]) for r in gate.first_wins(rows, "id", F.col("t"), F.col("t")).collect()}
    assert got == {1: (False, False), 2: (False, False), 3: (True, False), 4: (True, False), 5: (False, False)}


def test_judge(spark):
    answer = LONG + " Reference 12."
    turns = {
        1: [("user", "please confirm order 12 now"), ("assistant", answer)],
        2: [("user", "please confirm order 12 now"), ("assistant", answer)],
        3: [("user", "Please confirm order 99 now"), ("assistant", answer.replace("12", "7"))],
        4: [("user", "alone")],
        5: [("user", "alone")],
        6: [("user", "Confirm sales order S1 for Ann."), ("assistant", answer + " acme")],
    }
    df = spark.createDataFrame([(k, [{"role": r, "content": c} for r, c in v]) for k, v in turns.items()], T.StructType([T.StructField("id", T.LongType()), T.StructField("messages", T.ArrayType(jsonl.MESSAGE))]))
    got = {r["id"]: r["reasons"] for r in verdicts.judge(df, "id", "id", product="Acme").collect()}
    assert got == {1: [], 2: ["duplicate"], 3: ["near_duplicate"], 4: ["malformed"], 5: ["malformed"], 6: ["robotic_prompt", "truncated"]}


def test_interleave_without_tiers(spark):
    rows = spark.createDataFrame([(k, 1 if k < 3 else 3) for k in range(5)], "id int, tier int")
    got = [r["id"] for r in sampling.tier_interleave(spark, rows, "tier", "id", 100).orderBy("slot").collect()]
    assert got == [k % 3 for k in range(80)] + [3 + k % 2 for k in range(15)] + [(80 + k) % 3 for k in range(5)]
    bare = [r["id"] for r in sampling.tier_interleave(spark, rows.withColumn("tier", F.lit(2)), "tier", "id", 7).orderBy("slot").collect()]
    assert bare == [0, 1, 2, 3, 4, 0, 1]
    assert sampling.tier_interleave(spark, rows.limit(0), "tier", "id", 7).count() == 0
