"""Registered queries of the preparation, catalog, request, report and provider operators, each with
DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import prompts, requests
from ..functions import text as tx
from ..operators import gate, preparation, relations, reports, sampling
from ..session import scratch
from ..sources import jsonl, knowledge, source_tree
from ..streaming import endpoints
from .registry import array_of, call, conversations, message, query, table

# -- samples ------------------------------------------------------------------------------------

_META = {"key": "'k' || conv_id", "family": "'f' || conv_id % 3", "shape": "'s'", "model": "'m' || conv_id % 5", "method": "'a' || conv_id % 7", "teacher": "'t' || conv_id % 2"}


def samples(spark, d):
    """Conversations as samples: messages and provenance by number."""
    none = F.lit(None).cast("string")
    part = lambda head, n: F.concat(F.lit(head), (F.col("conv_id") % n).cast("string"))
    meta = F.struct(
        F.concat(F.lit("k"), "conv_id").alias("key"), part("f", 3).alias("family"), F.lit("s").alias("shape"), part("m", 5).alias("model"), part("a", 7).alias("method"),
        none.alias("domain"), none.alias("persona"), F.col("conv_id").alias("index"), F.lit("2.0").alias("generator_version"), part("t", 2).alias("teacher"),
    )
    return conversations(spark, d).select("messages", meta.alias("_meta"), "conv_id")


@query("prj01_training_row", "select count(*) as turns, sha256(string_agg(role || ':' || coalesce(text, ''), '|' order by turn)) as said from conversations group by conv_id")
def training_row(spark, d):
    rows = preparation.training_row(samples(spark, d))
    said = F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["role"], m["content"])), "|")
    return rows.select(F.size("messages").cast("bigint").alias("turns"), F.sha2(said, 256).alias("said"))


_SPLIT_SQL = (
    "with g as (select 'm' || conv_id % 5 || '::a' || conv_id % 7 as gkey, count(distinct conv_id) as n from conversations group by 1), "
    "c as (select gkey, coalesce(sum(n) over (order by sha256('7|' || gkey), gkey rows between unbounded preceding and 1 preceding), 0) as before, sum(n) over () as total from g) "
)


@query("prj02_sidecar", _SPLIT_SQL + "select distinct 'k' || conv_id as key, 'f' || conv_id % 3 as family, case when before < floor(total * 0.2) then 'eval' else 'train' end as split from conversations join c on gkey = 'm' || conv_id % 5 || '::a' || conv_id % 7")
def sidecar(spark, d):
    return preparation.sidecar(preparation.split_samples(samples(spark, d), 0.2, "7")).select("key", "family", "split")


@query(
    "prj03_chat_messages",
    "select conv_id, sha256(string_agg(role || '=' || trim(coalesce(text, ''), E' \\t\\n\\r') || case when role = 'assistant' then case when conv_id % 2 = 0 then '{\"a\":' || turn || '}' else '\"broken {' || turn || '\"' end else '' end, '|' order by turn)) as shown from conversations group by 1",
)
def chat_messages(spark, d):
    """Answers get a think block and a call whose arguments are JSON in even conversations only."""
    c = conversations(spark, d)
    n = lambda i: i.cast("string")
    args = lambda i: F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit('{"a": '), n(i), F.lit("}"))).otherwise(F.concat(F.lit("broken {"), n(i)))
    own = lambda m, i: F.when(m["role"] == "assistant", message("assistant", F.concat(F.lit("<think>x\ny</think>\n"), m["content"]), F.array(call("go", args(i))), "z")).otherwise(m)
    shown = lambda m: F.concat(m["role"], F.lit("="), m["content"], F.coalesce(F.to_json(F.get(m["tool_calls"], F.lit(0))["function"]["arguments"]), F.lit("")))
    done = c.select("conv_id", preparation.chat_messages(F.transform("messages", own)).alias("m"))
    return done.select("conv_id", F.sha2(F.array_join(F.transform("m", shown), "|"), 256).alias("shown"))


@query("prj17_route", "select doc_id, case when doc_id % 9 = 0 then 'failed' when length(text) > 2000 then 'too_long' else 'rendered' end as status from documents")
def route(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("text"))
    return preparation.route(rows, "text", 2000).select("doc_id", "status")


@query("src09_exchanges", "with f as (select conv_id, min(turn) filter (role = 'assistant') as t from conversations group by 1) select conv_id, max(text) filter (turn = t) as gold from conversations join f using (conv_id) where t > 0 group by 1 order by 1 limit 40")
def exchanges(spark, d):
    return preparation.exchanges(conversations(spark, d), "conv_id", 40).select("conv_id", F.col("gold.content").alias("gold"))


@query("src10_capped", "select doc_id from documents order by doc_id limit 150")
def capped(spark, d):
    return preparation.capped(table(spark, d, "documents").select("doc_id"), "doc_id", 150)


@query("src06_jsonl", "select doc_id, sha256(text) as h from documents where doc_id % 6 <> 0")
def jsonl_source(spark, d):
    """Every sixth line is torn, and blank lines stand between."""
    line = F.to_json(F.struct("doc_id", "text"))
    torn = F.when(F.col("doc_id") % 6 == 0, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line)
    path = scratch(spark, "lines")
    table(spark, d, "documents").select(F.concat(torn, F.lit("\n")).alias("value")).write.text(path)
    found = jsonl.read_jsonl(spark, path, "doc_id bigint, text string")
    return found.select("doc_id", F.sha2("text", 256).alias("h"))


@query("snk03_jsonl", "select count(*) as written, count(*) as n, count(distinct sha256(text)) as texts from documents")
def jsonl_sink(spark, d):
    path = scratch(spark, "rows")
    written = jsonl.write_jsonl(table(spark, d, "documents").select("doc_id", "text"), path)
    found = jsonl.read_jsonl(spark, path, "doc_id bigint, text string")
    return found.agg(F.lit(written).cast("bigint").alias("written"), F.count("*").alias("n"), F.count_distinct(F.sha2("text", 256)).alias("texts"))


@query("src07_load_cache", "select distinct 'k' || conv_id as key, conv_id as index from conversations where conv_id % 4 <> 1 and conv_id % 5 <> 2")
def load_cache(spark, d):
    """Of the written cache a fourth has an old version and a fifth no family; keys repeat."""
    rows = samples(spark, d)
    meta = F.col("_meta").withField("generator_version", F.when(F.col("conv_id") % 4 == 1, "1.0").otherwise("2.0")).withField("family", F.when(F.col("conv_id") % 5 != 2, F.col("_meta.family")))
    path = scratch(spark, "cache")
    rows = rows.select("messages", meta.alias("_meta"))
    jsonl.write_jsonl(rows.unionByName(rows.withColumn("_meta", F.col("_meta").withField("index", F.col("_meta.index") - 1))), path)
    kept, rejected = preparation.load_cache(spark, path)
    return kept.unionByName(rejected.drop("reasons")).select("_meta.key", "_meta.index")


@query("flt07_valid_cache", "select distinct conv_id from conversations where conv_id % 4 <> 1")
def valid_cache(spark, d):
    meta = F.col("_meta").withField("generator_version", F.when(F.col("conv_id") % 4 == 1, "1.0").otherwise("2.0"))
    return jsonl.valid_cache(samples(spark, d).withColumn("_meta", meta)).select("conv_id")


@query("snk06_prepared", "select distinct conv_id % 3 = 0 as broken, 'k' || conv_id as key from conversations")
def prepared(spark, d):
    """The preparation step over all conversations, of which a third have an open think tag: which
    were rejected for that."""
    said = F.when((F.col("conv_id") % 3 == 0) & (F.col("role") == "assistant") & (F.col("turn") < 3), F.concat(F.lit("<think>"), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    rows = conversations(spark, d, said).join(samples(spark, d).select("conv_id", "_meta"), "conv_id")
    return preparation.prepare(rows, fraction=0.2).select((F.array_contains("reasons", "broken_think") | (F.array_contains("reasons", "malformed") & (F.col("conv_id") % 3 == 0))).alias("broken"), "_meta.key")


@query("snk06_prepare_report")
def prepare_report(spark, d):
    """The preparation step at the size of the published run: 21,787 samples, each a conversation
    with a number of its own."""
    return baseline_report(spark, d)


def baseline_report(spark, d, n: int = 21_787):
    rows = samples(spark, d)
    size = rows.count()
    at = spark.range(n).select(F.col("id").alias("index"), F.pmod("id", F.lit(size)).alias("_pos"))
    numbered = rows.select("conv_id", (F.row_number().over(Window.orderBy("conv_id")) - 1).cast("bigint").alias("_pos"))
    own = rows.join(numbered, "conv_id").join(at, "_pos")
    first = lambda m, i: F.when(i == 0, message(m["role"], F.concat(F.lit("Case "), F.col("index").cast("string"), F.lit(": "), m["content"]))).otherwise(m)
    own = own.select(F.transform("messages", first).alias("messages"), F.col("_meta").withField("key", F.concat(F.lit("k"), F.col("index").cast("string"))).withField("index", F.col("index")).alias("_meta"))
    return preparation.preparation_report(preparation.prepare(own))[0]


@query("agg17_top_reasons", "with r as (select unnest(list_filter(['thin', 'long', 'foreign'], lambda x: (x = 'thin' and n_chars < 500) or (x = 'long' and n_chars > 3000) or (x = 'foreign' and lang <> 'en'))) as reason from documents) select reason, count(*) as n from r group by 1 order by 2 desc, 1 limit 2")
def top_reasons(spark, d):
    rows = table(spark, d, "documents").select(F.array_compact(F.array(F.when(F.col("n_chars") < 500, "thin"), F.when(F.col("n_chars") > 3000, "long"), F.when(F.col("lang") != "en", "foreign"))).alias("reasons"))
    return preparation.top_reasons(rows, 2)


@query("win09_resume", "with t as (select distinct event_type as family, 2500 as target from events union all select 'ghost', 10), h as (select event_type as family, count(*) as have, max(event_id) as last from events group by 1) select family, target::int as target, coalesce(have, 0) as have, case when last is not null then greatest(last + 1, have) else 0 end as next_index, greatest(0, target - coalesce(have, 0)) as needed, (floor(greatest(0, target - coalesce(have, 0)) * 1.45) + 8)::bigint as attempts from t left join h using (family)")
def resume(spark, d):
    events = table(spark, d, "events").select(F.col("event_type").alias("family"), F.col("event_id").alias("index"))
    targets = events.select("family").distinct().select("family", F.lit(2500).alias("target")).union(spark.sql("select 'ghost', 10"))
    return preparation.resume_points(events, targets)


@query("join11_empty_families", "select family from (values ('ghost'), ('click'), ('none')) t(family) where family not in (select event_type from events)")
def empty_families(spark, d):
    asked = spark.sql("select * from values ('ghost'), ('click'), ('none') as t(family)")
    return preparation.without_rows(asked, table(spark, d, "events").select(F.col("event_type").alias("family")))


@query("flt12_families", "select * from (values ('reverse', 'view,purchase,error,click'), ('empty', 'error'), ('mine', 'click,view'), ('view, click', 'click,view')) t(asked, families)")
def families(spark, d):
    have = {r["event_type"]: r["n"] for r in table(spark, d, "events").where("event_type <> 'error'").groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    order = ["click", "error", "purchase", "view"]
    chosen = [(a, ",".join(preparation.choose_families(order, a, have, {"mine": ["view", "click"]}))) for a in ("reverse", "empty", "mine", "view, click")]
    return spark.createDataFrame(chosen, "asked string, families string")


@query("join10_legacy", "select source as model, 'knowledge:' || lang as shape, sha256(text) as said from documents where source in (select source from documents group by 1 order by 1 limit 5)")
def legacy(spark, d):
    docs = table(spark, d, "documents")
    path = scratch(spark, "legacy")
    docs.select(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages"), F.col("source").alias("_model"), F.col("lang").alias("_type")).write.json(path)
    surface = docs.select(F.col("source").alias("model")).distinct().orderBy("model").limit(5)
    found = preparation.legacy_rows(spark, path, surface)
    return found.select("_meta.model", "_meta.shape", F.sha2(F.get("messages", F.lit(0))["content"], 256).alias("said"))


@query("set02_ordered_families", "select sha256(string_agg(role || ':' || coalesce(text, ''), '|' order by turn)) as said from conversations where conv_id % 3 <> 2 group by conv_id")
def ordered(spark, d):
    found = preparation.ordered_families(samples(spark, d), ("f1", "f0"))
    return found.select(F.sha2(F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["role"], m["content"])), "|"), 256).alias("said"))


@query("snk04_views", "select * from (select 'index' as view, count(distinct conv_id) as n from conversations union all select 'samples', count(distinct conv_id) from conversations union all select 'tool_calling', 0 union all select 'trajectories', 0)")
def views(spark, d):
    path = scratch(spark, "export")
    done = preparation.export(samples(spark, d).drop("conv_id"), path, fraction=0.2)
    sizes = [(name, spark.read.text(f"{path}/{name}").count()) for name in ("index", "tool_calling", "trajectories")]
    return spark.createDataFrame([*sizes, ("samples", done["totals"]["samples"])], "view string, n bigint")


@query("snk05_manifest", "select 'family' as dimension, 'f' || conv_id % 3 as value, count(distinct conv_id) as n from conversations group by 2 union all select 'model', 'm' || conv_id % 5, count(distinct conv_id) from conversations group by 2 union all select 'persona', '?', count(distinct conv_id) from conversations union all select 'shape', 's', count(distinct conv_id) from conversations")
def manifest(spark, d):
    found = preparation.manifest_of(samples(spark, d).withColumn("split", F.lit("train")), {})
    return spark.createDataFrame([(k[3:], v, n) for k in found if k.startswith("by_") for v, n in found[k].items()], "dimension string, value string, n bigint")


@query("agg15_teachers", "select 't' || conv_id % 2 as teacher, count(distinct conv_id) as n from conversations group by 1")
def teachers(spark, d):
    return reports.teachers(samples(spark, d))


# -- requests and small texts -------------------------------------------------------------------


def _replies(spark, d):
    """A reply of a text model for each document: the message quoted, led in, inside other talk, or
    not there at all."""
    said = F.concat(F.lit("Please move order "), F.col("doc_id").cast("string"), F.lit(" to Friday"))
    forms = [F.concat(F.lit('"'), said, F.lit('"')), F.concat(F.lit("User: "), said), F.concat(F.lit('We need to write it. So maybe "'), said, F.lit("\" That's one sentence.")), F.lit("Per the instruction, output only the text.")]
    return table(spark, d, "documents").select("doc_id", F.get(F.array(*forms), (F.col("doc_id") % 4).cast("int")).alias("reply"))


@query("txt06_tidy_request", "select doc_id, case when doc_id % 4 < 3 then 'Please move order ' || doc_id || ' to Friday' end as request from documents")
def tidy(spark, d):
    return _replies(spark, d).select("doc_id", requests.tidy_request(F.col("reply")).alias("request"))


@query("txt07_candidates", "select doc_id, case doc_id % 4 when 2 then 'Please move order ' || doc_id || ' to Friday#We need to write it. So maybe \"Please move order ' || doc_id || ' to Friday\" That''s one sentence.' when 3 then 'Per the instruction, output only the text.' when 1 then 'User: Please move order ' || doc_id || ' to Friday' else 'Please move order ' || doc_id || ' to Friday' end as guesses from documents")
def guesses(spark, d):
    return _replies(spark, d).select("doc_id", F.array_join(F.when(F.col("doc_id") % 4 == 0, F.slice(requests.candidates(F.col("reply")), 1, 1)).otherwise(requests.candidates(F.col("reply"))), "#").alias("guesses"))


@query("flt11_acceptable", "select doc_id, length(text) between 12 and 900 and doc_id % 8 <> 0 as good from documents")
def acceptable(spark, d):
    own = F.when(F.col("doc_id") % 8 == 0, F.concat(F.lit("as the persona "), F.substring("text", 1, 100))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", requests.acceptable(own).alias("good"))


@query("win14_first_hit", "select o_orderkey, case when (o_orderkey * 7919 % 1000) / 1000.0 < 0.14 then 'a' when (o_orderkey * 104729 % 1000) / 1000.0 < 0.1 then 'b' when (o_orderkey * 1299709 % 1000) / 1000.0 < 0.3 then 'c' end as hit from orders")
def first_hit(spark, d):
    draws = F.array(*[(F.col("o_orderkey") * p % 1000) / 1000.0 for p in (7919, 104729, 1299709)])
    return table(spark, d, "orders").select("o_orderkey", requests.first_hit([(0.14, "a"), (0.1, "b"), (0.3, "c")], draws).alias("hit"))


@query("txt08_envelope", "select p_partkey, case when p_partkey % 2 = 0 then '<think>' || chr(10) || p_name || chr(10) || '</think>' || chr(10) || chr(10) else '' end as think, '{\"id\":\"c' || p_partkey || '\",\"type\":\"function\",\"function\":{\"name\":\"go\",\"arguments\":\"{\\\"size\\\":' || p_size || '}\"}}' as call from part")
def envelope(spark, d):
    made = requests.call_envelope(F.lit("go"), F.to_json(F.struct(F.col("p_size").alias("size"))), F.concat(F.lit("c"), "p_partkey"))
    return table(spark, d, "part").select("p_partkey", requests.think_block(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), "p_name"))).alias("think"), F.to_json(made).alias("call"))


@query("txt14_change_text", "select s_suppkey, 'main nation should be a different one (do not name a number), note becomes ''' || s_name || ''', rank becomes ' || s_suppkey as change from supplier")
def change_text(spark, d):
    values = F.create_map(F.lit("main_nation_id"), F.col("s_nationkey").cast("string"), F.lit("note"), F.col("s_name"), F.lit("rank"), F.col("s_suppkey").cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", requests.change_text(values).alias("change"))


@query("txt15_base_key", "select s_suppkey, case s_suppkey % 3 when 0 then 'layers.' || s_suppkey || '.q.weight' when 1 then 'layers.' || s_suppkey || '.weight' end as base, case when s_suppkey % 2 = 0 then 'Partner' else 'Order Line' end as title from supplier")
def base_key(spark, d):
    k = F.col("s_suppkey").cast("string")
    key = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("base_model.model.layers."), k, F.lit(".q.lora_A.weight"))).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("base_model.layers."), k, F.lit(".lora_B.weight"))).otherwise(k)
    return table(spark, d, "supplier").select("s_suppkey", requests.base_key(key).alias("base"), requests.title_of(F.when(F.col("s_suppkey") % 2 == 0, "partner_id").otherwise("order_line_ids")).alias("title"))


@query("txt16_provider", "select user_id, case user_id % 3 when 0 then 'nvidia' when 1 then 'openrouter' end as provider from (select distinct user_id from events)")
def provider(spark, d):
    key = F.concat(F.get(array_of("nvapi-", "sk-or-", "sk-"), (F.col("user_id") % 3).cast("int")), F.col("user_id").cast("string"))
    return table(spark, d, "events").select("user_id").distinct().select("user_id", requests.provider_of(key).alias("provider"))


@query("gen08_wrong_tools", "select o_orderkey, case when o_orderstatus <> 'O' then '`tool_write` on the state, to ''' || o_orderstatus || ''' (skips what the method does besides); ' else '' end || '`tool_unlink` (removes the record, which then has no state at all)' as wrong from orders")
def wrong_tools(spark, d):
    return table(spark, d, "orders").select("o_orderkey", requests.wrong_tools(F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))).alias("wrong"))


@query(
    "prj15_request_prompt",
    "select c_custkey, sha256('You are a clerk. Brief.' || chr(10) || 'What happened: ' || c_mktsegment || chr(10) || 'What you want: confirm' || chr(10) || 'It concerns: ' || c_name || chr(10) || 'One short sentence at most.' || chr(10) "
    "|| case when c_custkey % 10 = 0 then 'Make one small slip of the keyboard.' || chr(10) else '' end || 'Ask for a number or a short list, and for no change.' || chr(10) || 'You have never heard of x.y, of methods, fields or record numbers.' || chr(10) || 'Reply with your message alone.') as prompt from customer",
)
def request_prompt(spark, d):
    draws = F.array(F.when(F.col("c_custkey") % 10 == 0, 0.0).otherwise(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.0))
    lit = F.lit
    made = prompts.request_prompt(lit("clerk"), lit("Brief."), F.col("c_mktsegment"), lit("confirm"), F.col("c_name"), lit("analysis"), lit("terse"), lit("x.y"), draws)
    return table(spark, d, "customer").select("c_custkey", F.sha2(made, 256).alias("prompt"))


@query(
    "prj15_answer_prompts",
    "select c_custkey, sha256(concat_ws('#', 'Request: ' || c_name || chr(10) || 'Calls and results: t' || chr(10) || 'Outcome: o' || chr(10) || 'Report on the x from these results and from nothing else, speaking to whoever asked.', "
    "'Request: ' || c_name || chr(10) || 'The system refused with: t' || chr(10) || 'What helps: o' || chr(10) || 'Say that the x is as it was, why, and what would have to be done first.', "
    "'Request: ' || c_name || chr(10) || 'Not known: t' || chr(10) || 'Ask for what is not known about the x, in one question, before anything is done.', "
    "'Question: ' || c_name || chr(10) || 'What was read: t' || chr(10) || 'Rows: o' || chr(10) || 'Answer from these rows of x; if they do not hold the answer, say so.', "
    "'Question: ' || c_name || chr(10) || 'What is known: t' || chr(10) || 'Explain how a x behaves, from what is known alone.')) as prompts from customer",
)
def answer_prompts(spark, d):
    x, t, o, name = F.lit("x"), F.lit("t"), F.lit("o"), F.col("c_name")
    made = [prompts.answer_prompt(x, name, t, o), prompts.recovery_prompt(x, name, t, o), prompts.clarification_prompt(x, name, t), prompts.analysis_prompt(x, name, t, o), prompts.explain_prompt(x, name, t)]
    return table(spark, d, "customer").select("c_custkey", F.sha2(F.concat_ws("#", *made), 256).alias("prompts"))


@query("txt03_clean_reasoning", "select doc_id, doc_id % 3 = 0 as cut, case when doc_id % 3 = 0 then case when length(rest) >= 150 then sha256(rest) else sha256('') end else sha256(rest) end as h from (select doc_id, repeat('Line ' || doc_id || ' is on its way. ', (doc_id % 9)::int + 2) || 'End.' as rest from documents)")
def clean_reasoning(spark, d):
    rest = F.concat(F.expr("repeat(concat('Line ', doc_id, ' is on its way. '), int(doc_id % 9) + 2)"), F.lit("End."))
    own = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Use no emojis. "), rest)).otherwise(rest)
    done = table(spark, d, "documents").select("doc_id", tx.clean_reasoning(own, gate.instruction_echo("Acme")).alias("x"))
    return done.select("doc_id", (F.col("x.removed") > 0).alias("cut"), F.sha2("x.text", 256).alias("h"))


@query("txt04_scrub", "select doc_id, case when doc_id % 2 = 0 then 'a  b' when doc_id % 3 = 0 then 'a <think>Use it here.</think> b' else 'a  b' end as shown from documents")
def scrub(spark, d):
    block = F.when(F.col("doc_id") % 2 == 0, F.lit("a <think>Use no emojis.</think> b")).when(F.col("doc_id") % 3 == 0, F.lit("a <think>Use it here.</think> b")).otherwise(F.lit("a  b"))
    return table(spark, d, "documents").select("doc_id", tx.scrub_think(block, gate.instruction_echo("Acme"))["text"].alias("shown"))


@query("txt05_chatty_tail", "select doc_id, sha256('Order ' || doc_id || ' is ready.') as h from documents")
def chatty_tail(spark, d):
    own = F.concat(F.lit("Order "), F.col("doc_id").cast("string"), F.lit(" is ready."))
    tail = F.get(array_of("", "\nI hope this helps!", "\n\nGood luck with it.\nHappy configuring", " Let me know if you need more."), (F.col("doc_id") % 4).cast("int"))
    return table(spark, d, "documents").select("doc_id", F.sha2(tx.drop_chatty_tail(F.concat(own, tail), gate.chatty("Acme")), 256).alias("h"))


@query("txt11_split_reasoning", "select doc_id, case when doc_id % 2 = 0 then 'why ' || doc_id else substr(text, 1, length(text) // 3) end as reasoning from documents")
def split_reasoning(spark, d):
    own = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<think> why "), F.col("doc_id").cast("string"), F.lit("\n</think> so"))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", tx.split_reasoning(own)["reasoning"].alias("reasoning"))


# -- the scanned catalog ------------------------------------------------------------------------


def _manifests(spark, d):
    """A manifest for each supplier, in folders of seven names; every fifth does not parse."""
    k = F.col("s_suppkey").cast("string")
    text = F.when(F.col("s_suppkey") % 5 == 0, F.lit("1 +")).otherwise(F.concat(F.lit("{'name': 'S"), k, F.lit("', 'summary': 'x', 'depends': ['base', 'n"), F.col("s_nationkey").cast("string"), F.lit("']}")))
    path = F.concat(F.lit("/t/"), F.lpad(k, 8, "0"), F.lit("/m"), (F.col("s_suppkey") % 7).cast("string"), F.lit("/__manifest__.py"))
    return table(spark, d, "supplier").select(path.alias("path"), text.alias("content"))


@query("src01_modules", "with m as (select s_suppkey % 7 as k, max(s_suppkey) as s, arg_max(s_nationkey, s_suppkey) as n from supplier group by 1) select 'm' || k as module, case when s % 5 = 0 then 'm' || k else 'S' || s end as name, 'Uncategorized' as category, case when s % 5 = 0 then '' else 'x' end as description, case when s % 5 = 0 then '' else 'base,n' || n end as depends from m")
def modules(spark, d):
    return source_tree.parse_manifests(_manifests(spark, d)).select("module", "name", "category", "description", F.array_join("depends", ",").alias("depends"))


_CLASS = """class A(models.Model):
    _name = "x.{k}"
    _inherit = ["x.base", "x.{p}"]
    _description = "Model {k}"
    _hidden = fields.Char("no")
    partner_id = fields.Many2one("x.{p}", string="Partner", required=True)
    total = fields.Float("Total", compute="_total", readonly=True)
    state = fields.Selection(selection=[("a", "A{k}"), ("b", "B")])

    @api.depends("x")
    @api.model
    def _total(self):
        return 1

    def action_go(self):
        "Go {k}."
"""


def _sources(spark, d):
    """A file for each supplier with a model of its own that extends the one of its nation; every
    tenth does not parse."""
    text = F.lit(_CLASS)
    for slot, value in (("{k}", "s_suppkey"), ("{p}", "s_nationkey")):
        text = F.replace(text, F.lit(slot), F.col(value).cast("string"))
    path = F.concat(F.lit("/t/m"), (F.col("s_suppkey") % 7).cast("string"), F.lit("/"), F.col("s_suppkey").cast("string"), F.lit(".py"))
    return table(spark, d, "supplier").select(path.alias("path"), F.when(F.col("s_suppkey") % 10 == 0, "class (").otherwise(text).alias("content"))


def _built(spark, d):
    entities = source_tree.parse_sources(_sources(spark, d)).where("kind <> 'error'").withColumn("module", source_tree.module_of(F.col("path")))
    return knowledge.build(source_tree.parse_manifests(_manifests(spark, d)), entities)


_GOOD = "(select s_suppkey as k, s_nationkey as p from supplier where s_suppkey % 10 <> 0)"


@query("src03_entities", f"select kind, name, type, comodel, label, required, compute, decorators, x.model as model from (select 'x.' || k as model, unnest([{{'kind': 'model', 'name': 'Model ' || k, 'type': null, 'comodel': null, 'label': null, 'required': null, 'compute': null, 'decorators': null}}, {{'kind': 'inherits', 'name': 'x.base', 'type': null, 'comodel': null, 'label': null, 'required': null, 'compute': null, 'decorators': null}}, {{'kind': 'inherits', 'name': 'x.' || p, 'type': null, 'comodel': null, 'label': null, 'required': null, 'compute': null, 'decorators': null}}, {{'kind': 'field', 'name': 'partner_id', 'type': 'Many2one', 'comodel': 'x.' || p, 'label': 'Partner', 'required': true, 'compute': null, 'decorators': null}}, {{'kind': 'field', 'name': 'total', 'type': 'Float', 'comodel': null, 'label': 'Total', 'required': false, 'compute': '_total', 'decorators': null}}, {{'kind': 'field', 'name': 'state', 'type': 'Selection', 'comodel': null, 'label': null, 'required': false, 'compute': null, 'decorators': null}}, {{'kind': 'method', 'name': '_total', 'type': null, 'comodel': null, 'label': null, 'required': null, 'compute': null, 'decorators': 'api.depends,api.model'}}, {{'kind': 'method', 'name': 'action_go', 'type': null, 'comodel': null, 'label': null, 'required': null, 'compute': null, 'decorators': ''}}], recursive := true), from {_GOOD}) x union all select 'error', null, null, null, null, null, null, null, null from supplier where s_suppkey % 10 = 0".replace("recursive := true), from", "recursive := true) from"))
def entities(spark, d):
    rows = source_tree.parse_sources(_sources(spark, d))
    return rows.select("model", "kind", "name", "type", "comodel", "label", "required", "compute", F.when(F.col("decorators").isNotNull(), F.array_join("decorators", ",")).alias("decorators"))


@query("src03d_states", f"select 'x.' || k as model, unnest(['a', 'b']) as state, unnest(['A' || k, 'B']) as label from {_GOOD}")
def states(spark, d):
    return source_tree.states_of(source_tree.parse_sources(_sources(spark, d)))


@query("snk01_catalog", f"select 'models' as name, count(*) as n from {_GOOD} union all select 'fields', 3 * count(*) from {_GOOD} union all select 'methods', 2 * count(*) from {_GOOD} union all select 'relationship_edges', 5 * count(*) from {_GOOD} union all select 'modules', count(distinct s_suppkey % 7) from supplier")
def catalog_tables(spark, d):
    """Built, written, written again whole, and read back."""
    path, built = scratch(spark, "catalog"), _built(spark, d)
    for _ in range(2):
        knowledge.write(built, path)
    found = knowledge.open_catalog(spark, path)
    counts = [rows.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, rows in found.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query("prj04_fields", f"select 'x.' || k as model_name, unnest(['partner_id', 'total', 'state']) as name, unnest([true, false, false]) as required, unnest([null, null, 'a=A' || k || ',b=B']) as choices from {_GOOD}")
def model_fields(spark, d):
    rows = knowledge.model_fields(_built(spark, d)["fields"])
    return rows.select("model_name", "name", "required", F.array_join(F.transform("selection", lambda s: F.array_join(s, "=")), ",").alias("choices"))


@query("prj05_methods", f"select 'x.' || k as model_name, unnest(['_total', 'action_go']) as name, unnest(['', 'Go ' || k || '.']) as docstring, unnest(['api.depends,api.model', '']) as decorators, unnest([false, true]) as is_action, unnest([false, true]) as is_public from {_GOOD}")
def model_methods(spark, d):
    rows = knowledge.model_methods(_built(spark, d)["methods"], public_only=False)
    return rows.select("model_name", "name", "docstring", F.array_join("decorators", ",").alias("decorators"), "is_action", "is_public")


@query("flt04_public_actions", f"select 'x.' || k as model_name, 'action_go' as name from {_GOOD}")
def public_actions(spark, d):
    return knowledge.model_methods(_built(spark, d)["methods"], actions_only=True).select("model_name", "name")


@query("prj06_transitions", f"select 'x.' || k as source_model, unnest(['a', 'b']) as state, unnest(['A' || k, 'B']) as label from {_GOOD}")
def transitions(spark, d):
    return knowledge.state_transitions(_built(spark, d)["relationship_edges"])


@query("join01_models_methods", f"select 'x.' || k as technical_name, 'Model ' || k as name, 'm' || k % 7 as module_name from {_GOOD}")
def models_methods(spark, d):
    built = _built(spark, d)
    return knowledge.models_with_methods(built["models"], built["methods"])


@query("flt08_relations", f"select 'x.' || k as source_model, 'x.' || p as target_model, 'Many2one' as rel_type, 'partner_id' as field_name from {_GOOD} where k <> p")
def relation_filter(spark, d):
    return knowledge.relations_of(_built(spark, d)["relationship_edges"])


@query("join14_merged", "with s as (select s_nationkey as n, max(s_suppkey) as last from supplier group by 1) select 'x.n' || n as model, 'f' as name, 'L' || last as label from s")
def merged(spark, d):
    """Suppliers of a nation all declare one field of its model; the last file counts."""
    k, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    text = F.concat(F.lit('class A(models.Model):\n    _name = "x.n'), n, F.lit('"\n    f = fields.Char("L'), k, F.lit('")\n'))
    files = table(spark, d, "supplier").select(F.concat(F.lit("/t/m/"), F.lpad(k, 8, "0"), F.lit(".py")).alias("path"), text.alias("content"))
    rows = knowledge.merged(source_tree.parse_sources(files).withColumn("module", F.lit("m")))
    return rows.where("kind = 'field'").select("model", "name", "label")


@query("gen10_chains", "select * from (values (0, 5), (1, 4), (2, 3), (3, 3), (4, 4)) t(chain, steps)")
def chains(spark, d):
    return knowledge.process_chains(spark).groupBy("chain").agg(F.count("*").cast("int").alias("steps"))


# -- specifications from tables -----------------------------------------------------------------

_METHOD = "struct<name:string,from_state:string,to_state:string,returns_action:boolean,failures:array<struct<exc:string,message:string>>>"


def specs(spark, d):
    """A specification for each nation that has suppliers, whose methods are its suppliers."""
    k = F.col("s_suppkey")
    failing = F.when(k % 5 == 0, F.array(F.struct(F.lit("E").alias("exc"), F.lit("m").alias("message")))).otherwise(F.array().cast("array<struct<exc:string,message:string>>"))
    method = F.struct(F.concat(F.when(k % 7 == 0, F.lit("action_cancel_")).otherwise(F.lit("action_")), k.cast("string")).alias("name"), F.lit("draft").alias("from_state"), F.when(k % 3 == 0, "done").alias("to_state"), (k % 4 == 0).alias("returns_action"), failing.alias("failures")).cast(_METHOD)
    own = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", method.alias("m")))), lambda x: x["m"]).alias("methods"))
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(own, F.col("n_nationkey") == F.col("s_nationkey"))
    created = F.create_map(F.lit("partner_id"), F.lit("ref"), F.concat(F.lit("own_"), F.col("n_nationkey").cast("string")), F.lit("x"))
    return rows.select(
        F.col("n_name").alias("model"), F.lower("n_name").alias("label"), F.col("r_name").alias("domain"), F.array(F.concat(F.lit("r"), (F.col("n_nationkey") % 3).cast("string")), F.lit("r9")).alias("personas"), "methods",
        created.alias("create_fields"), array_of("name", "partner_id", "ghost").alias("search_fields"), F.when(F.col("n_nationkey") % 2 == 0, "state").otherwise("stage").alias("state_field"),
        (F.col("n_nationkey") % 4 + 1).cast("int").alias("weight"), F.when(F.col("n_nationkey") % 2 == 0, "A").otherwise("B").alias("tier"), F.col("n_nationkey").alias("k"),
    )


_SPEC = "(select n_name as model, n_nationkey as k, r_name as domain, s_suppkey as s from nation join region on n_regionkey = r_regionkey join supplier on s_nationkey = n_nationkey)"
_NAME = "case when s % 7 = 0 then 'action_cancel_' else 'action_' end || s"


@query("prj22_surface_index", f"select model, string_agg({_NAME}, ',' order by {_NAME}) as methods, 'ghost,name,partner_id' as fields from {_SPEC} group by 1")
def surface_index(spark, d):
    return reports.surface_index(specs(spark, d)).select("model", F.array_join("methods", ",").alias("methods"), F.array_join("fields", ",").alias("fields"))


@query("prj23_audit", f"select model, domain, count(*)::int as methods, (count(*) filter (s % 3 = 0 and s % 4 <> 0))::int as mutating, (count(*) filter (s % 5 = 0))::int as failing, (max(k) % 4 + 1)::int as weight from {_SPEC} group by 1, 2")
def audit(spark, d):
    return reports.surface_audit(specs(spark, d))


@query("agg09_totals", f"select case when k % 2 = 0 then 'A' else 'B' end as tier, count(distinct model) as models, count(*) as methods, count(*) filter (s % 5 = 0) as failing from {_SPEC} group by 1")
def totals(spark, d):
    return reports.surface_totals(specs(spark, d))


@query("agg09_domains", f"select domain, string_agg(distinct model, ', ' order by model) as models from {_SPEC} group by 1")
def domains(spark, d):
    return reports.models_by_domain(specs(spark, d))


@query("join02_specs", f"select model, string_agg({_NAME}, ',' order by s) as methods, case when k % 3 = 0 then 'id,display_name' else 'name,partner_id' end as search, case when k % 3 = 0 then 'own_' || k else 'partner_id' end as created, case when k % 2 = 0 then 'state' end as state_field from {_SPEC} where k % 5 <> 4 and s % 2 = 0 group by model, k")
def verified_specs(spark, d):
    """A scan that lacks every fifth model, odd methods, and the common fields of a third."""
    own = specs(spark, d)
    common = F.when(F.col("k") % 3 == 0, F.array(F.concat(F.lit("own_"), F.col("k").cast("string")))).otherwise(array_of("name", "partner_id"))
    fields = own.where("k % 5 <> 4").select(F.col("model").alias("model_name"), F.explode(F.concat(common, array_of("state"))).alias("field_name"))
    methods = own.select(F.col("model").alias("model_name"), F.explode("methods.name").alias("method_name")).where(F.regexp_extract("method_name", "([0-9]+)$", 1).cast("bigint") % 2 == 0)
    good, _ = relations.verify_specs(own.drop("k"), fields, methods)
    join = lambda c: F.array_join(c, ",")
    return good.select("model", join("methods.name").alias("methods"), join("search_fields").alias("search"), join(F.map_keys("create_fields")).alias("created"), "state_field")


@query("join02_notes", f"select distinct model, 'model not present' as kind from {_SPEC} where k % 5 = 4 union all select model, 'no method left' from {_SPEC} where k % 5 <> 4 group by model having count(*) filter (s % 2 = 0) = 0")
def verify_notes(spark, d):
    own = specs(spark, d)
    fields = own.where("k % 5 <> 4").select(F.col("model").alias("model_name"), F.lit("name").alias("field_name"))
    methods = own.select(F.col("model").alias("model_name"), F.explode("methods.name").alias("method_name")).where(F.regexp_extract("method_name", "([0-9]+)$", 1).cast("bigint") % 2 == 0)
    return relations.verify_specs(own.drop("k"), fields, methods)[1].where("kind in ('model not present', 'no method left')").select("model", "kind")


@query("join17_scenarios", f"with p as (select * from (values ('r0'), ('r0'), ('r1'), ('r2'), ('r9')) t(role)), n as (select model, k, domain, count(*) as m from {_SPEC} group by 1, 2, 3) select model, m * (select count(*) from p where role in ('r' || k % 3, 'r9')) * case when k = 3 then 4 when domain = 'ASIA' then 2 when domain = 'EUROPE' then 1 else 0 end as scenarios from n")
def scenarios(spark, d):
    own = specs(spark, d)
    personas = spark.sql("select * from values ('r0', 'a', 'v'), ('r0', 'b', 'v'), ('r1', 'c', 'v'), ('r2', 'd', 'v'), ('r9', 'e', 'v') as t(role, name, voice)")
    wide = spark.sql("select * from values ('ASIA', 'x'), ('ASIA', 'y'), ('EUROPE', 'z') as t(domain, text)").select(F.lit(None).cast("string").alias("model"), "domain", "text")
    single = own.where("k = 3").select("model", "domain", F.explode(F.array(*map(F.lit, "abcd"))).alias("text"))
    return reports.scenario_space(own, personas, wide.unionByName(single))


@query("flt05_mutating", f"select model, string_agg({_NAME}, ',' order by s) as methods from (select *, count(*) filter (s % 3 = 0 and s % 4 <> 0) over (partition by model) as fit from {_SPEC}) where fit = 0 or (s % 3 = 0 and s % 4 <> 0) group by 1")
def mutating(spark, d):
    from ..operators.generation import eligible

    return specs(spark, d).select("model", F.array_join(F.transform(eligible(F.col("methods"), "mutating"), lambda m: m["name"]), ",").alias("methods"))


@query("flt05b_transitions", f"select model, count(*) filter (s % 3 = 0 and s % 4 <> 0) as n from {_SPEC} group by 1")
def full_transitions(spark, d):
    from ..operators.generation import eligible

    return specs(spark, d).select("model", F.size(eligible(F.col("methods"), "transition")).cast("bigint").alias("n"))


@query("flt05c_destructive", f"select model, {_NAME} as method, s % 7 = 0 as destructive from {_SPEC}")
def destructive(spark, d):
    each = specs(spark, d).select("model", F.inline("methods"))
    return each.select("model", F.col("name").alias("method"), relations.is_destructive(F.col("name"), F.col("to_state")).alias("destructive"))


@query("flt05d_failing", f"select model, count(*) filter (s % 5 = 0) as n from {_SPEC} group by 1")
def failing(spark, d):
    from ..operators.generation import eligible

    return specs(spark, d).select("model", F.size(eligible(F.col("methods"), "failing")).cast("bigint").alias("n"))


@query("flt04a_names", "select s_suppkey, s_suppkey % 3 <> 0 as public, s_suppkey % 3 = 1 as action from supplier")
def names(spark, d):
    k = F.col("s_suppkey")
    name = F.concat(F.get(array_of("_x", "write_", "pay_"), (k % 3).cast("int")), k.cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", relations.is_public(name).alias("public"), relations.is_action(name).alias("action"))


@query("prj08_listing", f"select model, sha256('{{\"model\":\"' || model || '\",\"methods\":[' || string_agg('{{\"name\":\"' || {_NAME} || '\",\"does\":\"' || {_NAME} || '\"' || case when s % 3 = 0 then ',\"state\":\"draft -> done\"' else '' end || case when s % 4 = 0 then ',\"returns\":\"action\"' else '' end || '}}', ',' order by s) || ']}}') as listing from {_SPEC} group by 1")
def listing(spark, d):
    from ..operators.facts import method_listing

    named = F.transform("methods", lambda m: m.withField("intent", m["name"]))
    text = method_listing(F.col("model"), named)
    return specs(spark, d).select("model", F.sha2(F.regexp_replace(F.regexp_replace(text, '": "', '":"'), '(,|:) (["\\[{])', "$1$2"), 256).alias("listing"))


# -- reports ------------------------------------------------------------------------------------


@query("agg11_plan_counts", "select count(*) as instances, count(distinct event_type || '|' || user_id) as facts, count(distinct user_id) as models from events")
def plan_counts(spark, d):
    return reports.plan_counts(table(spark, d, "events"), F.concat_ws("|", "event_type", "user_id"), "user_id")


@query("agg12_usage_share", "select event_type, count(*) as n, count(*) / sum(count(*)) over () as share from events group by 1")
def usage_share(spark, d):
    return reports.usage_share(table(spark, d, "events"), "event_type")


@query("agg13_token_ratio", "with l as (select doc_id, n_chars % 40 as n, case when doc_id % 4 = 0 then 0 else (n_chars % 40) // 2 end as t from documents) select count(*) filter (t > 0) as kept, count(*) filter (t > 0) / count(*) as kept_share, sum(t) / sum(n) as trainable_share from l")
def token_ratio(spark, d):
    label = lambda i: F.when((F.col("doc_id") % 4 != 0) & (i < F.floor(F.col("n") / 2)), i).otherwise(-100)
    rows = table(spark, d, "documents").withColumn("n", F.col("n_chars") % 40)
    rows = rows.select(F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)).cast("int")), label)).otherwise(F.array().cast("array<bigint>")).alias("labels"))
    return reports.token_ratio(rows, "labels")


@query("agg16_passed", "select count(*) filter (quality = 1) as passed, count(*) filter (quality is distinct from 1) as failed from documents left join labels using (doc_id)")
def passed(spark, d):
    return reports.passed(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), F.col("quality") == 1)


@query("agg18_run_stats", "select count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'view') as view, 0::bigint as ghost from events")
def run_stats(spark, d):
    return reports.run_stats(table(spark, d, "events"), "event_type", ("click", "view", "ghost"))


@query("set08_special_tokens", "select unnest(['<a>', '<b>']) as token")
def special(spark, d):
    own = F.concat("text", F.get(array_of("<a>", "<b><end>", ""), (F.col("doc_id") % 3).cast("int")))
    return reports.special_tokens(table(spark, d, "documents").withColumn("text", own), "doc_id", "text", ["<a>", "<b>", "<c>", "<end>"], "<end>")


@query("join16_pairs", "select user_id, bool_or(event_type = 'click') and bool_or(event_type = 'error') as complete from events group by 1")
def pairs(spark, d):
    return reports.pairs_of(table(spark, d, "events"), "user_id", "event_type", "click", "error")


@query("set03_unknown_names", "select name from (values ('click'), ('ghost'), ('none')) t(name) where name not in (select event_type from events)")
def unknown(spark, d):
    return reports.unknown_names(spark.sql("select * from values ('click'), ('ghost'), ('none') as t(name)"), table(spark, d, "events").select(F.col("event_type").alias("name")), "name")


@query("set04_by_content", "select min(doc_id) as doc_id from documents where text is not null group by sha256(text)")
def by_content(spark, d):
    return reports.by_content(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


@query("gen02_draws", "select index, ((('0x' || substr(sha256('20260317|model|' || index), 1, 15))::bigint) % 20)::int as model, ((('0x' || substr(sha256('20260317|persona|' || index), 1, 15))::bigint) % 20)::int as persona, ((('0x' || substr(sha256('20260317|situation|' || index), 1, 15))::bigint) % 89)::int as situation from (select event_id as index from events)")
def draws(spark, d):
    i = F.col("index")
    rows = table(spark, d, "events").select(F.col("event_id").alias("index"))
    return rows.select("index", *[sampling.draw("20260317", i, salt, n).alias(salt) for salt, n in (("model", 20), ("persona", 20), ("situation", 89))])


# -- providers ----------------------------------------------------------------------------------

_ERRORS = {"click": None, "view": "429 Too Many Requests", "purchase": "Read timed out", "error": "401 bad key", "signup": "odd"}


def _outcomes(spark, d):
    """Events as outcomes of calls to endpoints (users); user 7's is retired by its last event."""
    error = None
    for kind, text in _ERRORS.items():
        value = F.lit(text).cast("string")
        error = F.when(F.col("event_type") == kind, value) if error is None else error.when(F.col("event_type") == kind, value)
    rows = table(spark, d, "events").select(F.col("user_id").cast("string").alias("endpoint"), F.col("event_id").alias("seq"), F.col("event_id").cast("double").alias("at"), error.otherwise("odd").alias("error"))
    rows = rows.withColumn("error", F.when((F.col("endpoint") == "7") & (F.col("seq") % 11 == 0), "410 Gone").otherwise(F.col("error")))
    return rows.select("endpoint", "seq", "at", endpoints.outcome_of(F.col("error")).alias("outcome"), (F.col("seq") % 7).cast("int").alias("attempt"), F.lit(0.5).alias("jitter"))


_STATE_SQL = """with o as (select user_id::varchar as endpoint, event_id as seq, case when user_id = 7 and event_id % 11 = 0 then 'retired' when event_type = 'click' then 'ok' when event_type = 'view' then 'saturated' when event_type = 'purchase' then 'timeout' when event_type = 'error' then 'refused' else 'other' end as outcome from events),
r as (select *, count(*) filter (outcome = 'ok') over (partition by endpoint order by seq) as run from o),
c as (select *, count(*) filter (outcome = 'timeout') over (partition by endpoint, run order by seq) as strikes from r),
w as (select *, case outcome when 'saturated' then least(2.0 * pow(2, least(seq % 7, 5)), 45.0) * 1.2 when 'timeout' then least(30.0 * pow(2, strikes - 1), 3600.0) when 'refused' then 86400.0 end as rest from c),
s as (select endpoint, bool_or(outcome = 'retired') as retired, arg_max(strikes, seq) as strikes, coalesce(arg_max(seq + rest, seq) filter (rest is not null), 0.0)::double as until from w group by 1) """


@query("str04_endpoint_states", _STATE_SQL + "select * from s")
def endpoint_states(spark, d):
    return endpoints.endpoint_states(_outcomes(spark, d))


@query("flt13_available", _STATE_SQL + "select endpoint from s where not retired and until <= 3000.0 or (not exists (select 1 from s where not retired and until <= 3000.0) and endpoint = (select endpoint from s where not retired order by until, endpoint limit 1))")
def available(spark, d):
    return endpoints.available(endpoints.endpoint_states(_outcomes(spark, d)), F.lit(3000.0)).select("endpoint")


@query("srt11_soonest", _STATE_SQL + "select endpoint from s where not retired order by until, endpoint limit 1")
def soonest(spark, d):
    return endpoints.available(endpoints.endpoint_states(_outcomes(spark, d)), F.lit(-1.0)).select("endpoint")


@query("str05_folded", "select user_id, nullif(string_agg(case when event_type <> 'view' then event_type end, '' order by event_id), '') as reasoning, nullif(string_agg(case when event_type = 'view' and user_id % 4 <> 0 then 'v' end, '' order by event_id), '') as content, case when user_id % 2 = 1 then 'stop' when bool_or(event_type <> 'view') and not bool_or(event_type = 'view' and user_id % 4 <> 0) then 'length' end as finish_reason from events group by 1")
def folded(spark, d):
    said = F.col("event_type") != "view"
    deltas = table(spark, d, "events").select("user_id", "event_id", F.when(said, F.col("event_type")).alias("reasoning"), F.when(~said & (F.col("user_id") % 4 != 0), "v").alias("content"), F.when(F.col("user_id") % 2 == 1, "stop").alias("finish_reason"))
    return endpoints.folded(deltas, "user_id", "event_id")


@query("src11_provider", "select o_orderkey, 'Order ' || o_orderkey as content, null::varchar as error from orders")
def provider_replies(spark, d):
    """A stand-in provider that repeats the prompt's last line."""
    rows = table(spark, d, "orders").select("o_orderkey", F.lit("Be brief.").alias("system"), F.concat(F.lit("Say:\nOrder "), F.col("o_orderkey").cast("string")).alias("user"))
    return endpoints.ask(rows, lambda: endpoints.canned).select("o_orderkey", "content", "error")
