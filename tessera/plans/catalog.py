"""Registered queries of the library's own operators, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import call_checks, facts, gate, generation, preparation, query_api, relations, sampling, scoring, summaries, verdicts
from ..sources import catalogs
from ..sources.jsonl import MESSAGE
from .registry import ORACLE, QUERIES, call as _call, conversations, message, query, quoted, table  # noqa: F401

FLAGSHIP = "agg01_read_group"


# -- reads --------------------------------------------------------------------------------------


@query(FLAGSHIP, "select o_orderpriority, count(*) as __count, sum(cast(o_totalprice as decimal(18,2)))::double as total from orders where o_orderstatus = 'F' and o_totalprice > 50000 group by 1")
def read_group(spark, d):
    orders = table(spark, d, "orders").withColumn("total", F.col("o_totalprice").cast("decimal(18,2)"))
    out = query_api.read_group(orders, [["o_orderstatus", "=", "F"], ["o_totalprice", ">", 50000]], ["o_orderpriority"], ["total:sum"])
    return out.select("o_orderpriority", "__count", F.col("total_sum").cast("double").alias("total"))


@query("agg01_count_only", "select c_mktsegment, count(*) as __count from customer group by 1")
def count_only(spark, d):
    return query_api.read_group(table(spark, d, "customer"), [], ["c_mktsegment"], ["__count"])


@query("agg01_multi", "select l_returnflag, l_linestatus, count(*) as __count, sum(cast(l_quantity as decimal(18,2)))::double as qty, sum(cast(l_extendedprice as decimal(18,2)))::double as price from lineitem group by 1, 2")
def read_group_multi(spark, d):
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", *[F.col(c).cast("decimal(18,2)").alias(n) for c, n in (("l_quantity", "qty"), ("l_extendedprice", "price"))])
    out = query_api.read_group(lines, [], ["l_returnflag", "l_linestatus"], ["qty:sum", "price:sum"])
    return out.select("l_returnflag", "l_linestatus", "__count", *[F.col(f"{n}_sum").cast("double").alias(n) for n in ("qty", "price")])


@query("flt01_search_read", "select o_orderkey, o_custkey, o_totalprice from orders where o_orderdate >= timestamp '1995-01-01' and o_totalprice > 1000 order by o_orderkey limit 50")
def search_read(spark, d):
    return query_api.search_read(table(spark, d, "orders"), [["o_orderdate", ">=", F.lit("1995-01-01").cast("timestamp_ntz")], ["o_totalprice", ">", 1000]], ["o_custkey", "o_totalprice"], id_field="o_orderkey", order=["o_orderkey"], limit=50)


@query("flt01_in", "select o_orderkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH')")
def domain_in(spark, d):
    return query_api.search_read(table(spark, d, "orders"), [["o_orderpriority", "in", ["1-URGENT", "2-HIGH"]]], ["o_orderkey"])


@query("flt01_ilike", "select p_partkey, p_name from part where contains(lower(p_name), 'a')")
def domain_ilike(spark, d):
    return query_api.search_read(table(spark, d, "part"), [["p_name", "ilike", "A"]], ["p_partkey", "p_name"])


@query("flt01_prefix_operators", "select o_orderkey from orders where (o_orderstatus = 'F' or o_totalprice < 2000) and not (o_orderpriority = '5-LOW')")
def prefix_operators(spark, d):
    return query_api.search_read(table(spark, d, "orders"), ["&", "|", ["o_orderstatus", "=", "F"], ["o_totalprice", "<", 2000], "!", ["o_orderpriority", "=", "5-LOW"]], ["o_orderkey"])


@query("join18_dotted_path", "select o_orderkey from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING'")
def dotted(spark, d):
    return query_api.search_read(table(spark, d, "orders"), [["o_custkey.c_mktsegment", "=", "BUILDING"]], ["o_orderkey"], relations={"o_custkey": (table(spark, d, "customer"), "c_custkey")})


@query("join18_two_levels", "select o_orderkey from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where n_name <> 'FRANCE' and n_regionkey = 2 and c_acctbal > 100")
def dotted_deep(spark, d):
    related = {"o_custkey": (table(spark, d, "customer"), "c_custkey"), "c_nationkey": (table(spark, d, "nation"), "n_nationkey")}
    domain = [["o_custkey.c_nationkey.n_name", "!=", "FRANCE"], ["o_custkey.c_nationkey.n_regionkey", "=", 2], ["o_custkey.c_acctbal", ">", 100]]
    return query_api.search_read(table(spark, d, "orders"), domain, ["o_orderkey"], relations=related)


@query("flt02_pinpoint", "select p_partkey, p_name, p_brand from part where p_partkey = 7 limit 1")
def pinpoint(spark, d):
    return query_api.search_read(table(spark, d, "part"), [["p_partkey", "=", 7]], ["p_name", "p_brand"], id_field="p_partkey", limit=1)


@query("flt03_drop_pinned", "select o_orderstatus, count(*) as __count from orders where o_totalprice > 1000 group by 1")
def drop_pinned(spark, d):
    domain = query_api.drop_pinned([["o_orderstatus", "=", "F"], ["o_totalprice", ">", 1000]], "o_orderstatus")
    return query_api.read_group(table(spark, d, "orders"), domain, ["o_orderstatus"], [])


@query("srt06_limit_with_total", "select o_orderkey, (select count(*) from orders) as total from orders order by o_totalprice desc, o_orderkey limit 20")
def limit_total(spark, d):
    return query_api.first_of_total(table(spark, d, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 20).select("o_orderkey", "total")


# -- transcripts --------------------------------------------------------------------------------


@query("prj07_first_exchange", "with f as (select conv_id, min(turn) filter (role = 'assistant') as t from conversations group by 1) select c.conv_id, count(*) filter (t is null or turn < t) as prompt_turns, max(text) filter (turn = t) as gold from conversations c join f using (conv_id) group by 1")
def first_exchange(spark, d):
    c = conversations(spark, d).select("conv_id", preparation.first_exchange(F.col("messages")).alias("x"))
    return c.select("conv_id", F.size("x.prompt").cast("bigint").alias("prompt_turns"), F.col("x.gold.content").alias("gold"))


@query("win10_final_answer", "select conv_id, coalesce(arg_max(text, turn) filter (role = 'assistant' and text <> ''), '') as answer from conversations group by 1")
def final_answer(spark, d):
    return conversations(spark, d).select("conv_id", gate.final_answer(F.col("messages")).alias("answer"))


@query("prj16_chatml", "select conv_id, sha256(string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by turn)) as rendered from conversations group by 1")
def chatml(spark, d):
    return conversations(spark, d).select("conv_id", F.sha2(preparation.chatml(F.col("messages")), 256).alias("rendered"))


@query("prj18_sample_key", "select doc_id, substr(sha256('2.0|' || source || '|' || doc_id || '|' || lang), 1, 24) as key from documents")
def sample_key(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.sample_key(F.lit("2.0"), F.col("source"), F.col("doc_id").cast("string"), F.col("lang")).alias("key"))


@query("prj19_group_key", "select lang || '::' || source as gkey, count(*) as n from documents group by 1")
def group_keys(spark, d):
    return table(spark, d, "documents").groupBy(tx.group_key(F.col("lang"), F.col("source")).alias("gkey")).agg(F.count("*").alias("n"))


@query("txt02_normalise", "select doc_id, sha256(trim(regexp_replace(regexp_replace(lower(text), '[0-9]+', '#', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'))) as h from documents")
def normalise(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(tx.normalise(F.col("text")), 256).alias("h"))


@query("txt01_strip_think", "select doc_id, sha256(case when doc_id % 5 = 2 then ' ' || text else text end) as h from documents")
def strip_think(spark, d):
    own = F.when(F.col("doc_id") % 5 == 2, F.concat(F.lit("<think>a\nb</think> "), F.col("text"))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.sha2(tx.strip_think(own), 256).alias("h"))


# -- the gate -----------------------------------------------------------------------------------

def _gate_query(name: str, rule: str, phrase: str, pattern: str, role: str, each: str) -> None:
    """A predicate over all conversations, of which every seventh has a turn with the phrase."""
    malformed = "count(*) < 2 or count(*) filter (role not in ('system','user','assistant','tool')) > 0 or count(*) filter (role = 'user') = 0 or count(*) filter (role = 'assistant') = 0"
    own = f"case when conv_id % 7 = 3 and role = {quoted(role)} then {quoted(phrase)} || coalesce(text, '') else coalesce(text, '') end"
    if each == "final":
        own = f"case when conv_id % 7 = 3 and role = {quoted(role)} then coalesce(text, '') || {quoted(phrase)} else coalesce(text, '') end"
    joined = "coalesce(string_agg(x, chr(10) order by turn) filter (role = 'assistant'), '')"
    tests = {
        "joined": f"regexp_matches({joined}, {quoted(pattern)})",
        "final": f"regexp_matches(coalesce(arg_max(x, turn) filter (role = 'assistant' and x <> ''), ''), {quoted(pattern)})",
        "user": f"bool_or(role = 'user' and regexp_matches(trim(x, E' \\t\\n\\r'), {quoted(pattern)}))",
        "think": f"len(string_split({joined}, '<think>')) <> len(string_split({joined}, '</think>'))",
    }
    sql = f"select conv_id, not ({malformed}) and {tests[each]} as rejected from (select *, {own} as x from conversations) group by 1"

    @query(name, sql)
    def run(spark, d):
        here = (F.col("conv_id") % 7 == 3) & (F.col("role") == role)
        parts = ("text", F.lit(phrase)) if each == "final" else (F.lit(phrase), "text")
        said = F.when(here, F.concat(*[F.coalesce(p, F.lit("")) for p in parts])).otherwise(F.col("text"))
        c = conversations(spark, d, said)
        return c.select("conv_id", F.array_contains(verdicts.reasons(F.col("messages"), "Acme", "acme_", wanted=(rule,)), rule).alias("rejected"))


_gate_query("qg04_robotic_prompt", "robotic_prompt", "Perform full end-to-end management of Acme model sale. ", gate.robotic("Acme"), "user", "user")
_gate_query("qg05_user_turn_meta", "user_turn_meta", "per the instruction ", gate.user_meta("Acme"), "user", "user")
_gate_query("qg06_broken_think", "broken_think", "<think>open ", "", "assistant", "think")
_gate_query("qg09_version_drift", "version_drift", "On Acme 14.0 this differs. ", gate.version_drift("Acme"), "assistant", "joined")
_gate_query("qg10_prompt_artifact", "prompt_artifact", "As an AI I cannot. ", gate.PROMPT_ARTIFACT, "assistant", "joined")
_gate_query("qg11_instruction_echo", "instruction_echo", "Never mention Acme here. ", gate.instruction_echo("Acme"), "assistant", "joined")
_gate_query("qg12_prompt_leak", "prompt_leak", "=== Acme 19 model technical definition === ", gate.prompt_leak("Acme"), "assistant", "joined")
_gate_query("qg13_chatty", "chatty", " Happy configuring", gate.chatty("Acme"), "assistant", "final")
_gate_query("qg16_fabricated_reference", "fabricated_reference", "See INV/2024/0012. ", "(?i)\\b(?:INV|BILL|RINV|RBILL|SO|PO|POS|BNK[0-9]?|MO|RO)[-/]20(?:[01][0-9]|2[0-57-9])[-/][0-9]|\\b(?:INV|BILL|SO|PO)[-/]?20(?:[01][0-9]|2[0-57-9])\\b", "assistant", "joined")
_gate_query("qg17_teacher_voice", "teacher_voice", "Since the user asked, done. ", gate.TEACHER_VOICE, "assistant", "joined")


@query("qg03_thin_user_turn", "select conv_id, length(trim(case when conv_id % 7 = 3 then ' go ' else coalesce(arg_min(coalesce(text, ''), turn) filter (role = 'user'), '') end, E' \\t\\n\\r')) < 12 and not (count(*) < 2 or count(*) filter (role not in ('system','user','assistant','tool')) > 0 or count(*) filter (role = 'user') = 0 or count(*) filter (role = 'assistant') = 0) as thin from conversations group by 1")
def thin_user(spark, d):
    said = F.when((F.col("conv_id") % 7 == 3) & (F.col("role") == "user"), F.lit(" go ")).otherwise(F.col("text"))
    return conversations(spark, d, said).select("conv_id", F.array_contains(verdicts.reasons(F.col("messages"), wanted=("thin_user_turn",)), "thin_user_turn").alias("thin"))


_MALFORMED = "(count(*) < 2 or count(*) filter (role not in ('system','user','assistant','tool')) > 0 or count(*) filter (role = 'user') = 0 or count(*) filter (role = 'assistant') = 0)"


@query("qg14_tool_call_as_text", f"select conv_id, not {_MALFORMED} and conv_id % 7 = 3 and conv_id % 2 = 1 as rejected from conversations group by 1")
def call_as_text(spark, d):
    """Every seventh conversation shows a call; only the odd ones also make one."""
    said = F.when((F.col("conv_id") % 7 == 3) & (F.col("role") == "assistant"), F.concat(F.lit("acme_create('x')\n"), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    acts = F.array(_call("acme_create", F.lit("{}")))
    c = conversations(spark, d, said)
    called = F.transform("messages", lambda m: F.when((m["role"] == "assistant") & (F.col("conv_id") % 2 == 1), message("assistant", m["content"], acts)).otherwise(m))
    found = verdicts.reasons(called, "Acme", "acme_", wanted=("tool_call_as_text",))
    return c.select("conv_id", F.array_contains(found, "tool_call_as_text").alias("rejected"))


def _acted(tool: str, result, answer) -> F:
    """A transcript (request, one call, its result, answer) of an order."""
    made = F.array(_call(tool, F.to_json(F.struct("o_orderkey"))))
    return F.array(message("user", "What about this order, please?"), message("assistant", "", made), message("tool", result, None, "c"), message("assistant", answer))


@query("qg15_state_claim", "select o_orderkey, o_orderkey % 5 = 0 and o_orderstatus <> 'O' or o_orderkey % 5 = 1 as unsupported from orders")
def state_claim(spark, d):
    said = F.when(F.col("o_orderkey") % 5 == 0, "The status is now 'open_o'.").when(F.col("o_orderkey") % 5 == 1, "It is now in state `gone`.").otherwise("Nothing to report.")
    result = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct(F.concat(F.lit("Open_"), "o_orderstatus").alias("state")))).otherwise(F.to_json(F.array(F.struct(F.concat(F.lit("OPEN_"), "o_orderstatus").alias("payment_state")))))
    return table(spark, d, "orders").select("o_orderkey", call_checks.unsupported_state(_acted("tool_search_read", result, said)).alias("unsupported"))


@query("qg25_unmade_write", "select o_orderkey, o_orderkey % 3 = 0 and o_orderkey % 2 = 0 as claimed from orders")
def unmade_write(spark, d):
    said = F.when(F.col("o_orderkey") % 3 == 0, "I confirmed the order.").when(F.col("o_orderkey") % 3 == 1, "No entry has been posted yet.").otherwise("I will confirm it.")
    read, wrote = (_acted(t, F.lit("{}"), said) for t in ("tool_search_read", "tool_write"))
    checked = call_checks.unmade_write(F.when(F.col("o_orderkey") % 2 == 0, read).otherwise(wrote))
    return table(spark, d, "orders").select("o_orderkey", checked.alias("claimed"))


@query("qg18_bad_arguments", "select event_id, not (event_id % 11 <> 0 and json_valid(props)) as bad from events")
def bad_arguments(spark, d):
    own = F.when(F.col("event_id") % 11 == 0, F.substring("props", 2, 1000)).otherwise(F.col("props"))
    parsed = F.try_parse_json(own)
    return table(spark, d, "events").select("event_id", F.coalesce(~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(True)).alias("bad"))


def _execute_events(spark, d) -> DataFrame:
    """Each event as a transcript with one call of its type on its user's group."""
    model = F.concat(F.lit("u"), (F.col("user_id") % 7).cast("string"))
    args = F.to_json(F.struct(model.alias("model"), F.col("event_type").alias("method")))
    return table(spark, d, "events").select("event_id", F.array(message("assistant", "", F.array(_call("tool_execute_method", args)))).alias("messages"))


@query("qg19_unknown_model", "select event_id from events where user_id % 7 in (5, 6)")
def unknown_model(spark, d):
    known = spark.sql("select concat('u', id) as model, explode(array('click', 'view', 'purchase', 'error', 'login', 'logout', 'signup', 'refund', 'scroll', 'search')) as method from range(5)")
    found = call_checks.call_reasons(_execute_events(spark, d), "event_id", known)
    return found.where(F.array_contains("reasons", "unknown_model")).select("event_id")


@query("qg20_hallucinated_method", "select event_id from events where event_type not in ('click', 'write') and event_id % 5 <> 0")
def hallucinated(spark, d):
    """Every fifth call is of a method that all models have."""
    args = F.to_json(F.struct(F.lit("m").alias("model"), F.when(F.col("event_id") % 5 == 0, "message_post").otherwise(F.col("event_type")).alias("method")))
    calls = table(spark, d, "events").select("event_id", F.array(message("assistant", "", F.array(_call("tool_execute_method", args)))).alias("messages"))
    found = call_checks.call_reasons(calls, "event_id", spark.sql("select 'm' as model, 'click' as method"))
    return found.where(F.array_contains("reasons", "hallucinated_method")).select("event_id")


@query("qg02_orphan_result", "select user_id, count(*) filter (event_id % 3 <> 1) as results, bool_or(event_id % 3 = 0 and event_type not in (select distinct c.event_type from events c where c.user_id = e.user_id and c.event_id % 3 = 1) or event_id % 3 = 2) as orphan from events e group by 1")
def orphans(spark, d):
    """A user's events as one transcript: calls (event_id % 3 = 1) and results of the call named by
    the type, or of none."""
    third = F.col("event_id") % 3
    turn = F.when(third == 1, message("assistant", "", F.array(_call("tool_read", F.lit("{}"), F.col("event_type"))))).otherwise(message("tool", "{}", None, F.when(third == 0, F.col("event_type"))))
    own = table(spark, d, "events").groupBy("user_id").agg(F.count_if(third != 1).alias("results"), F.collect_list(turn).alias("messages"))
    return own.select("user_id", "results", call_checks.orphan_results(F.col("messages")).alias("orphan"))


@query("qg21_placeholder", "select p_partkey from part where p_partkey % 9 = 0")
def placeholder(spark, d):
    own = F.when(F.col("p_partkey") % 9 == 0, F.concat(F.lit("Sample Name #"), F.col("p_partkey"))).otherwise(F.col("p_name"))
    args = F.to_json(F.struct(F.lit("m").alias("model"), F.struct(own.alias("name"), F.col("p_size").alias("size")).alias("values")))
    calls = table(spark, d, "part").select("p_partkey", F.array(message("assistant", "", F.array(_call("tool_create", args)))).alias("messages"))
    return call_checks.call_reasons(calls, "p_partkey").where(F.array_contains("reasons", "placeholder_values")).select("p_partkey")


@query("qg22_over_length", "select doc_id, length(text) > 32768 as over_length from documents")
def over_length(spark, d):
    return table(spark, d, "documents").select("doc_id", (F.length("text") > gate.MAX_CHARS).alias("over_length"))


_NEAR_SQL = "sha256(trim(regexp_replace(regexp_replace(lower(substr(text, 1, 600)), '[0-9]+', '#', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g')))"


@query("qg23_dedup", f"with k as (select doc_id, row_number() over (partition by sha256(text) order by doc_id) as e, row_number() over (partition by {_NEAR_SQL} order by doc_id) as n from documents) select doc_id, e > 1 as duplicate, e = 1 and n > 1 as near_duplicate from k")
def dedup(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text")
    return gate.first_wins(rows, "doc_id", F.col("text"), tx.normalise(F.substring("text", 1, 600))).drop("text")


@query("agg03_tally", "select 'thin' as reason, count(*) as n from documents where n_chars < 500 having count(*) > 0 union all select 'long', count(*) from documents where n_chars > 3000 having count(*) > 0 union all select 'foreign', count(*) from documents where lang <> 'en' having count(*) > 0")
def rejection_tally(spark, d):
    rows = table(spark, d, "documents").select(F.array_compact(F.array(F.when(F.col("n_chars") < 500, "thin"), F.when(F.col("n_chars") > 3000, "long"), F.when(F.col("lang") != "en", "foreign"))).alias("reasons"))
    return summaries.tally(rows, "reasons")


# -- joins, catalog -----------------------------------------------------------------------------

_EDGES = "('orders','customer','Many2one','o_custkey'),('customer','nation','Many2one','c_nationkey'),('supplier','nation','Many2one','s_nationkey'),('nation','region','Many2one','n_regionkey'),('lineitem','orders','Many2one','l_orderkey'),('lineitem','part','Many2one','l_partkey'),('lineitem','supplier','Many2one','l_suppkey'),('orders','lineitem','One2many','lines'),('part','part','Many2one','parent')"
_EDGE_SQL = f"(values {_EDGES}) as e(source_model, target_model, rel_type, field_name)"
_METHODS = "('order','action_confirm'),('order','button_cancel'),('order','action_view_lines'),('order','action_done'),('order','compute_total_amount_again'),('order','action_send_swiss_report_x'),('order','action_l10n_x'),('order','pay_sepa_batch'),('part','button_validate'),('part','action_archive'),('part','print_label')"


def edges(spark) -> DataFrame:
    return spark.sql(f"select * from values {_EDGES} as e(source_model, target_model, rel_type, field_name)")


@query("join15_neighbours", f"select source_model, target_model, field_name, case when source_model = 'orders' then target_model else source_model end as other from {_EDGE_SQL} where source_model = 'orders' or target_model = 'orders'")
def neighbours(spark, d):
    return relations.neighbours(edges(spark), "orders").select("source_model", "target_model", "field_name", "other")


@query("join15_within", f"with recursive e2 as (select source_model a, target_model b from {_EDGE_SQL} union select target_model, source_model from {_EDGE_SQL}), w(model, steps) as (select 'orders', 0 union select e2.b, w.steps + 1 from w join e2 on e2.a = w.model where w.steps < 2) select model, min(steps) as steps from w group by 1")
def within(spark, d):
    return relations.within(edges(spark), "orders", 2)


@query("srt02_relations", f"with s(model) as (values ('orders'), ('lineitem'), ('customer')), e as (select e.*, target_model in (select model from s) as on_surface from {_EDGE_SQL} where source_model in (select model from s) and source_model <> target_model) select source_model, field_name, row_number() over (partition by source_model order by not on_surface, field_name not in ('l_partkey'), length(field_name), field_name)::int as rank from e qualify rank <= 6")
def ranked(spark, d):
    surface = spark.sql("select * from values ('orders'), ('lineitem'), ('customer') as s(model)")
    return relations.ranked_relations(edges(spark), surface, ["l_partkey"]).select("source_model", "field_name", "rank")


@query("srt01_method_rank", "select * from (values ('order','button_cancel',105,1),('order','action_confirm',100,2),('order','action_done',96,3),('order','compute_total_amount_again',67,4),('part','button_validate',109,1),('part','action_archive',82,2),('part','print_label',0,3)) as t(model, method, score, rank)")
def method_rank(spark, d):
    methods = spark.sql(f"select * from values {_METHODS} as m(model, method)")
    return relations.top_methods(methods, "model", "method")


@query("join02_verified", "select s_suppkey from supplier where s_nationkey in (select n_nationkey from nation where n_regionkey < 3)")
def verified(spark, d):
    known = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"))
    return relations.verify(table(spark, d, "supplier"), known, ["s_nationkey"])[0].select("s_suppkey")


@query("join02_warnings", "select s_suppkey from supplier where s_nationkey not in (select n_nationkey from nation where n_regionkey < 3)")
def warnings(spark, d):
    known = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"))
    return relations.verify(table(spark, d, "supplier"), known, ["s_nationkey"])[1].select("s_suppkey")


@query("join13_upsert", "select user_id, arg_max(event_type, event_id) as event_type, max(event_id) as event_id from events group by 1")
def upsert(spark, d):
    return relations.upsert_last_wins(table(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_id")


@query("snk02_append", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 25)")
def append(spark, d):
    known = table(spark, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"))
    return relations.append_if_absent(known, table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@query("join09_fallback", "select s_suppkey, coalesce(case when n_nationkey % 2 = 0 then n_name end, r_name) as label from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def fallback(spark, d):
    nation = table(spark, d, "nation")
    rows = table(spark, d, "supplier").join(F.broadcast(nation.select("n_nationkey", "n_regionkey")), F.col("s_nationkey") == F.col("n_nationkey"))
    exact = nation.where("n_nationkey % 2 = 0").select("n_nationkey", F.col("n_name").alias("label"))
    wide = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("label"))
    return relations.fallback_join(rows, exact, "n_nationkey", wide, "n_regionkey", "label").select("s_suppkey", "label")


# -- aggregates, samples ------------------------------------------------------------------------


@query("agg04_manifest", "select case when grouping(lang) = 0 then 'lang' when grouping(source) = 0 then 'source' when grouping(quality) = 0 then 'quality' else 'total' end as dimension, case when grouping(lang) = 0 then lang when grouping(source) = 0 then source when grouping(quality) = 0 then quality::varchar else '' end as value, count(*) as n from documents left join labels using (doc_id) group by grouping sets ((lang), (source), (quality), ())")
def manifest(spark, d):
    return summaries.manifest(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), ["lang", "source", "quality"])


@query("agg06_resume_index", "select event_type, count(*) as n, greatest(max(event_id) + 1, count(*)) as next_index from events group by 1")
def resume(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.greatest(F.max("event_id") + 1, F.count("*")).alias("next_index"))


@query("agg05_shortfall", "with t as (select event_type, 2500 as target from events group by 1), h as (select event_type, count(*) as have from events group by 1) select event_type, target, have, greatest(0, target - have) as missing from t join h using (event_type)")
def shortfall(spark, d):
    events = table(spark, d, "events")
    return summaries.shortfall(events.select("event_type").distinct().withColumn("target", F.lit(2500)), events, "event_type")


@query("agg08_scorecard", "select count(*) as samples, count(*) filter (n_chars > 500) as long, round(100.0 * count(*) filter (n_chars > 500) / greatest(count(*), 1), 1) as long_pct, count(*) filter ((n_chars > 500) = (quality = 1)) as agree, round(100.0 * count(*) filter ((n_chars > 500) = (quality = 1)) / greatest(count(*), 1), 1) as agree_pct from documents join labels using (doc_id)")
def scorecard(spark, d):
    pairs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return summaries.scorecard(pairs, {"long": F.col("n_chars") > 500, "agree": (F.col("n_chars") > 500) == (F.col("quality") == 1)})


@query("agg10_quantiles", "with s as (select list_sort(list(n_chars)) as x from documents where n_chars is not null) select len(x) as n, x[len(x) // 2 + 1] as median, x[floor(len(x) * 0.95)::bigint + 1] as p95, x[len(x)] as largest, len(list_filter(x, lambda v: v > 3000)) / len(x) as share_over from s")
def quantiles(spark, d):
    return summaries.discrete_quantiles(table(spark, d, "documents"), "n_chars", 3000)


@query("agg14_method_index", "select user_id, array_to_string(list_sort(list_distinct(list(event_type) || ['create', 'write'])), ',') as methods from events group by 1")
def method_index(spark, d):
    known = F.array_sort(F.array_union(F.collect_set("event_type"), F.array(F.lit("create"), F.lit("write"))))
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(known, ",").alias("methods"))


@query("win01_split", "with g as (select lang || '::' || source as gkey, count(*) as n from documents group by 1), c as (select gkey, coalesce(sum(n) over (order by sha256(gkey), gkey rows between unbounded preceding and 1 preceding), 0) as before, sum(n) over () as total from g) select doc_id, case when before < floor(total * 0.05) then 'eval' else 'train' end as split from documents join c on gkey = lang || '::' || source")
def split(spark, d):
    rows = table(spark, d, "documents").select("doc_id", tx.group_key(F.col("lang"), F.col("source")).alias("gkey"))
    return sampling.leak_free_split(rows, "gkey", 0.05, F.sha2("gkey", 256)).select("doc_id", "split")


@query("win02_focus_mix", "with f as (select count(distinct source) as k from documents), o as (select doc_id, source, row_number() over (partition by source order by doc_id) as nth from documents where source <> 'src0') select doc_id from documents where source = 'src0' union all select doc_id from o, f where nth <= greatest(1, 200 // greatest(k - 1, 1))")
def focus_mix(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "source")
    return sampling.focus_mix(rows, "source", ["src0"], 200, F.col("doc_id"), rows.select("source").distinct().count()).select("doc_id")


@query("win03_repetition", "select event_id, row_number() over (partition by user_id, event_type order by event_id) - 1 as nth from events")
def repetition(spark, d):
    return table(spark, d, "events").select("event_id", (F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id")) - 1).cast("bigint").alias("nth"))


@query("win04_budget_cycle", "with p as (select n_regionkey, n_nationkey, row_number() over (partition by n_regionkey order by n_nationkey) - 1 as pos, count(*) over (partition by n_regionkey) as k from nation) select n_regionkey, n_nationkey, draw::int as draw from p, range(34) r(draw) where draw % k = pos")
def budget_cycle(spark, d):
    return sampling.budget_cycle(table(spark, d, "nation").select("n_regionkey", "n_nationkey"), "n_regionkey", "n_nationkey", 34)


@query("win05_interleave", "with p as (select p_partkey, case when p_size <= 20 then 1 when p_size <= 35 then 2 when p_size <= 45 then 3 else 4 end as tier from part), n as (select *, row_number() over (partition by tier order by p_partkey) - 1 as pos, count(*) over (partition by tier) as k from p), s as (select slot, case when slot % 100 < 50 then 1 when slot % 100 < 80 then 2 when slot % 100 < 95 then 3 else 4 end as tier from range(3000) r(slot)), t as (select slot, tier, row_number() over (partition by tier order by slot) - 1 as turn from s) select slot, p_partkey from t join n using (tier) where turn % k = pos")
def interleave(spark, d):
    tier = F.when(F.col("p_size") <= 20, 1).when(F.col("p_size") <= 35, 2).when(F.col("p_size") <= 45, 3).otherwise(4)
    rows = table(spark, d, "part").select("p_partkey", tier.alias("tier"))
    return sampling.tier_interleave(spark, rows, "tier", "p_partkey", 3000).select("slot", "p_partkey")


@query("win07_round_targets", "with t as (select event_type, count(*) as target from events group by 1) select event_type, r::int as round, least(target, r * 500) as goal from t, range(1, 100000) x(r) where r <= greatest(ceil(target / 500), 1)")
def rounds(spark, d):
    t = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("target"))
    return sampling.round_targets(t, "target", 500).select("event_type", "round", "goal")


@query("win11_until_failure", "with f as (select *, coalesce(max(case when event_type = 'error' then 1 else 0 end) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) as f from events) select event_id from f where f = 0")
def until_failure(spark, d):
    return sampling.prefix_until(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "error").select("event_id")


@query("win12_record_memo", "select user_id, arg_min(props, event_id) as first_props, arg_max(event_type, event_id) as state from events group by 1")
def record_memo(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("props", "event_id").alias("first_props"), F.max_by("event_type", "event_id").alias("state"))


@query("json_arguments", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_arguments(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("set03_missing", "select n_nationkey from nation except select c_nationkey from customer where c_acctbal > 9000")
def missing(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"))
    return table(spark, d, "nation").select("n_nationkey").exceptAll(rich.distinct()).distinct()


# -- calls, scores, generated samples -----------------------------------------------------------


@query("qg22_messages_json", "select conv_id, (length(to_json(list({'role': role, 'content': coalesce(text, '')} order by turn))::varchar) + 4 * count(*) - 1)::bigint as json_chars from conversations group by 1")
def messages_json(spark, d):
    return conversations(spark, d).select("conv_id", call_checks.message_json_length(F.col("messages")).cast("bigint").alias("json_chars"))


def _call_row(name: str, args, text=None):
    """A message with one call, or with text only where the arguments are null."""
    made = F.array(F.struct(F.lit("c").alias("id"), F.lit("function").alias("type"), F.struct(F.lit(name).alias("name"), args.alias("arguments")).alias("function")))
    return F.struct(F.lit("assistant").alias("role"), (F.lit("") if text is None else text).alias("content"), F.when(args.isNotNull(), made).alias("tool_calls"), F.lit(None).alias("tool_call_id")).cast(MESSAGE)


@query(
    "qg18_call_reasons",
    "with c as (select distinct 'u' || (user_id % 7) as model, event_type as method from events where event_id % 2 = 0 and user_id % 7 < 5 and event_id % 3 = 0), "
    "e as (select event_id, event_id % 11 = 0 as bad, 'u' || (user_id % 7) as model, event_type as method from events), "
    "r as (select event_id, case when bad then 'bad_tool_args' when model not in (select model from c) then 'unknown_model' when not exists (select 1 from c where c.model = e.model and c.method = e.method) then 'hallucinated_method' end as reasons from e) select * from r where reasons is not null",
)
def call_reasons(spark, d):
    model = F.concat(F.lit("u"), (F.col("user_id") % 7).cast("string"))
    events = table(spark, d, "events").select("event_id", "user_id", model.alias("model"), F.col("event_type").alias("method"))
    args = F.when(F.col("event_id") % 11 == 0, "[1, 2]").otherwise(F.to_json(F.struct("model", "method")))
    known = events.where("event_id % 2 = 0 and user_id % 7 < 5 and event_id % 3 = 0").select("model", "method")
    found = call_checks.call_reasons(events.select("event_id", F.array(_call_row("tool_execute_method", args)).alias("messages")), "event_id", known)
    return found.select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    "agg08_first_actions",
    "select count(*) as samples, count(*) filter (event_id % 3 = 0) as right_method, count(*) filter (event_id % 3 = 0) as emitted_structured_call, count(*) filter (event_id % 3 = 1) as no_call_when_needed, count(*) filter (event_id % 3 = 2) as call_recovered_from_text, "
    "count(*) filter (event_id % 3 = 2) as fired_destructive, count(*) filter (event_id % 3 = 2 or (event_id % 3 = 0 and event_type not in ('click', 'view'))) as invented_method from events",
)
def first_actions(spark, d):
    events = table(spark, d, "events").select("event_id", F.to_json(F.struct(F.lit("m").alias("model"), F.col("event_type").alias("method"))).alias("args"))
    third = F.col("event_id") % 3
    written = F.when(third == 2, '{"name": "tool_execute_method", "arguments": {"model": "m", "method": "cancel_all"}}').otherwise("Which one?")
    pairs = events.select(_call_row("tool_execute_method", F.col("args")).alias("gold"), _call_row("tool_execute_method", F.when(third == 0, F.col("args")), F.when(third != 0, written).otherwise("")).alias("reply"))
    surface = spark.createDataFrame([("m", ["click", "view"], ["id"])], "model string, methods array<string>, fields array<string>")
    names = ("samples", "right_method", "emitted_structured_call", "no_call_when_needed", "call_recovered_from_text", "fired_destructive", "invented_method")
    return scoring.score(pairs, surface, ["tool_execute_method"]).select(*names)


_NAMES = ("action_confirm", "button_done", "action_mass_cancel", "send_all", "do_magic")


@query(
    "txt09_intents",
    "select o_orderkey, case o_orderkey % 5 when 0 then 'confirm the ' || o_orderstatus when 1 then 'complete the ' || o_orderstatus when 2 then 'cancel the ' || o_orderstatus || ' (mass cancel)' when 3 then 'send the ' || o_orderstatus || ' (send all)' else 'deal with the ' || o_orderstatus || ' — specifically, do magic' end as intent from orders",
)
def intents(spark, d):
    name = F.get(F.array(*map(F.lit, _NAMES)), (F.col("o_orderkey") % 5).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", relations.intent_of(name, F.col("o_orderstatus")).alias("intent"))


@query("prj13_questions", "select s_suppkey, case s_suppkey % 4 when 0 then 'How do I get from ' || s_name || ' to ' || n_name || '?' when 1 then 'Through which column does a supplier point to ' || n_name || '?' when 2 then 'I hold a supplier and want its ' || n_name || '. Which column leads there?' else 'Describe the link between ' || s_name || ' and ' || n_name || '.' end as question from supplier join nation on s_nationkey = n_nationkey")
def questions(spark, d):
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", facts.question(F.lit("relation"), F.col("s_suppkey"), model=F.col("s_name"), label=F.lit("supplier"), target=F.col("n_name")).alias("question"))


def _star_catalog(spark):
    """The star schema as a small catalog: specifications, personas, situations."""
    step = lambda name, a, b: {"name": name, "intent": name.replace("_", " "), "from_state": a, "to_state": b, "kwargs": "{}", "failures": [{"exc": "UserError", "message": "{ref} is locked."}], "returns_action": False}
    rows = [
        ("orders", "order", "sales", ["clerk"], [step("action_confirm", "O", "F"), step("action_cancel", "F", "cancel")], {"o_custkey": "partner_ref", "o_orderdate": "date_future"}, ["name", "partner_id", "state", "amount_total", "date"], "state", "ORD", 3, "A"),
        ("part", "part", "stock", ["keeper"], [step("action_apply", None, None)], {"p_name": "product_name"}, ["name", "quantity", "categ_id"], None, "PRT", 1, "B"),
    ]
    return (
        spark.createDataFrame(rows, catalogs.SPEC),
        spark.createDataFrame([("clerk", "Ann", "brief"), ("keeper", "Bo", "plain")], catalogs.PERSONA),
        spark.createDataFrame([(None, "sales", "late order"), ("part", "stock", "lost part")], catalogs.SITUATION),
    )


@query("gen06_trajectories")
def trajectories(spark, d):
    indices = table(spark, d, "events").select(F.col("event_id").alias("index"))
    return generation.generate(indices, *_star_catalog(spark), "agent_trajectories").select("_meta.*", F.sha2(F.to_json("messages"), 256).alias("messages_sha256"))


@query("gen07_reports")
def reports(spark, d):
    indices = table(spark, d, "events").select(F.col("event_id").alias("index"))
    return generation.generate(indices, *_star_catalog(spark), "report_analysis").select("_meta.*", F.sha2(F.to_json("messages"), 256).alias("messages_sha256"))


@query("gen09_fact_plan")
def fact_plan(spark, d):
    fields = spark.createDataFrame([("orders", "o_custkey", "Many2one", "customer", True), ("part", "p_name", "Char", None, True)], "model_name string, field_name string, field_type string, comodel_name string, required boolean")
    found = facts.derive(_star_catalog(spark)[0], fields, edges(spark).select("source_model", "target_model", F.lit("Many2one").alias("rel_type"), "field_name"))
    return facts.plan(found, "20260317").select(facts.fact_key().alias("fact"), "draw", "repetition", "question", F.sha2("grounding", 256).alias("grounding_sha256"))


from . import paths  # noqa: E402, F401  (registers its queries)
