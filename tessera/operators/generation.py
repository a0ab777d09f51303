"""Seeded transcripts: contexts drawn from a catalog, the calls they make, what the calls return.

An index is one row.  Each draw hashes the seed, the family and the index, so rows can be made
anywhere, in any order, and again after an executor is lost; a family is one narrow plan over a
range of indices, joined once with the weighted catalog.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sample_key
from ..functions.values import TODAY, Draws, field_value, json_list, json_object, json_text, value_of
from ..sources.jsonl import MESSAGE
from .facts import method_listing
from .query_api import drop_pinned
from .relations import is_destructive

# Columns that reads group by and sum.
GROUPABLE = ("state", "payment_state", "move_type", "priority")
MEASURABLE = (
    "amount_total", "amount_residual", "total_amount", "expected_revenue", "product_qty", "quantity", "list_price",
    "standard_price", "balance", "debit", "credit", "number_of_days", "allocated_hours", "effective_hours",
)
# End of fixed values.
VERSION = "2.0"
ERRORS = (
    ("AccessError", "You may not change {label} records ({model})."),
    ("MissingError", "The record does not exist or was deleted ({model}: {ref})."),
    ("UserError", "Someone else changed {ref} meanwhile. Load it again."),
    ("ValidationError", "A required field of {ref} is empty."),
)
CORRECTIONS = (
    ("ToolError", "Unknown model '{model}s'. Did you mean {model}?"),
    ("ToolError", "{model} has no method 'do_{method}'."),
    ("ToolResult", "Nothing was created: this is a preview of one {model} record. Ask the user to confirm."),
)


@dataclass(frozen=True)
class Family:
    """Steps of the transcript ("?" may fail or be left out, "!" fails, "user" is a second
    request), which methods may be drawn, and the stored shape."""

    steps: tuple[str, ...]
    methods: str
    shape: str
    core: bool = False


FAMILIES = {
    "tool_calling": Family(("execute",), "mutating", "single_call"),
    "lookup_then_act": Family(("pinpoint", "execute"), "mutating", "lookup_then_act"),
    "method_discovery": Family(("methods_get", "execute"), "mutating", "discover_then_act"),
    "answer_and_stop": Family(("answer",), "any", "answer_and_stop"),
    "workflow_execution": Family(("read", "execute"), "transition", "workflow", True),
    "agent_trajectories": Family(("search?", "create", "execute?", "read"), "creating", "multi_step"),
    "error_recovery": Family(("execute!",), "failing", "recover", True),
    "clarification_dialogues": Family((), "any", "clarify"),
    "verification": Family(("execute", "read"), "verifiable", "verify", True),
    "multi_turn_memory": Family(("create", "user", "execute"), "creating", "coreference"),
    "business_data_retrieval": Family(("search",), "any", "analysis"),
    "report_analysis": Family(("read_group",), "groupable", "analysis"),
    "consultant_knowledge": Family((), "any", "explain"),
    "agent_protocol": Family(("execute",), "mutating", "tool_selection"),
    "refusal_and_confirmation": Family(("read",), "destructive", "refuse_or_warn", True),
    "record_creation": Family(("preview",), "creating", "record_creation"),
    "record_update": Family(("update",), "creating", "record_update"),
}

#: how a read ends that should be the last one, each as often as it stands here
ENDINGS = ("truncated", "truncated", "empty", "sufficient")
#: what a request may leave open
GAPS = {
    "which_record": "It does not say which one of several.", "amount": "It gives no figure where one is needed.", "date": "It speaks of a day without naming it.", "party": "It does not say for whom.",
    "scope": "It does not say whether all or some are meant.", "reason": "It gives no reason where one has to be entered.", "target": "It does not say what it should become.",
}

Say = Callable[[str], Column]


def templates(stage: str) -> Column:
    """Stand-in for a text model: requests and answers from fixed forms.  Another function of the
    stage ("request", "follow_up", "answer") that gives a Column over the context may replace it."""
    if stage == "request":
        return F.when(F.col("gap").isNotNull(), F.concat(F.lit("Please "), F.col("method.intent"), F.lit(", you know the one I mean."))).otherwise(_asked())
    if stage == "follow_up":
        return F.concat(F.lit("Now "), F.col("method.intent"), F.lit(" on that one."))
    return F.when(F.col("gap").isNotNull(), F.concat(F.lit("Before I do anything with a "), F.col("label"), F.lit(", one question about your message. "), F.col("gap"), F.lit(" Could you tell me that? Nothing has been changed so far, and nothing will be until then."))).otherwise(_told())


def _asked() -> Column:
    return F.concat(F.lit("Could you "), F.col("method.intent"), F.lit(" for "), F.col("doc_ref"), F.lit(" please?"))


def _told() -> Column:
    known = F.when(F.col("failed"), F.concat(F.lit("The call on "), F.col("doc_ref"), F.lit(" was refused, and nothing was changed by it. The message of the system says why; tell me how you would like to go on from here.")))
    return known.otherwise(F.concat(F.lit("Here is where the "), F.col("label"), F.lit(" "), F.col("doc_ref"), F.lit(" stands. Everything above comes straight from the system, and no other record was touched while looking at it.")))


def eligible(methods: Column, which: str) -> Column:
    """The methods that a family may draw."""
    moves = lambda m: m["to_state"].isNotNull() & ~F.coalesce(m["returns_action"], F.lit(False))
    if which == "mutating":
        fit = F.filter(methods, moves)
        return F.when(F.size(fit) > 0, fit).otherwise(methods)
    tests = {
        "transition": lambda m: m["from_state"].isNotNull() & moves(m),
        "verifiable": moves,
        "failing": lambda m: F.size(F.coalesce(m["failures"], F.array().cast("array<struct<exc:string,message:string>>"))) > 0,
        "destructive": lambda m: is_destructive(m["name"], m["to_state"]),
    }
    return F.filter(methods, tests[which]) if which in tests else methods


def group_columns(fields: Column) -> Column:
    return F.filter(fields, lambda f: f.endswith("_id") | f.isin(*GROUPABLE))


def pool(specs: DataFrame, personas: DataFrame, situations: DataFrame, family: Family) -> DataFrame:
    """The family's models, each as often as its weight, numbered by slot; with the personas of
    their roles and the situations of the model, else of its domain.  All of catalog size."""
    fit = specs.withColumn("eligible", eligible(F.col("methods"), family.methods)).where(F.size("eligible") > 0)
    if family.core:
        fit = fit.where("tier = 'A'")
    if family.methods == "creating":
        fit = fit.where(F.size(F.map_keys("create_fields")) > 0)
    if family.methods == "groupable":
        fit = fit.where(F.size(group_columns(F.col("search_fields"))) > 0)
    roles = specs.select("model", F.explode("personas").alias("role")).join(personas, "role")
    own = roles.groupBy("model").agg(F.array_sort(F.collect_set("name")).alias("own_personas"))
    exact = situations.where("model is not null").groupBy("model").agg(F.array_sort(F.collect_set("text")).alias("_exact"))
    wide = situations.groupBy("domain").agg(F.array_sort(F.collect_set("text")).alias("_wide"))
    full = fit.join(own, "model", "left").join(exact, "model", "left").join(wide, "domain", "left").withColumn("situations", F.coalesce("_exact", "_wide")).drop("_exact", "_wide")
    copies = full.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("weight"), F.lit(1)))))
    return copies.withColumn("slot", (F.row_number().over(Window.orderBy("model", "_copy")) - 1).cast("bigint")).drop("_copy")


def contexts(indices: DataFrame, catalog: DataFrame, everyone: list[str], name: str, seed: str) -> tuple[DataFrame, Draws]:
    """One context for each index: model, method, ids, persona, situation, references."""
    d = Draws(seed, (F.lit(name), F.col("index")))
    slots = catalog.count()
    if not slots:
        indices, slots = indices.where("false"), 1
    drawn = indices.withColumn("slot", F.pmod(d.bits("model"), F.lit(slots))).join(catalog, "slot")
    names = {"person": F.coalesce(F.when(d.chance("affine", 0.75), d.pick("persona", F.col("own_personas"))), d.choice("anyone", everyone))}
    reference = F.concat(F.coalesce(F.col("doc_prefix"), F.lit("REC")), F.lit(f"/{TODAY[:4]}/"), F.lpad(d.integer("seq", 1, 9999).cast("string"), 5, "0"))
    return drawn.withColumns(names | {"method": d.pick("method", F.col("eligible")), "situation": d.pick("situation", F.col("situations")), "doc_ref": reference, "res_id": d.integer("res_id", 101, 98999)}), d


def ending(d: Draws) -> Column:
    return d.choice("ending", ENDINGS)


def refused(d: Draws) -> Column:
    """Whether an update asks for the state itself, which has to be refused."""
    return F.col("state_field").isNotNull() & d.chance("refused", 0.4)


def withheld(d: Draws) -> Column:
    """The value that a creation still lacks, in half of those with several; else null."""
    return F.when((F.size("create_fields") > 1) & d.chance("withheld", 0.5), F.element_at(F.map_keys("create_fields"), -1))


def shape_of(name: str, d: Draws) -> Column:
    """The stored shape of a family's sample."""
    plain = F.lit(FAMILIES[name].shape)
    if name == "answer_and_stop":
        return F.concat(plain, F.lit(":"), ending(d))
    return F.when(refused(d), "state_write_refusal").otherwise(plain) if name == "record_update" else plain


def _created(d: Draws, most: int | None = None, but: Column | None = None) -> Column:
    entries = F.map_entries("create_fields")
    entries = entries if but is None else F.filter(entries, lambda e: ~F.coalesce(e["key"] == but, F.lit(False)))
    entries = F.slice(entries, 1, most) if most else entries
    parts = F.transform(entries, lambda e: F.concat(json_text(e["key"]), F.lit(": "), value_of(e["value"], d, F.concat(F.lit("create/"), e["key"]))))
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def domain_text(terms: list) -> str:
    import json

    return json.dumps(terms)


def arguments(step: str, d: Draws) -> Column:
    """JSON arguments of a step's call."""
    model, ids = json_text(F.col("model")), F.concat(F.lit("["), F.col("res_id").cast("string"), F.lit("]"))
    if step == "execute":
        return json_object(model=model, method=json_text(F.col("method.name")), res_ids=ids, kwargs=F.coalesce(F.col("method.kwargs"), F.lit("{}")))
    if step == "methods_get":
        return json_object(model=model)
    if step == "create":
        return json_object(model=model, values=_created(d))
    if step == "preview":
        return json_object(model=model, values=_created(d, but=withheld(d)))
    if step == "update":
        return F.when(refused(d), arguments("read", d)).otherwise(json_object(model=model, res_ids=ids, values=_created(d, 2, F.col("state_field"))))
    fields = F.col("search_fields")
    if step == "read":
        wanted = F.array_distinct(F.array_compact(F.concat(F.slice(fields, 1, 5), F.array("state_field"))))
        return json_object(model=model, domain=F.concat(F.lit('[["id", "=", '), F.col("res_id").cast("string"), F.lit("]]")), fields=json_text(wanted), limit=F.lit("1"))
    if step == "pinpoint":
        key = F.when(F.array_contains(fields, "name"), "name").otherwise(F.get(fields, F.lit(0)))
        return json_object(model=model, domain=F.concat(F.lit("[["), json_text(key), F.lit(', "=", '), json_text(F.col("doc_ref")), F.lit("]]")), fields=json_text(F.slice(fields, 1, 6)), limit=F.lit("1"))
    recent = F.concat(F.lit('[["date", ">=", '), json_text(d.date("since", -90, -7)), F.lit("]]"))
    opened = F.concat(F.lit('[["state", "=", '), json_text(F.coalesce(F.col("method.from_state"), F.lit("draft"))), F.lit("]]"))
    whole = F.lit(domain_text(drop_pinned([], "")))
    if step in ("search", "answer"):
        terms = F.when(F.array_contains(fields, "state"), opened).when(F.array_contains(fields, "date"), recent).otherwise(whole)
        return json_object(model=model, domain=terms, fields=json_text(F.slice(fields, 1, 6)), limit=d.choice("limit", ("10", "20", "25", "50")))
    sums = F.transform(F.slice(F.filter(fields, lambda f: f.isin(*MEASURABLE)), 1, 2), lambda f: F.concat(f, F.lit(":sum")))
    terms = F.when(F.array_contains(fields, "date"), recent).otherwise(whole)
    return json_object(model=model, domain=terms, groupby=json_text(F.array(_group(d))), aggregates=json_text(F.when(F.size(sums) > 0, sums).otherwise(F.array(F.lit("__count")))))


def _group(d: Draws) -> Column:
    return d.pick("group", group_columns(F.col("search_fields")))


def failure(d: Draws) -> Column:
    """JSON of an error: the method's own ones before general ones; one in four draws may also
    take a correction by the tool layer."""
    struct = "array<struct<exc:string,message:string>>"
    listed = lambda rows: F.array(*[F.struct(F.lit(a).alias("exc"), F.lit(b).alias("message")) for a, b in rows]).cast(struct)
    own = F.coalesce(F.col("method.failures"), F.array().cast(struct))
    base = F.when(F.size(own) > 0, own).otherwise(listed(ERRORS))
    drawn = d.pick("error", F.when(d.chance("corrected", 0.25), F.concat(base, listed(CORRECTIONS))).otherwise(base))
    text = drawn["message"]
    for slot, value in {"model": "model", "label": "label", "ref": "doc_ref", "method": "method.name"}.items():
        text = F.replace(text, F.lit("{" + slot + "}"), F.col(value))
    return json_object(error=json_object(name=json_text(drawn["exc"]), message=json_text(text)))


def _record(d: Draws, row: Column, fields: Column, state: Column) -> Column:
    """A record; row 0 is the one that the transcript is about, the same at every read."""
    first = row == 0
    ref = F.when(first, F.col("doc_ref")).otherwise(F.concat(F.lit("REC-"), d.integer(F.concat(F.lit("r"), row.cast("string")), 1, 9999).cast("string")))
    own = F.when(first, F.col("res_id")).otherwise(d.integer(F.concat(F.lit("i"), row.cast("string")), 101, 98999))
    named = F.filter(fields, lambda f: f != "id")
    parts = F.transform(named, lambda f: F.concat(json_text(f), F.lit(": "), field_value(f, d, F.concat_ws("/", f, row.cast("string")), ref, state)))
    return F.concat(F.lit('{"id": '), F.array_join(F.concat(F.array(own.cast("string")), parts), ", "), F.lit("}"))


def result(step: str, d: Draws, moved: bool) -> Column:
    """JSON of what a successful step returns; moved: the method has run before."""
    ident = F.col("res_id").cast("string")
    before = F.coalesce(F.col("method.from_state"), F.lit("draft"))
    state = F.coalesce(F.col("method.to_state"), before) if moved else before
    fields = F.col("search_fields")
    if step == "execute":
        wizard = json_object(type=F.lit('"action"'), res_model=json_text(F.concat(F.col("model"), F.lit(".wizard"))), target=F.lit('"new"'))
        plain = json_object(result=F.lit("true"), id=ident)
        return F.when(F.col("method.returns_action"), wizard).when(F.col("method.to_state").isNotNull(), json_object(result=F.lit("true"), id=ident, state=json_text(F.col("method.to_state")))).otherwise(plain)
    if step == "methods_get":
        return method_listing(F.col("model"), F.col("methods"))
    if step == "create":
        return json_object(id=ident, display_name=json_text(F.col("doc_ref")))
    if step == "preview":
        lacks = withheld(d)
        rest = F.coalesce(F.concat(F.lit("Still needed: "), lacks, F.lit(".")), F.lit("Nothing else is needed; the rest is filled in by default."))
        note = F.concat(F.lit("Nothing was created: this is a preview of one record of "), F.col("model"), F.lit(". "), rest)
        missing = json_text(F.array_compact(F.array(lacks)))
        return json_object(created=F.lit("[]"), confirmed=F.lit("false"), preview=F.concat(F.lit("["), _created(d, but=lacks), F.lit("]")), missing_required=missing, note=json_text(note))
    if step == "update":
        return F.when(refused(d), result("read", d, moved)).otherwise(F.lit("true"))
    if step in ("read", "pinpoint"):
        wanted = F.array_distinct(F.array_compact(F.concat(F.slice(fields, 1, 5), F.array("state_field")))) if step == "read" else F.slice(fields, 1, 6)
        return F.concat(F.lit("["), _record(d, F.lit(0), wanted, state), F.lit("]"))
    if step in ("search", "answer"):
        rows = F.sequence(F.lit(0), d.integer("rows", 1, 6).cast("int"))
        listed = F.transform(rows, lambda i: _record(d, i, F.slice(fields, 1, 6), state))
        if step == "search":
            return json_list(listed)
        shown = F.slice(listed, 1, 5)
        total = F.size(shown) + d.integer("beyond", 20, 400)
        note = F.concat(F.lit("\nShowing "), F.size(shown).cast("string"), F.lit(" of "), total.cast("string"), F.lit(" matches; a narrower domain or an offset shows others."))
        return F.when(ending(d) == "empty", "[]").when(ending(d) == "truncated", F.concat(json_list(shown), note)).otherwise(json_list(listed))
    sums = F.slice(F.filter(fields, lambda f: f.isin(*MEASURABLE)), 1, 2)
    states = F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.transform("methods", lambda m: F.array(m["from_state"], m["to_state"]))))))
    labels = F.when(_group(d) == "state", F.when(F.size(states) > 0, states).otherwise(F.array(F.lit("draft"), F.lit("posted")))).otherwise(F.transform(F.sequence(F.lit(0), d.integer("buckets", 2, 4).cast("int")), lambda i: F.concat(_group(d), F.lit(" "), F.char(i + 65))))

    def bucket(b: Column) -> Column:
        totals = F.transform(sums, lambda f: F.concat(json_text(F.concat(f, F.lit(":sum"))), F.lit(": "), d.real(F.concat_ws("/", b, f), 400, 260000).cast("string")))
        head = F.array(F.concat(json_text(_group(d)), F.lit(": "), json_text(b)), F.concat(F.lit('"__count": '), d.integer(F.concat(F.lit("n/"), b), 1, 90).cast("string")))
        return F.concat(F.lit("{"), F.array_join(F.concat(head, totals), ", "), F.lit("}"))

    return json_list(F.transform(labels, bucket))


TOOLS = {"execute": "execute_method", "read": "search_read", "search": "search_read", "answer": "search_read", "pinpoint": "search_read", "preview": "create"}


def tool_of(step: str, d: Draws, prefix: str) -> Column:
    if step == "update":
        return F.when(refused(d), prefix + "search_read").otherwise(prefix + "write")
    return F.lit(prefix + TOOLS.get(step, step))


def generate(indices: DataFrame, specs: DataFrame, personas: DataFrame, situations: DataFrame, name: str, *, seed: str = "20260317", say: Say = templates, prefix: str = "tool_", failure_rate: float = 0.22) -> DataFrame:
    """Samples (messages, _meta) of a family for a table of indices (`index`, a bigint).

    A transcript stops at its first failing call.  An index whose family has no model left in the
    catalog gives no row; the same seed, family and index give the same sample.  What reaches the
    driver is the names of the personas, a curated relation."""
    family = FAMILIES[name]
    everyone = [r["name"] for r in personas.select("name").distinct().orderBy("name").collect()] or ["someone"]
    rows, d = contexts(indices, pool(specs, personas, situations, family), everyone, name, seed)
    rows = rows.withColumn("gap", d.choice("gap", tuple(GAPS.values())) if name == "clarification_dialogues" else F.lit(None).cast("string"))
    fails = d.chance("fails", failure_rate)
    failed, parts, nth, moved = F.lit(False), [], 0, False

    def message(role: str, content: Column, calls: Column | None = None, call_id: Column | None = None) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"), (F.lit(None) if calls is None else calls).alias("tool_calls"), (F.lit(None) if call_id is None else call_id).alias("tool_call_id")).cast(MESSAGE)

    parts.append(F.array(message("user", say("request"))))
    for marked in family.steps:
        step, mark = marked.rstrip("?!"), marked[-1]
        if step == "user":
            parts.append(F.array(message("user", say("follow_up"))))
            continue
        here = F.lit(mark == "!") if step != "execute" or mark != "?" else fails
        call_id = F.concat(F.lit("c"), F.col("index").cast("string"), F.lit(f"_{nth}"))
        tool = tool_of(step, d, prefix)
        call = F.struct(call_id.alias("id"), F.lit("function").alias("type"), F.struct(tool.alias("name"), arguments(step, d).alias("arguments")).alias("function"))
        asked = message("assistant", F.concat(F.lit("Calling "), tool, F.lit(" on "), F.col("model"), F.lit(".")), F.array(call))
        answered = message("tool", F.when(here, failure(d)).otherwise(result(step, d, moved)), None, call_id)
        run = ~failed & (d.chance("optional", 0.7) if step == "search" and mark == "?" else F.lit(True))
        parts.append(F.when(run, F.array(asked, answered)).otherwise(F.array().cast("array<" + MESSAGE.simpleString() + ">")))
        failed, nth, moved = failed | here, nth + 1, moved or step == "execute"
    rows = rows.withColumn("failed", failed)
    parts.append(F.array(message("assistant", say("answer"))))
    key = sample_key(F.lit(VERSION), F.lit(name), F.col("index").cast("string"), F.col("model"), F.col("method.name"), shape_of(name, d))
    meta = F.struct(key.alias("key"), F.lit(name).alias("family"), shape_of(name, d).alias("shape"), F.col("model").alias("model"), F.col("method.name").alias("method"), F.col("domain").alias("domain"), F.col("person").alias("persona"), F.col("index").alias("index"), F.lit(VERSION).alias("generator_version"), F.lit("templates").alias("teacher"))
    return rows.select(F.concat(*parts).alias("messages"), meta.alias("_meta"))
