"""Generated samples and facts: shape, repeatability, agreement with the gate."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import values
from tessera.operators import call_checks, facts, gate, generation
from tessera.sources import catalogs
from tessera.sources.jsonl import SAMPLE


def method(name, before=None, after=None, failures=(), wizard=False):
    return {"name": name, "intent": name.replace("_", " "), "from_state": before, "to_state": after, "kwargs": "{}", "failures": [{"exc": "UserError", "message": m} for m in failures], "returns_action": wizard}


SPECS = [
    {"model": "shop.order", "label": "order", "domain": "sales", "personas": ["clerk"], "tier": "A", "weight": 3, "doc_prefix": "ORD", "state_field": "state",
     "methods": [method("action_confirm", "draft", "sale", ["{ref} has no lines."]), method("action_cancel", "sale", "cancel"), method("action_send", wizard=True)],
     "create_fields": {"partner_id": "partner_ref", "lines": "sale_lines", "date": "date_future"}, "search_fields": ["name", "partner_id", "state", "amount_total", "date"]},
    {"model": "shop.item", "label": "item", "domain": "stock", "personas": ["nobody"], "tier": "B", "weight": 1, "doc_prefix": None, "state_field": None,
     "methods": [method("action_count")], "create_fields": {}, "search_fields": ["display_name"]},
]


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("c")
    (path / "specs.jsonl").write_text("\n".join(json.dumps(s) for s in SPECS))
    specs = catalogs.read_catalog(spark, str(path / "specs.jsonl"), catalogs.SPEC)
    personas = spark.createDataFrame([("clerk", "Ann", "brief"), ("boss", "Bo", "long")], catalogs.PERSONA)
    situations = spark.createDataFrame([(None, "sales", "late order"), ("shop.item", "stock", "lost item")], catalogs.SITUATION)
    return specs, personas, situations


def indices(spark, n, parts=4):
    return spark.range(0, n, 1, parts).select(F.col("id").alias("index"))


@pytest.mark.parametrize("name", sorted(generation.FAMILIES))
def test_family(spark, catalog, name):
    out = generation.generate(indices(spark, 40), *catalog, name).cache()
    assert out.schema.simpleString() == SAMPLE.simpleString()
    rows = [r.asDict(True) for r in out.collect()]
    assert len(rows) == 40 and len({r["_meta"]["key"] for r in rows}) == 40
    for r in rows:
        for m in r["messages"]:
            assert m["content"] is not None
            if m["role"] == "tool":
                json.loads(m["content"].split("\nShowing ")[0])
            for c in m["tool_calls"] or []:
                assert json.loads(c["function"]["arguments"])["model"] == r["_meta"]["model"]
    checked = out.select(F.col("_meta.key").alias("id"), "messages", gate.malformed(F.col("messages")).alias("bad"), call_checks.transcript_reasons(F.col("messages")).alias("why"))
    assert checked.where("bad or size(why) > 0").count() == 0
    known = catalog[0].select("model", F.explode("methods.name").alias("method"))
    assert call_checks.call_reasons(checked, "id", known).count() == 0
    if generation.FAMILIES[name].core:
        assert {r["_meta"]["model"] for r in rows} == {"shop.order"}


def test_same_rows_in_any_partitioning(spark, catalog):
    a, b = (sorted(map(str, generation.generate(indices(spark, 30, p), *catalog, "agent_trajectories").collect())) for p in (1, 7))
    assert a == b


def test_stops_at_first_failure(spark, catalog):
    rows = generation.generate(indices(spark, 200), *catalog, "agent_trajectories", failure_rate=0.5).collect()
    broken = [r for r in rows if any(m["role"] == "tool" and '"error"' in m["content"] for m in r["messages"])]
    assert 50 < len(broken) < 150
    for r in broken:
        tools = [m for m in r["messages"] if m["role"] == "tool"]
        assert '"error"' in tools[-1]["content"] and not any('"error"' in m["content"] for m in tools[:-1])


def test_one_record_reads_alike(spark, catalog):
    for r in generation.generate(indices(spark, 30), *catalog, "workflow_execution").collect():
        tools = [json.loads(m["content"]) for m in r["messages"] if m["role"] == "tool"]
        assert tools[0][0]["id"] == tools[1]["id"]


def test_empty_catalog(spark, catalog):
    assert generation.generate(indices(spark, 5), catalog[0].where("false"), *catalog[1:], "tool_calling").count() == 0


def test_value_kinds(spark):
    d = values.Draws("s", (F.col("index"),))
    kinds = sorted(values.generators(d, F.lit("x")))
    df = indices(spark, 20).withColumn("kind", F.explode(F.array(*map(F.lit, kinds))))
    rows = df.select("kind", values.value_of(F.col("kind"), d, F.lit("x")).alias("v")).collect()
    assert len(rows) == 20 * len(kinds)
    for r in rows:
        json.loads(r["v"])
    with pytest.raises(Exception, match="unknown value kind"):
        df.select(values.value_of(F.lit("zz"), d, F.lit("x"))).collect()


def test_facts(spark, catalog):
    fields = spark.createDataFrame([("shop.order", "partner_id", "Many2one", "shop.item", True), ("shop.order", "note", "Char", None, False)], "model_name string, field_name string, field_type string, comodel_name string, required boolean")
    edges = spark.createDataFrame([("shop.order", "shop.item", "Many2one", "item_id"), ("shop.item", "far.away", "Many2one", "x_id")], "source_model string, target_model string, rel_type string, field_name string")
    found = facts.derive(catalog[0], fields, edges)
    got = sorted((r["kind"], r["model"], r["anchor"]) for r in found.collect())
    assert got == [
        ("field_reference", "shop.order", "fields"), ("method_inventory", "shop.item", "inventory"), ("method_inventory", "shop.order", "inventory"),
        ("method_selection", "shop.item", "action_count"), ("method_selection", "shop.order", "action_cancel"), ("method_selection", "shop.order", "action_confirm"), ("method_selection", "shop.order", "action_send"),
        ("relation", "shop.order", "item_id"), ("state_machine", "shop.order", "lifecycle"),
    ]
    assert found.where("grounding is null").count() == 0
    text = found.where("kind = 'state_machine'").first()["grounding"]
    assert text == "Model: shop.order  (a order)\nTransitions:\n  draft --action_confirm()--> sale\n  sale --action_cancel()--> cancel"
    planned = facts.plan(found, "s").collect()
    assert sorted((r["model"], r["draw"]) for r in planned) == [("shop.item", i) for i in range(6)] + [("shop.order", i) for i in range(34)]
    assert not any("{" in r["question"] for r in planned) and all(r["repetition"] == r["draw"] // (7 if r["model"] == "shop.order" else 2) for r in planned)
    told = facts.as_samples(facts.plan(found, "s"))
    assert told.schema.simpleString() == SAMPLE.simpleString()
    assert told.select("_meta.key").distinct().count() == 40 and told.where(gate.malformed(F.col("messages"))).count() == 0


def test_endings_previews_and_refusals(spark, catalog):
    by = lambda name: [r.asDict(True) for r in generation.generate(indices(spark, 200), *catalog, name).collect()]
    shapes = {}
    for r in by("answer_and_stop"):
        shape = r["_meta"]["shape"].split(":")[1]
        content = next(m["content"] for m in r["messages"] if m["role"] == "tool")
        assert (content == "[]") == (shape == "empty") and ("\nShowing " in content) == (shape == "truncated")
        shapes[shape] = shapes.get(shape, 0) + 1
    assert shapes["truncated"] > 70 and min(shapes.values()) > 25
    lacking = 0
    for r in by("record_creation"):
        preview = json.loads(next(m["content"] for m in r["messages"] if m["role"] == "tool"))
        values = json.loads(next(m for m in r["messages"] if m["tool_calls"])["tool_calls"][0]["function"]["arguments"])["values"]
        assert preview["created"] == [] and preview["preview"] == [values] and not set(preview["missing_required"]) & set(values)
        lacking += bool(preview["missing_required"])
    assert 60 < lacking < 140
    refusals = 0
    for r in by("record_update"):
        name = next(m for m in r["messages"] if m["tool_calls"])["tool_calls"][0]["function"]["name"]
        assert (name == "tool_search_read") == (r["_meta"]["shape"] == "state_write_refusal")
        refusals += name == "tool_search_read"
    assert 50 < refusals < 110
    assert all(any(g in r["messages"][-1]["content"] for g in generation.GAPS.values()) for r in by("clarification_dialogues"))
