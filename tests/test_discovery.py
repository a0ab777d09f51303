"""Discovery of models outside the curated catalog."""

from pyspark.sql import functions as F

from tessera.operators import relations


def test_intents(spark):
    cases = {"action_confirm": "confirm the order", "button_done": "complete the order", "action_mass_cancel": "cancel the order (mass cancel)", "send_all": "send the order (send all)", "do_magic": "deal with the order — specifically, do magic"}
    df = spark.createDataFrame([(k,) for k in cases], "n string").select("n", relations.intent_of(F.col("n"), F.lit("order")).alias("i"))
    assert {r["n"]: r["i"] for r in df.collect()} == cases


def test_discover(spark):
    candidates = spark.createDataFrame([("a", "order", "s"), ("b", "item", "s"), ("c", "note", "s"), ("d", "old", "s")], "model string, label string, domain string")
    fields = spark.createDataFrame([("a", "state"), ("a", "name"), ("c", "x"), ("d", "x"), ("d", "name")], "model_name string, field_name string")
    methods = spark.createDataFrame([("a", "action_confirm"), ("a", "action_confirm"), ("a", "button_cancel"), ("a", "action_view_lines"), ("a", "_action_x"), ("c", "read")], "model_name string, method_name string")
    specs, notes = relations.discover(candidates, fields, methods, spark.createDataFrame([("d",)], "model string"), ["name", "state", "date"])
    rows = specs.collect()
    assert [(r["model"], [m["name"] for m in r["methods"]], r["search_fields"], r["state_field"]) for r in rows] == [("a", ["button_cancel", "action_confirm"], ["name", "state"], "state")]
    assert {(r["model"], r["reason"]) for r in notes.collect()} == {("b", "no fields known"), ("c", "no method left")}
