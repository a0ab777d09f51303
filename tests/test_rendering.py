"""Rendered steps, schemas and queries; cleaned texts."""

from pyspark.sql import functions as F

from tessera.functions import rendering
from tessera.functions import text as tx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_steps(spark):
    steps = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("{}").alias("arguments"), F.lit(p).alias("payload"), F.lit(ok).alias("ok")) for n, p, ok in (("a", "1", True), ("b", "x" * 1500, False))])
    want = "Step 1 [OK]  a({})\n         returned: 1\nStep 2 [RAISED]  b({})\n         returned: " + "x" * 1400 + " …(cut)"
    assert one(spark, rendering.steps_text(steps)) == want


def test_schema(spark):
    fields = F.from_json(F.lit('[{"name":"a","type":"Char","required":true},{"name":"b","type":"Many2one","comodel":"x.y"},{"name":"c","type":"Date","label":"When"}]'), "array<struct<name:string,type:string,comodel:string,required:boolean,label:string>>")
    methods = F.from_json(F.lit('[{"name":"go","intent":"go","from_state":"x","to_state":"y"},{"name":"ask","intent":"ask","returns_action":true}]'), "array<struct<name:string,intent:string,from_state:string,to_state:string,returns_action:boolean>>")
    want = "=== Schema of m ===\nRequired fields:\n  a (Char) [required]: \nRelations:\n  b (Many2one -> x.y): \nOther fields:\n  c (Date): When\nMethods:\n  go() [x -> y]: go\n  ask() [opens a wizard]: ask"
    assert one(spark, rendering.schema_text(F.lit("m"), fields, methods)) == want


def test_queries(spark):
    cases = [
        ('{"domain": [["state", "=", "done"], ["id", ">", 0]], "fields": ["id", "name", "partner_id"]}', "a list of order records with name, vendor; only those where state is done."),
        ('{"domain": [["date", ">=", "2026-01-01"]], "groupby": ["user_id"], "aggregates": ["amount_total:sum"]}', "order records totalled by owner, with total; only those dated 2026-01-01 or later."),
        ('{"groupby": ["state"], "aggregates": ["__count"]}', "a count of order records by state."),
    ]
    for args, want in cases:
        assert one(spark, rendering.query_text(F.lit("order"), F.lit("purchase"), F.lit(args))) == want


def test_texts(spark):
    keep = "Stock is there. " * 12
    got = one(spark, tx.scrub_think(F.lit(f"A <think>No emojis here. {keep}</think> B <think>No emojis.</think> C <think>fine</think>"), "(?i)no emojis"))
    assert got["changed"] and got["text"] == f"A <think>{keep.strip()}</think> B  C <think>fine</think>"
    assert one(spark, tx.scrub_think(F.lit("plain"), "(?i)no emojis")).asDict() == {"text": "plain", "changed": False}
    assert one(spark, tx.drop_chatty_tail(F.lit("Done.\nHope this helps\n\nGood luck with it"), "(?i)hope this|good luck")) == "Done.\nHope this helps"
    assert one(spark, tx.drop_chatty_tail(F.lit("Done.\nHope this helps\nGood luck"), "(?i)hope this|good luck")) == "Done."
    assert one(spark, tx.drop_chatty_tail(F.lit("Good luck"), "(?i)good luck")) == ""
    assert one(spark, tx.split_reasoning(F.lit("<think> a </think> b"))).asDict() == {"reasoning": "a", "answer": "b"}
    assert one(spark, tx.split_reasoning(F.lit("abcdefghi"))).asDict() == {"reasoning": "abc", "answer": "abcdefghi"}
