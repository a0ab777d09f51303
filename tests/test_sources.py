"""Source trees, the catalog built from them, and settings, on small trees."""

import pytest

from tessera.sources import knowledge, settings, source_tree

SALE = '''
class Order(models.Model):
    _name = "x.order"
    _inherit = ["x.mail", "x.log"]
    _description = "Order"
    _rank = fields.Integer("hidden")
    partner = fields.Many2one("x.partner", string="Customer", required=True)
    total = fields.Float("Total", compute="_total", readonly=True)
    city = fields.Char(related="partner.city")
    state = fields.Selection(selection=[("draft", "Draft"), ("done", "Done")])
    note = other.Char("no")

    @api.depends("partner")
    @api.model
    def _total(self):
        "Sum."

    def action_confirm(self):
        """Confirm it."""

class Wizard(models.TransientModel):
    _inherit = "x.wizard"

class Plain:
    x = 1
'''
MORE = '''
class Order(models.Model):
    _inherit = "x.order"
    total = fields.Monetary("Amount")
'''


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for name, manifest, files in (
        ("sale", "{'name': 'Sale', 'summary': 'Sells', 'depends': ['base', 'mail']}", {"models/a.py": SALE, "models/b.py": MORE, "models/bad.py": "class (", "security/ir.model.access.csv": "id,name\na,b\n"}),
        ("broken", "__import__('os').getcwd()", {"c.py": MORE}),
        ("old/sale", "{'name': 'Old'}", {}),
    ):
        for at, text in {"__manifest__.py": manifest, **files}.items():
            file = root / name / at
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(text)
    (root / "loose.py").write_text(MORE)
    return str(root)


def test_entities(spark, tree):
    rows = [r.asDict(recursive=True) for r in source_tree.scan_tree(spark, tree).collect()]
    assert sum(r["kind"] == "error" for r in rows) == 1
    own = {(r["kind"], r["name"]): r for r in rows if r["path"].endswith("a.py")}
    assert {k for k in own if k[0] != "field"} == {("model", "Order"), ("model", "x.wizard"), ("inherits", "x.mail"), ("inherits", "x.log"), ("inherits", "x.wizard"), ("method", "_total"), ("method", "action_confirm")}
    assert {n for k, n in own if k == "field"} == {"partner", "total", "city", "state"}
    partner, total = own["field", "partner"], own["field", "total"]
    assert (partner["type"], partner["comodel"], partner["label"], partner["required"]) == ("Many2one", "x.partner", "Customer", True)
    assert (total["label"], total["compute"], total["readonly"], own["field", "city"]["related"]) == ("Total", "_total", True, "partner.city")
    assert [s["value"] for s in own["field", "state"]["selection"]] == ["draft", "done"]
    assert own["method", "_total"]["decorators"] == ["api.depends", "api.model"] and own["method", "action_confirm"]["signature"] == "def action_confirm(...)"
    assert own["model", "x.wizard"]["transient"] and not own["model", "Order"]["transient"]


def test_modules_and_catalog(spark, tree, tmp_path):
    modules = source_tree.scan_modules(spark, tree)
    got = {r["module"]: (r["name"], r["category"], r["description"], r["depends"]) for r in modules.collect()}
    assert got == {"sale": ("Sale", "Uncategorized", "Sells", ["base", "mail"]), "broken": ("broken", "Uncategorized", "", [])}
    entities = source_tree.in_modules(source_tree.scan_tree(spark, tree), modules)
    assert {r["module"] for r in entities.select("module").distinct().collect()} == {"sale", "broken"}
    knowledge.write(knowledge.build(modules, entities), str(tmp_path / "kg"))
    kg = knowledge.open_catalog(spark, str(tmp_path / "kg"))
    fields = knowledge.model_fields(kg["fields"], "x.order").collect()
    # the later file's total within a module, and one of each module
    assert sorted((r["name"], r["field_type"]) for r in fields) == [("city", "Char"), ("partner", "Many2one"), ("state", "Selection"), ("total", "Monetary"), ("total", "Monetary")]
    assert [r["name"] for r in knowledge.model_methods(kg["methods"], "x.order").collect()] == ["action_confirm"]
    assert {r["name"]: r["docstring"] for r in knowledge.model_methods(kg["methods"], public_only=False).collect()} == {"_total": "Sum.", "action_confirm": "Confirm it."}
    assert sorted(r["state"] for r in knowledge.state_transitions(kg["relationship_edges"], "x.order").collect()) == ["done", "draft"]
    assert [r["technical_name"] for r in knowledge.models_with_methods(kg["models"], kg["methods"]).collect()] == ["x.order"]
    assert {(r["target_model"], r["rel_type"]) for r in knowledge.relations_of(kg["relationship_edges"]).collect()} == {("x.partner", "Many2one")}
    assert source_tree.read_access(spark, tree).collect()[0].asDict() == {"id": "a", "name": "b"}
    empty = knowledge.open_catalog(spark, str(tmp_path / "none"), views=True)
    assert all(t.count() == 0 for t in empty.values()) and spark.sql("select * from methods").count() == 0


def test_settings(tmp_path):
    (tmp_path / "c.json").write_text('{"seed": 3}')
    assert settings.read_config(tmp_path / "c.json", {"seed": 1, "size": 2}) == {"seed": 3, "size": 2}
    (tmp_path / ".env").write_text("# no\nA=1\n B = 'two' \nbad\n=x\nC=\"3\"\n")
    own = {"A": "kept"}
    assert settings.load_env(tmp_path / ".env", own) == {"B": "two", "C": "3"} and own["A"] == "kept"
    assert settings.load_env(tmp_path / "none", own) == {}
    names = [t["function"]["name"] for t in settings.tool_schemas("acme_", True)]
    assert names[:6] == [t["function"]["name"] for t in settings.tool_schemas("acme_")] and len(names) == 8
