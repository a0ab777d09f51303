"""The relational catalog of a scanned source tree: five tables, written whole and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relations import is_action, is_public, upsert_last_wins
from .source_tree import edges_of

TABLES = {
    "modules": "technical_name string, name string, category string, description string, depends string",
    "models": "technical_name string, name string, module_name string, is_transient int, inherits string, description string",
    "fields": "model_name string, field_name string, field_type string, comodel_name string, required int, selection string, string string",
    "relationship_edges": "source_model string, target_model string, rel_type string, field_name string, extra_info string",
    "methods": "model_name string, method_name string, docstring string, decorators string, is_action int, is_public int, signature string",
}
#: Chains of models that belong to one process, and what runs in them.
PROCESS_CHAINS = (
    ("crm.lead", "sale.order", "stock.picking", "account.move", "account.payment"),
    ("purchase.order", "stock.picking", "account.move", "account.payment"),
    ("mrp.production", "stock.picking", "account.move"),
    ("helpdesk.ticket", "project.task", "account.move"),
    ("hr.employee", "hr.contract", "hr.payslip", "account.move"),
)
# End of fixed values.


def merged(entities: DataFrame) -> DataFrame:
    """entities (of modules) in which a model's fields and methods of one module stand once, the last
    in order of file and position."""
    rest = entities.where("kind not in ('field', 'method')")
    own = entities.where("kind in ('field', 'method')").withColumn("_at", F.struct("path", "position"))
    return rest.unionByName(upsert_last_wins(own, ["module", "model", "kind", "name"], "_at").drop("_at"))


def build(modules: DataFrame, entities: DataFrame) -> dict[str, DataFrame]:
    """The five tables.  entities: see source_tree, with their module.  A model that several modules
    extend has the last module's row; fields, methods and edges of all of them stay."""
    own = merged(entities)
    as_int = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int")
    text = lambda c: F.when(F.size(c) > 0, F.to_json(c))
    parents = own.where("kind = 'inherits'").groupBy("module", "model").agg(F.array_sort(F.collect_list(F.struct("path", "position", "name"))).alias("p"))
    parents = parents.select("module", "model", F.to_json(F.transform("p", lambda p: p["name"])).alias("inherits"))
    heads = own.where("kind = 'model'").join(parents, ["module", "model"], "left").withColumn("_at", F.struct("module", "path", "position"))
    heads = upsert_last_wins(heads.select("model", "name", "module", "transient", "inherits", "doc", "_at"), ["model"], "_at")
    methods = own.where("kind = 'method'")
    fields = own.where("kind = 'field'")
    return {
        "modules": modules.select(F.col("module").alias("technical_name"), "name", "category", "description", F.to_json("depends").alias("depends")),
        "models": heads.select(F.col("model").alias("technical_name"), "name", F.col("module").alias("module_name"), as_int("transient").alias("is_transient"), F.coalesce("inherits", F.lit("[]")).alias("inherits"), F.col("doc").alias("description")),
        "fields": fields.select(
            F.col("model").alias("model_name"), F.col("name").alias("field_name"), F.col("type").alias("field_type"), F.col("comodel").alias("comodel_name"), as_int("required").alias("required"),
            F.when(F.size("selection") > 0, F.to_json(F.transform("selection", lambda s: F.array(s["value"], s["label"])))).alias("selection"), F.col("label").alias("string"),
        ),
        "relationship_edges": edges_of(own),
        "methods": methods.select(
            F.col("model").alias("model_name"), F.col("name").alias("method_name"), F.col("doc").alias("docstring"), text("decorators").alias("decorators"),
            is_action(F.col("name")).cast("int").alias("is_action"), is_public(F.col("name")).cast("int").alias("is_public"), "signature",
        ),
    }


def write(tables: dict[str, DataFrame], path: str) -> None:
    """A full refresh: each table replaces the one before."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def open_catalog(spark: SparkSession, path: str, views: bool = False) -> dict[str, DataFrame]:
    """The written tables, as views too if asked; a table that is not there is empty."""
    out = {}
    for name, schema in TABLES.items():
        try:
            out[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            out[name] = spark.createDataFrame([], schema)
        if views:
            out[name].createOrReplaceTempView(name)
    return out


def model_fields(fields: DataFrame, model: str | None = None) -> DataFrame:
    """Fields of a model (or of all), decoded: required as boolean, selection as pairs."""
    rows = fields if model is None else fields.where(F.col("model_name") == model)
    return rows.select("model_name", F.col("field_name").alias("name"), "field_type", "comodel_name", (F.coalesce("required", F.lit(0)) == 1).alias("required"), F.from_json("selection", "array<array<string>>").alias("selection"), "string")


def model_methods(methods: DataFrame, model: str | None = None, *, public_only: bool = True, actions_only: bool = False) -> DataFrame:
    """Methods of a model (or of all), decoded, with defaults for what the scan left empty."""
    rows = methods if model is None else methods.where(F.col("model_name") == model)
    rows = rows.where("is_public = 1") if public_only else rows
    rows = rows.where("is_action = 1") if actions_only else rows
    return rows.select(
        "model_name", F.col("method_name").alias("name"), F.coalesce("docstring", F.lit("")).alias("docstring"), F.coalesce(F.from_json("decorators", "array<string>"), F.array().cast("array<string>")).alias("decorators"),
        (F.col("is_action") == 1).alias("is_action"), (F.col("is_public") == 1).alias("is_public"), F.coalesce("signature", F.concat(F.lit("def "), "method_name", F.lit("(self, *args, **kwargs)"))).alias("signature"),
    )


def state_transitions(edges: DataFrame, model: str | None = None) -> DataFrame:
    """States of a model (or of all) with their labels."""
    rows = edges.where("rel_type = 'STATE_TRANSITION' and extra_info is not null")
    rows = rows if model is None else rows.where(F.col("source_model") == model)
    return rows.select("source_model", F.inline(F.array(F.from_json("extra_info", "state string, label string"))))


def models_with_methods(models: DataFrame, methods: DataFrame) -> DataFrame:
    """Models that have a public method."""
    known = methods.where("is_public = 1").select(F.col("model_name").alias("technical_name")).distinct()
    return models.join(known, "technical_name", "left_semi").select("technical_name", F.coalesce("name", "technical_name").alias("name"), F.coalesce("module_name", F.lit("")).alias("module_name"))


def relations_of(edges: DataFrame) -> DataFrame:
    """Edges that are relational fields between two models: a named field, no edge to itself."""
    named = F.coalesce(F.col("field_name"), F.lit("")) != ""
    return edges.where(F.col("rel_type").isin("Many2one", "One2many", "Many2many") & named & (F.col("source_model") != F.col("target_model"))).select("source_model", "target_model", "rel_type", "field_name").distinct()


def process_chains(spark: SparkSession) -> DataFrame:
    """(chain, step, model) of the standard processes."""
    rows = [(c, s, m) for c, chain in enumerate(PROCESS_CHAINS) for s, m in enumerate(chain)]
    return spark.createDataFrame(rows, "chain int, step int, model string")
