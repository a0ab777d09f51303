"""The relational catalog: upserts, edges, verification joins, ranked methods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Method names that are actions, operations by rank, names that open views.
ACTION_PREFIXES = ("action_", "button_", "do_", "write_", "post_", "validate_", "confirm_", "cancel_", "reset_")
CORE_VERBS = (
    "confirm", "validate", "approve", "post", "done", "cancel", "submit", "refuse", "reject", "start", "close", "pay", "send", "assign", "plan",
    "apply", "reset", "draft", "archive", "publish", "generate", "compute", "split", "merge", "duplicate", "replan", "unreserve", "scrap",
    "pass", "fail", "register", "reconcile", "invoice", "receive",
)
UI_ONLY = (
    r"(?i)^action_(?:view|open|see|show|print|preview|redirect|goto|get|toggle)_|^action_(?:view|open)$|^action_l10n_|^button_l10n_|^action_.*_l10n_"
    r"|_wizard$|^action_.*dashboard|graph|kanban|_report$|^action_help"
)
LOCALISATION = (
    r"(?i)_(?:swiss|belgian|french|german|italian|spanish|dutch|indian|brazil|mexic|austral|kenya|malays|philipp|romania|turkish|vietnam|saudi|uae"
    r"|peppol|nemhandel|fatturapa|facturae|cfdi|ubl|oioubl|edi|einvoice|gstin|gstr|ewaybill|sepa|sdd)\w*"
)
DESTRUCTIVE = ("cancel", "draft", "unreserve", "scrap", "refuse", "reject", "reset", "unlink", "delete", "reverse")
# End of fixed values.


def upsert_last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key; combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return last.select(*keys, "_row.*").select(*rows.columns)


def append_if_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose keys are not in the target, one a key."""
    return new.join(target.select(*keys), keys, "left_anti").dropDuplicates(keys)


def is_public(name: Column) -> Column:
    return ~name.startswith("_")


def is_action(name: Column) -> Column:
    return name.rlike("^(?:" + "|".join(ACTION_PREFIXES) + ")")


def is_destructive(name: Column, to_state: Column) -> Column:
    return F.coalesce(to_state.isin("cancel", "draft"), F.lit(False)) | name.rlike("|".join(DESTRUCTIVE))


def method_score(name: Column) -> Column:
    """Central operations first, long names later, those of one country last."""
    words = F.split(F.regexp_replace(name, "^(?:action_|button_)", ""), "_")
    rank = F.lit(0)
    for i, verb in reversed(list(enumerate(CORE_VERBS))):
        rank = F.when(F.array_contains(words, verb), 100 - i).otherwise(rank)
    local = F.when(name.rlike(LOCALISATION), 200).otherwise(0)
    return rank - local - 6 * F.greatest(F.size(words) - 2, F.lit(0)) + F.when(name.startswith("button_"), 10).otherwise(0)


def top_methods(methods: DataFrame, model: str, name: str, k: int = 10) -> DataFrame:
    scored = methods.where(~F.col(name).rlike(UI_ONLY)).withColumn("score", method_score(F.col(name))).where("score > -100")
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(model).orderBy(F.desc("score"), name))).where(F.col("rank") <= k)


def verify_specs(specs: DataFrame, fields: DataFrame, methods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(confirmed specifications, warnings) of a curated catalog against what a scan found.

    specs: model, methods (array of struct with name), create_fields (map), search_fields (array),
    state_field; fields: model_name, field_name; methods: model_name, method_name.  A model needs a
    known field and a method that is known and public; its unknown methods, searched and created
    fields and state field go, in that order of what is left.  warnings: (model, kind, names)."""
    names = fields.groupBy(F.col("model_name").alias("model")).agg(F.collect_set("field_name").alias("_fields"))
    public = methods.where(is_public(F.col("method_name"))).groupBy(F.col("model_name").alias("model")).agg(F.collect_set("method_name").alias("_methods"))
    none = F.array().cast("array<string>")
    full = specs.join(names, "model", "left").join(public, "model", "left").withColumns({"_fields": F.coalesce("_fields", none), "_methods": F.coalesce("_methods", none)})
    known_method = lambda m: F.array_contains("_methods", m["name"])
    known_field = lambda f: F.array_contains("_fields", f)
    full = full.withColumns(
        {
            "_kept": F.filter("methods", known_method),
            "_lost": F.array_sort(F.transform(F.filter("methods", lambda m: ~known_method(m)), lambda m: m["name"])),
            "_search": F.filter("search_fields", known_field),
            "_unsearched": F.filter("search_fields", lambda f: ~known_field(f)),
            "_uncreated": F.filter(F.map_keys("create_fields"), lambda f: ~known_field(f)),
        }
    )
    present, alive = F.size("_fields") > 0, F.size("_kept") > 0
    good = full.where(present & alive).withColumns(
        {
            "methods": F.col("_kept"),
            "search_fields": F.when(F.size("_search") > 0, F.col("_search")).otherwise(F.array(F.lit("id"), F.lit("display_name"))),
            "create_fields": F.map_filter("create_fields", lambda k, _: known_field(k)),
            "state_field": F.when(known_field(F.col("state_field")), F.col("state_field")),
        }
    )
    note = lambda when, kind, of: F.when(when, F.struct(F.lit(kind).alias("kind"), of.alias("names")))
    notes = F.array_compact(
        F.array(
            note(~present, "model not present", none),
            note(present & (F.size("_lost") > 0), "methods", F.col("_lost")),
            note(present & ~alive, "no method left", none),
            note(present & alive & (F.size("_unsearched") > 0), "search fields", F.col("_unsearched")),
            note(present & alive & (F.size("_uncreated") > 0), "create fields", F.col("_uncreated")),
        )
    )
    return good.select(*specs.columns), full.select("model", F.inline(notes))


def verify(catalog: DataFrame, known: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(confirmed entries, warnings): semi and anti join of the catalog with what a scan found."""
    seen = known.select(*keys).distinct()
    return catalog.join(seen, keys, "left_semi"), catalog.join(seen, keys, "left_anti")


def neighbours(edges: DataFrame, model: str) -> DataFrame:
    """Edges at the model, either way, and the model at their other end."""
    here = edges.where((F.col("source_model") == model) | (F.col("target_model") == model))
    return here.withColumn("other", F.when(F.col("source_model") == model, F.col("target_model")).otherwise(F.col("source_model")))


def within(edges: DataFrame, start: str, depth: int) -> DataFrame:
    """Models within `depth` steps of start, with the least number of steps."""
    both = edges.select(F.col("source_model").alias("a"), F.col("target_model").alias("b")).union(edges.select("target_model", "source_model")).distinct()
    reached = both.sparkSession.range(1).select(F.lit(start).alias("model"), F.lit(0).alias("steps"))
    for step in range(1, depth + 1):
        more = reached.join(both, F.col("model") == F.col("a")).select(F.col("b").alias("model"), F.lit(step).alias("steps"))
        reached = reached.union(more).groupBy("model").agg(F.min("steps").alias("steps"))
    return reached


def ranked_relations(edges: DataFrame, surface: DataFrame, preferred: list[str], k: int = 6) -> DataFrame:
    """The first k edges of each source: targets on the surface, preferred fields, short names."""
    own = edges.join(surface.select(F.col("model").alias("source_model")), "source_model", "left_semi").where("source_model <> target_model")
    known = surface.select(F.col("model").alias("target_model"), F.lit(True).alias("on_surface"))
    flagged = own.join(known, "target_model", "left").withColumn("on_surface", F.coalesce("on_surface", F.lit(False)))
    order = Window.partitionBy("source_model").orderBy(~F.col("on_surface"), ~F.col("field_name").isin(preferred), F.length("field_name"), "field_name")
    return flagged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fallback_join(rows: DataFrame, exact: DataFrame, by: str, general: DataFrame, wider: str, value: str) -> DataFrame:
    """rows with `value` from the exact match, else from the wider one, else null; of several values
    of a key the least counts, so that rows stay as many as they are."""
    one = lambda rows, key: rows.groupBy(key).agg(F.min(value).alias(f"_{key}_value"))
    a = one(exact, by).withColumnRenamed(f"_{by}_value", "_exact")
    b = one(general, wider).withColumnRenamed(f"_{wider}_value", "_wide")
    return rows.join(a, by, "left").join(b, wider, "left").withColumn(value, F.coalesce("_exact", "_wide")).drop("_exact", "_wide")


# Verbs with phrases of their own, and the phrase of other names.
PHRASES = {
    "confirm": "confirm the {}", "cancel": "cancel the {}", "validate": "validate the {}", "approve": "approve the {}", "refuse": "refuse the {}",
    "done": "complete the {}", "post": "post the {}", "draft": "put the {} back to draft", "start": "start the {}", "assign": "assign the {}",
    "archive": "archive the {}", "submit": "submit the {}", "pay": "pay the {}", "send": "send the {}", "reset": "reset the {}", "apply": "apply the {}",
    "plan": "schedule the {}", "close": "close the {}",
}
OTHER_PHRASE = "deal with the {} — specifically, "
# End of fixed values.


def intent_of(method: Column, label: Column) -> Column:
    """What a method does, from its name: a verb's own phrase, the same with the whole name where
    the verb only begins or ends it, else the name itself."""
    words = F.trim(F.replace(F.regexp_replace(method, "^(?:action_|button_)", ""), F.lit("_"), F.lit(" ")))
    phrase = lambda p: F.replace(F.lit(p), F.lit("{}"), label)
    exact, edge = None, None
    for verb, p in PHRASES.items():
        at_edge = words.startswith(verb + " ") | words.endswith(" " + verb)
        longer = F.concat(phrase(p), F.lit(" ("), words, F.lit(")"))
        exact = (F.when if exact is None else exact.when)(words == verb, phrase(p))
        edge = (F.when if edge is None else edge.when)(at_edge, longer)
    return F.coalesce(exact, edge, F.concat(phrase(OTHER_PHRASE), words))


def discover(candidates: DataFrame, fields: DataFrame, methods: DataFrame, curated: DataFrame, preferred: list[str], min_methods: int = 1, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """(specifications, notes) for candidates (model, label, domain) outside the curated ones.

    fields: model_name, field_name; methods: model_name, method_name.  A candidate without fields
    or with fewer than min_methods ranked methods is noted with its reason instead."""
    wide = candidates.join(curated.select("model"), "model", "left_anti")
    owned = fields.groupBy(F.col("model_name").alias("model")).agg(F.collect_set("field_name").alias("_fields"))
    usable = methods.where(is_public(F.col("method_name")) & is_action(F.col("method_name"))).select(F.col("model_name").alias("model"), "method_name").distinct()
    ranked = top_methods(usable, "model", "method_name", k).join(wide.select("model", "label"), "model")
    entry = F.struct("rank", F.col("method_name").alias("name"), intent_of(F.col("method_name"), F.col("label")).alias("intent"))
    listed = ranked.groupBy("model").agg(F.array_sort(F.collect_list(entry)).alias("_ranked"))
    full = wide.join(owned, "model", "left").join(listed, "model", "left")
    searched = F.slice(F.filter(F.array(*map(F.lit, preferred)), lambda f: F.array_contains("_fields", f)), 1, 7)
    why = F.when(F.col("_fields").isNull(), "no fields known").when(F.coalesce(F.size("_ranked"), F.lit(0)) < min_methods, "no method left")
    full = full.withColumn("reason", why)
    specs = full.where("reason is null").select(
        "model", "label", "domain",
        F.transform("_ranked", lambda m: F.struct(m["name"].alias("name"), m["intent"].alias("intent"))).alias("methods"),
        F.when(F.size(searched) > 0, searched).otherwise(F.array(F.lit("id"), F.lit("display_name"))).alias("search_fields"),
        F.when(F.array_contains("_fields", "state"), "state").alias("state_field"),
        F.lit(1).alias("weight"), F.lit("B").alias("tier"),
    )
    return specs, full.where("reason is not null").select("model", "reason")
