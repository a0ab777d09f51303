"""Gate predicates on tool calls and their results.

Predicates within one transcript are Columns; those that need the catalog's methods go through a
long form of one row per call and equi-joins, so that a catalog of any size works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_think
from .gate import PLACEHOLDER, STATE_CLAIM, final_answer, unnegated_write

STATE_FIELDS = ("state", "status", "payment_state", "invoice_status")
MUTATING = ("create", "write", "unlink", "execute_method")
#: Methods that every model has.
UNIVERSAL = (
    "create", "write", "unlink", "read", "search", "search_read", "search_count", "copy", "name_search", "read_group", "fields_get", "default_get",
    "message_post", "toggle_active",
)
# End of fixed values.


def calls(messages: Column) -> Column:
    """All tool calls of a transcript in order."""
    return F.flatten(F.transform(messages, lambda m: F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"))))


def orphan_results(messages: Column) -> Column:
    """Whether a tool turn has no id, or one that no call of the transcript issued."""
    issued = F.transform(calls(messages), lambda c: c["id"])
    answered = F.transform(F.filter(messages, lambda m: m["role"] == "tool"), lambda m: m["tool_call_id"])
    return F.exists(answered, lambda i: i.isNull()) | (F.size(F.array_except(answered, issued)) > 0)


def reported_states(messages: Column) -> Column:
    """Lower-case state values in the JSON objects, or lists of them, that tools returned."""
    shape = "array<struct<" + ",".join(f"{f}:string" for f in STATE_FIELDS) + ">>"
    rows = F.flatten(F.transform(F.filter(messages, lambda m: m["role"] == "tool"), lambda m: F.coalesce(F.from_json(m["content"], shape), F.array().cast(shape))))
    values = F.flatten(F.transform(rows, lambda r: F.array(*[F.lower(r[f]) for f in STATE_FIELDS])))
    return F.array_compact(F.array_distinct(values))


def unsupported_state(messages: Column) -> Column:
    """Whether the answer names a record state that no tool result holds."""
    answer = strip_think(final_answer(messages))
    said = F.zip_with(*[F.regexp_extract_all(answer, F.lit(STATE_CLAIM), F.lit(g)) for g in (1, 2)], lambda a, b: F.when(a != "", a).otherwise(b))
    claims = F.filter(F.transform(said, lambda c: F.lower(F.trim(c, F.lit(" '\"`*.")))), lambda c: c != "")
    return F.size(F.array_except(claims, reported_states(messages))) > 0


def unmade_write(messages: Column, prefix: str = "tool_") -> Column:
    """Whether an answer claims a change although the transcript's calls only read."""
    names = F.transform(calls(messages), lambda c: c["function"]["name"])
    wrote = F.exists(names, lambda n: n.isin(*[prefix + m for m in MUTATING]))
    return (F.size(names) > 0) & ~F.coalesce(wrote, F.lit(False)) & unnegated_write(strip_think(final_answer(messages)))


def method_index(methods: DataFrame) -> DataFrame:
    """(model, method), once each: the methods of every model and those that all models have."""
    own = methods.select("model", "method").where("model is not null and method is not null")
    shared = own.select("model").distinct().select("model", F.explode(F.array(*map(F.lit, UNIVERSAL))).alias("method"))
    return own.unionByName(shared).distinct()


def transcript_reasons(messages: Column, prefix: str = "tool_") -> Column:
    """Failed predicates of a transcript's calls and results, in order."""
    checks = [("orphan_tool_result", orphan_results(messages)), ("unsupported_state_claim", unsupported_state(messages)), ("claimed_unmade_write", unmade_write(messages, prefix))]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks]))


def call_reasons(samples: DataFrame, key: str, methods: DataFrame | None = None, messages: str = "messages", prefix: str = "tool_") -> DataFrame:
    """(key, reasons) of the samples whose calls fail: bad_tool_args, unknown_model,
    hallucinated_method, placeholder_values.  A message's first failing call ends its check, so a
    sample lists one reason per failing message.  Without `methods` (model, method) the two
    catalog checks are skipped; with it, the methods that every model has are known too."""
    turns = samples.select(F.col(key).alias("key"), F.posexplode(messages).alias("turn", "m"))
    long = turns.select("key", "turn", F.posexplode("m.tool_calls").alias("nth", "c")).select("key", "turn", "nth", F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("args"))
    parsed = F.schema_of_variant(F.try_parse_json("args"))
    model, method = F.get_json_object("args", "$.model"), F.get_json_object("args", "$.method")
    long = long.withColumns({"bad": ~F.coalesce(parsed.startswith("OBJECT"), F.lit(False)), "model": model, "method": method})
    catalog = F.lit(None).cast("string")
    if methods is not None:
        known = method_index(methods).withColumn("has_method", F.lit(True))
        models = methods.select("model").distinct().withColumn("has_model", F.lit(True))
        long = long.join(models, "model", "left").join(known, ["model", "method"], "left")
        executes = F.col("name") == prefix + "execute_method"
        catalog = F.when(executes & F.col("has_model").isNull(), "unknown_model").when(executes & F.col("has_method").isNull(), "hallucinated_method")
    values = F.map_values(F.from_json(F.get_json_object("args", "$.values"), "map<string,string>"))
    placeholder = F.when(F.exists(values, lambda v: v.rlike(PLACEHOLDER)), "placeholder_values")
    failed = long.withColumn("reason", F.when(F.col("bad"), "bad_tool_args").otherwise(F.coalesce(catalog, placeholder))).where("reason is not null")
    first = failed.groupBy("key", "turn").agg(F.min_by("reason", "nth").alias("reason"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "reason")))
    return first.groupBy("key").agg(F.transform(ordered, lambda r: r["reason"]).alias("reasons")).withColumnRenamed("key", key)


def message_json_length(messages: Column) -> Column:
    """Characters of the messages as JSON text with a space after each comma and colon between
    parts, null fields left out: the compact form's length plus one for each separator."""
    empty = F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>")

    def present(*cols: Column) -> Column:
        total = F.lit(0)
        for c in cols:
            total = total + c.isNotNull().cast("int")
        return total

    def separators(n: Column) -> Column:  # n colons and n - 1 commas
        return F.greatest(2 * n - 1, F.lit(0))

    def of_call(c: Column) -> Column:
        return separators(present(c["id"], c["type"], c["function"])) + separators(present(c["function"]["name"], c["function"]["arguments"]))

    def of_message(m: Column) -> Column:
        own = F.coalesce(m["tool_calls"], empty)
        inner = F.aggregate(own, F.lit(0), lambda a, c: a + of_call(c)) + F.greatest(F.size(own) - 1, F.lit(0))
        return separators(present(m["role"], m["content"], m["tool_calls"], m["tool_call_id"])) + inner

    spaces = F.aggregate(messages, F.lit(0), lambda a, m: a + of_message(m)) + F.greatest(F.size(messages) - 1, F.lit(0))
    return F.length(F.to_json(messages)) + spaces
