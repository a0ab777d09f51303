"""From a cache of samples to training files: load, repair, gate, render, split, write.

Every step is a projection or a filter; what shuffles is the gate's duplicate keys, the split's
groups and the counts of reports.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import group_key, scrub_think, strip, strip_think
from ..sources.jsonl import MESSAGE, read_jsonl, valid_cache, write_jsonl
from . import gate, sampling, summaries, verdicts

#: Families of the two extra views, in order; attempts for each sample that is wanted.
TOOL_FAMILIES = ("tool_calling", "lookup_then_act", "mcp_agent_protocol", "workflow_execution", "business_data_retrieval")
TRAJECTORY_FAMILIES = ("agent_trajectories", "multi_turn_memory", "verification")
ATTEMPTS, EXTRA_ATTEMPTS, FIRST_EXTRA = 1.45, 8, 64
# End of fixed values.


def training_row(rows: DataFrame) -> DataFrame:
    """What a trainer reads: the messages alone."""
    return rows.select("messages")


def sidecar(rows: DataFrame, split: str = "split") -> DataFrame:
    """Provenance of each row and its split, without the messages."""
    return rows.select("_meta.*", split)


def first_exchange(messages: Column) -> Column:
    """struct(prompt, gold): the turns before the first assistant turn, and that turn; without one
    all turns and null."""
    at = F.array_position(F.transform(messages, lambda m: m["role"]), "assistant")
    before = F.when(at > 0, at - 1).otherwise(F.size(messages)).cast("int")
    return F.struct(F.slice(messages, F.lit(1), before).alias("prompt"), F.when(at > 0, F.get(messages, before)).alias("gold"))


def exchanges(rows: DataFrame, order: str, limit: int) -> DataFrame:
    """The first `limit` rows in the order that have both halves, as prompt and gold."""
    both = rows.select(order, first_exchange(F.col("messages")).alias("_x")).where((F.size("_x.prompt") > 0) & F.col("_x.gold").isNotNull())
    return both.orderBy(order).limit(limit).select(order, "_x.prompt", "_x.gold")


def capped(rows: DataFrame, order: str, cap: int | None) -> DataFrame:
    """The first `cap` rows in the order; all where there is no cap."""
    return rows if cap is None else rows.orderBy(order).limit(cap)


def chat_messages(messages: Column, keep_think: bool = False) -> Column:
    """Turns as a chat template reads them: null content as empty text, think blocks dropped unless
    kept, arguments as values instead of JSON text (text that is no JSON stays text), ids gone."""

    def call(c: Column) -> Column:
        text = c["function"]["arguments"]
        listed = F.to_json(F.array(text))
        value = F.coalesce(F.try_parse_json(text), F.parse_json(F.substring(listed, F.lit(2), F.length(listed) - 2)))
        return F.struct(F.lit("function").alias("type"), F.struct(c["function"]["name"].alias("name"), value.alias("arguments")).alias("function"))

    def turn(m: Column) -> Column:
        content = F.coalesce(m["content"], F.lit(""))
        shown = content if keep_think else strip(strip_think(content))
        made = F.when(F.size(m["tool_calls"]) > 0, F.transform(m["tool_calls"], call))
        return F.struct(m["role"].alias("role"), shown.alias("content"), made.alias("tool_calls"))

    return F.transform(messages, turn)


def chatml(messages: Column) -> Column:
    """Turns in the im_start layout."""
    turn = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit("<|im_end|>\n"))
    return F.array_join(F.transform(messages, turn), "")


def chatml_with_calls(messages: Column) -> Column:
    """Chat turns (see chat_messages) in the im_start layout, calls as tagged JSON after the text."""

    def call(c: Column) -> Column:
        return F.concat(F.lit("\n<tool_call>\n"), F.to_json(F.struct(c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments"))), F.lit("\n</tool_call>"))

    def turn(m: Column) -> Column:
        made = F.coalesce(F.array_join(F.transform(m["tool_calls"], call), ""), F.lit(""))
        return F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], made, F.lit("<|im_end|>\n"))

    return F.array_join(F.transform(messages, turn), "")


def route(rows: DataFrame, text: str, max_chars: int) -> DataFrame:
    """rows with `status`: failed where nothing was rendered, too_long beyond max_chars, else
    rendered."""
    return rows.withColumn("status", F.when(F.col(text).isNull(), "failed").when(F.length(text) > max_chars, "too_long").otherwise("rendered"))


def scrubbed(rows: DataFrame, product: str = "product") -> DataFrame:
    """rows whose assistant turns have no rehearsed directives in their think blocks."""
    echo = gate.instruction_echo(product)

    def turn(m: Column) -> Column:
        clean = scrub_think(F.coalesce(m["content"], F.lit("")), echo)["text"]
        touched = (m["role"] == "assistant") & m["content"].contains("<think>")
        return F.when(touched, F.struct(m["role"].alias("role"), clean.alias("content"), m["tool_calls"].alias("tool_calls"), m["tool_call_id"].alias("tool_call_id")).cast(MESSAGE)).otherwise(m)

    return rows.withColumn("messages", F.transform("messages", turn))


def load_cache(spark: SparkSession, path: str, *, version: str = "2.0", methods: DataFrame | None = None, product: str = "product", prefix: str = "tool_") -> tuple[DataFrame, DataFrame]:
    """(samples, rejected) of a cache: legible rows of this version, repaired, judged again; of rows
    that repeat a key the last index counts.  rejected keeps the reasons."""
    rows = scrubbed(valid_cache(read_jsonl(spark, path), version), product)
    rows = rows.withColumns({"_key": F.col("_meta.key"), "_index": F.col("_meta.index")})
    last = rows.groupBy("_key").agg(F.max_by(F.struct("messages", "_meta"), F.struct(F.coalesce("_index", F.lit(-1)), F.to_json("messages"))).alias("r")).select("_key", "r.*").withColumn("_index", F.col("_meta.index"))
    judged = verdicts.judge(last, "_key", "_key", methods, product=product, prefix=prefix)
    return judged.where(F.size("reasons") == 0).select("messages", "_meta"), judged.where(F.size("reasons") > 0).select("messages", "_meta", "reasons")


def resume_points(samples: DataFrame, targets: DataFrame, family: str = "family", index: str = "index") -> DataFrame:
    """For each target (family, target): rows there are, the next index, how many are needed and how
    many attempts they may take.  A family of rows without an index starts well behind its count."""
    have = samples.groupBy(family).agg(F.count("*").alias("have"), F.max(index).alias("_last"))
    out = targets.join(have, family, "left").withColumn("have", F.coalesce("have", F.lit(0)))
    behind = F.when(F.col("have") == 0, 0).otherwise(2 * F.col("have") + FIRST_EXTRA)
    needed = F.greatest(F.lit(0), F.col("target") - F.col("have"))
    return out.select(
        family, "target", "have",
        F.when(F.col("_last").isNotNull(), F.greatest(F.col("_last") + 1, F.col("have"))).otherwise(behind).cast("bigint").alias("next_index"),
        needed.alias("needed"), (F.floor(needed * ATTEMPTS) + EXTRA_ATTEMPTS).cast("bigint").alias("attempts"),
    )


def choose_families(families: list[str], asked: str | None, have: dict[str, int], presets: dict[str, list[str]] | None = None) -> list[str]:
    """The families that a run makes: all, a preset, `reverse`, `empty` (those without rows), or a
    comma-joined list in the library's order; an unknown name is an error."""
    if not asked or asked == "all":
        return list(families)
    if asked == "reverse":
        return list(reversed(families))
    if asked == "empty":
        return [f for f in families if not have.get(f)]
    if asked in (presets or {}):
        return [f for f in families if f in presets[asked]]
    names = [n.strip() for n in asked.split(",") if n.strip()]
    unknown = sorted(set(names) - set(families))
    if unknown:
        raise ValueError(f"unknown families: {', '.join(unknown)}")
    return [f for f in families if f in names]


def without_rows(families: DataFrame, rows: DataFrame, family: str = "family") -> DataFrame:
    """Families that have no row yet."""
    return families.join(rows.select(family).distinct(), family, "left_anti")


def legacy_rows(spark: SparkSession, path: str, surface: DataFrame) -> DataFrame:
    """Rows of an older knowledge file about models on the surface (column model), labelled as
    samples of schema_knowledge; a missing file has none."""
    shape = "messages array<struct<role:string,content:string>>, _model string, _type string"
    try:
        rows = spark.read.schema(shape).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], shape)
    return relabelled(rows.where("messages is not null").join(surface.select(F.col("model").alias("_model")).distinct(), "_model", "left_semi"))


def relabelled(rows: DataFrame) -> DataFrame:
    """Older knowledge rows (messages, _model, _type) with the provenance of samples."""
    none = F.lit(None).cast("string")
    meta = F.struct(
        none.alias("key"), F.lit("schema_knowledge").alias("family"), F.concat(F.lit("knowledge:"), F.coalesce("_type", F.lit("legacy"))).alias("shape"), F.col("_model").alias("model"),
        none.alias("method"), none.alias("domain"), none.alias("persona"), F.lit(None).cast("bigint").alias("index"), F.lit("legacy").alias("generator_version"), none.alias("teacher"),
    )
    return rows.select("messages", meta.alias("_meta"))


def split_samples(rows: DataFrame, fraction: float, seed: str) -> DataFrame:
    """rows with `split`; samples of a model's method stay together."""
    keyed = rows.withColumn("_group", group_key(F.col("_meta.model"), F.col("_meta.method")))
    return sampling.leak_free_split(keyed, "_group", fraction, F.sha2(F.concat_ws("|", F.lit(seed), "_group"), 256)).drop("_group")


def prepare(samples: DataFrame, methods: DataFrame | None = None, *, keep_think: bool = False, max_chars: int = 32768, fraction: float = 0.04, seed: str = "20260317", product: str = "product", prefix: str = "tool_", key: str = "_meta.key") -> DataFrame:
    """The preparation step: samples with `status` (rejected, failed, too_long or rendered),
    `reasons`, `text` and `split` (rendered rows only).  The split's fraction is of rendered rows."""
    rows = scrubbed(samples.withColumn("_key", F.col(key)), product)
    judged = verdicts.judge(rows, "_key", "_key", methods, product=product, prefix=prefix)
    text = F.when(F.size("reasons") == 0, chatml_with_calls(chat_messages(F.col("messages"), keep_think)))
    routed = route(judged.withColumn("text", text), "text", max_chars)
    routed = routed.withColumn("status", F.when(F.size("reasons") > 0, "rejected").otherwise(F.col("status")))
    split = split_samples(routed.where("status = 'rendered'"), fraction, seed).select("_key", "split")
    return routed.join(split, "_key", "left").drop("_key")


def preparation_report(prepared: DataFrame, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """(rows by status and split, the most frequent reasons)."""
    return prepared.groupBy("status", "split").agg(F.count("*").alias("n")), top_reasons(prepared, top)


def top_reasons(rows: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent reasons; ties by name."""
    return summaries.tally(rows, "reasons").orderBy(F.desc("n"), "reason").limit(k)


def write_prepared(prepared: DataFrame, path: str) -> None:
    """train, eval (text lines) and eval_meta (provenance in the order of eval)."""
    rows = prepared.where("status = 'rendered'")
    write_jsonl(rows.where("split = 'train'").select("text"), f"{path}/train")
    held = rows.where("split = 'eval'").select("text", "_meta").orderBy(F.col("_meta.key"), "text")
    write_jsonl(held.select("text"), f"{path}/eval")
    write_jsonl(held.select("_meta.*"), f"{path}/eval_meta")


def export(rows: DataFrame, path: str, *, fraction: float = 0.05, seed: str = "20260317", pairs: DataFrame | None = None, knowledge: DataFrame | None = None) -> dict:
    """Writes the views of a run below the path and returns its manifest, which is written too:
    sft and eval (messages), tool_calling and trajectories (families in order), index (provenance
    and split) and, if given, preference pairs."""
    rows = rows if knowledge is None else rows.unionByName(knowledge)
    split = split_samples(rows, fraction, seed)
    views = {
        "sft": training_row(split.where("split = 'train'")),
        "eval": training_row(split.where("split = 'eval'")),
        "tool_calling": ordered_families(rows, TOOL_FAMILIES),
        "trajectories": ordered_families(rows, TRAJECTORY_FAMILIES),
        "index": sidecar(split),
    } | ({"dpo": pairs} if pairs is not None else {})
    for name, view in views.items():
        write_jsonl(view, f"{path}/{name}")
    manifest = manifest_of(split, {name: f"{path}/{name}" for name in views})
    text = json.dumps(manifest, indent=2, ensure_ascii=False)
    rows.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def ordered_families(rows: DataFrame, families: tuple[str, ...]) -> DataFrame:
    """Messages of the families, family after family in the order given."""
    at = F.array_position(F.array(*map(F.lit, families)), F.col("_meta.family"))
    return rows.where(at > 0).orderBy(at, "_meta.index").select("messages")


def manifest_of(split: DataFrame, files: dict[str, str]) -> dict:
    """Totals, counts by family, model, persona and shape (most frequent first), and the files."""
    names = ("family", "model", "persona", "shape")
    flat = split.select(*[F.coalesce(F.col(f"_meta.{n}"), F.lit("?")).alias(n) for n in names], "split")
    counts = summaries.manifest(flat, [*names, "split"]).orderBy(F.desc("n"), "value").collect()
    of = lambda d: {r["value"]: r["n"] for r in counts if r["dimension"] == d}
    by_split = of("split")
    totals = {"samples": sum(by_split.values()), "train": by_split.get("train", 0), "eval": by_split.get("eval", 0), "families": len(of("family"))}
    return {"totals": totals} | {f"by_{n}": of(n) for n in names} | {"files": files}
