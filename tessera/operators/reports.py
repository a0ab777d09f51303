"""Audits and usage reports over catalogs, samples and providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def surface_index(specs: DataFrame) -> DataFrame:
    """(model, methods, fields): what a model can do and what can be read of it."""
    return specs.select("model", F.array_sort(F.array_distinct(F.transform("methods", lambda m: m["name"]))).alias("methods"), F.array_sort(F.array_distinct("search_fields")).alias("fields"))


def _mutating(m: Column) -> Column:
    return m["to_state"].isNotNull() & ~F.coalesce(m["returns_action"], F.lit(False))


def _failing(m: Column) -> Column:
    return F.coalesce(F.size(m["failures"]) > 0, F.lit(False))


def surface_audit(specs: DataFrame) -> DataFrame:
    """One row a model: methods, mutating and failing ones, weight; heaviest first."""
    count = lambda test: F.size(F.filter("methods", test))
    return specs.select("model", "domain", F.size("methods").alias("methods"), count(_mutating).alias("mutating"), count(_failing).alias("failing"), "weight").orderBy(F.desc("weight"), "model")


def surface_totals(specs: DataFrame, by: str = "tier") -> DataFrame:
    """Models, methods and failing methods of each tier."""
    return specs.groupBy(by).agg(F.count("*").alias("models"), F.sum(F.size("methods")).alias("methods"), F.sum(F.size(F.filter("methods", _failing))).alias("failing"))


def models_by_domain(specs: DataFrame) -> DataFrame:
    """(domain, models): names in order, comma-joined.  As many names as the catalog has models."""
    return specs.groupBy("domain").agg(F.array_join(F.array_sort(F.collect_list("model")), ", ").alias("models")).orderBy("domain")


def plan_counts(planned: DataFrame, fact: Column, model: str = "model") -> DataFrame:
    """Instances, distinct facts and models of a fact plan."""
    return planned.agg(F.count("*").alias("instances"), F.count_distinct(fact).alias("facts"), F.count_distinct(model).alias("models"))


def usage_share(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key and their share of all, most first."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).orderBy(F.desc("n"), key)


def teachers(samples: DataFrame) -> DataFrame:
    """Samples of each text source."""
    return samples.groupBy(F.col("_meta.teacher").alias("teacher")).agg(F.count("*").alias("n"))


def passed(rows: DataFrame, ok: Column) -> DataFrame:
    """How many rows pass a test and how many fail; null fails."""
    good = F.coalesce(ok, F.lit(False))
    return rows.agg(F.count_if(good).alias("passed"), F.count_if(~good).alias("failed"))


def run_stats(rows: DataFrame, status: str, names: tuple[str, ...] = ("generated", "rejected", "cache_hits", "salvaged", "duplicate_index")) -> DataFrame:
    """Counts of a run's outcomes, one row; outcomes that did not occur are 0."""
    return rows.agg(*[F.count_if(F.col(status) == n).alias(n) for n in names])


def token_ratio(rows: DataFrame, labels: str, ignored: int = -100) -> DataFrame:
    """Of rows with a label per token: rows that have a trainable token, their share, and the share
    of trainable tokens among all."""
    own = F.size(F.filter(labels, lambda t: t != ignored))
    counted = rows.select(own.alias("t"), F.greatest(F.size(labels), F.lit(0)).alias("n"))
    n = F.greatest(F.count("*"), F.lit(1))
    return counted.agg(F.count_if(F.col("t") > 0).alias("kept"), (F.count_if(F.col("t") > 0) / n).alias("kept_share"), (F.coalesce(F.sum("t"), F.lit(0)) / F.greatest(F.sum("n"), F.lit(1))).alias("trainable_share"))


def special_tokens(rows: DataFrame, order: str, text: str, tokens: list[str], end: str, k: int = 200) -> DataFrame:
    """Added tokens, but the end token, that occur in the first k rows."""
    first = rows.orderBy(order).limit(k).select(text)
    found = first.select(F.explode(F.filter(F.array(*map(F.lit, tokens)), lambda t: F.col(text).contains(t))).alias("token"))
    return found.where(F.col("token") != end).distinct()


def pairs_of(rows: DataFrame, key: str, side: str, left: str, right: str) -> DataFrame:
    """(key, complete): keys that have rows of both sides, or of one only."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg((F.coalesce(F.bool_or(F.col(side) == left), F.lit(False)) & F.coalesce(F.bool_or(F.col(side) == right), F.lit(False))).alias("complete"))


def require_pairs(pairs: DataFrame, key: str) -> None:
    """An error that names a key of which one side is missing."""
    lone = pairs.where("not complete").select(key).orderBy(key).limit(1).collect()
    if lone:
        raise ValueError(f"the other half of {lone[0][0]} is missing")


def scenario_space(specs: DataFrame, personas: DataFrame, situations: DataFrame) -> DataFrame:
    """How many scenarios (model, method, persona of its roles, situation of its model or domain)
    there are, from counts: no scenario becomes a row."""
    by_role = personas.groupBy("role").agg(F.count("*").alias("_p"))
    people = specs.select("model", F.explode(F.array_distinct("personas")).alias("role")).join(by_role, "role").groupBy("model").agg(F.sum("_p").alias("_people"))
    own = situations.where("model is not null").groupBy("model").agg(F.count("*").alias("_own"))
    wide = situations.where("model is null").groupBy("domain").agg(F.count("*").alias("_wide"))
    counted = specs.select("model", "domain", F.size("methods").alias("_methods")).join(people, "model", "left").join(own, "model", "left").join(wide, "domain", "left")
    n = F.col("_methods") * F.coalesce("_people", F.lit(0)) * F.coalesce("_own", "_wide", F.lit(0))
    return counted.select("model", n.cast("bigint").alias("scenarios"))


def unknown_names(asked: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Names asked for that nobody knows."""
    return asked.select(name).distinct().join(known.select(name).distinct(), name, "left_anti")


def by_content(rows: DataFrame, content: str, order: str) -> DataFrame:
    """One row for each content, the first in the order, told apart by digest."""
    rest = rows.columns
    first = rows.where(F.col(content).isNotNull()).groupBy(F.sha2(content, 256).alias("_d")).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return first.select("_r.*")
