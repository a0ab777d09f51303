"""Reports: manifests, tallies, order statistics, scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import before_totals, bounds_of, bucket_of


def manifest(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Counts by each dimension and in total in one pass: (dimension, value, n)."""
    table = rows.select(*dimensions)
    sets = [*[[d] for d in dimensions], []]
    grouped = table.groupingSets(sets, *[F.col(d) for d in dimensions]).agg(F.count("*").alias("n"), *[F.grouping(d).alias(f"_{d}") for d in dimensions])
    which, value = F.lit("total"), F.lit("")
    for d in dimensions:
        which = F.when(F.col(f"_{d}") == 0, d).otherwise(which)
        value = F.when(F.col(f"_{d}") == 0, F.col(d).cast("string")).otherwise(value)
    return grouped.select(which.alias("dimension"), value.alias("value"), "n")


def tally(rows: DataFrame, reasons: str) -> DataFrame:
    """Occurrences of each reason, repeats included."""
    return rows.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def discrete_quantiles(rows: DataFrame, value: str, limit: float) -> DataFrame:
    """The elements at n // 2 and floor(0.95 n) of the sorted values, the largest, and the share
    above the limit, from a histogram of distinct values instead of a sort of all rows; prefix
    sums run in parts of the values' range."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("c"))
    ranked = before_totals(counts, [value], "c", bucket_of(F.col(value), bounds_of(rows, value)), "before")
    ranked = ranked.select(value, "c", (F.col("before") + F.col("c")).alias("upto"), F.col("_total").alias("n"))
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col(value)))
    return ranked.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        at(F.floor(F.col("n") / 2)).alias("median"),
        at(F.floor(F.col("n") * 0.95)).alias("p95"),
        F.max(value).alias("largest"),
        (F.sum(F.when(F.col(value) > limit, F.col("c")).otherwise(0)) / F.greatest(F.max("n"), F.lit(1))).alias("share_over"),
    )


def scorecard(pairs: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Samples, and count and percentage of each condition."""
    n = F.count("*")
    out = [n.alias("samples")]
    for name, c in conditions.items():
        hits = F.count_if(c)
        out += [hits.alias(name), F.round(100.0 * hits / F.greatest(n, F.lit(1)), 1).alias(f"{name}_pct")]
    return pairs.agg(*out)


def shortfall(targets: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Rows that each target lacks."""
    counts = have.groupBy(key).agg(F.count("*").alias("have"))
    joined = targets.join(counts, key, "left").withColumn("have", F.coalesce("have", F.lit(0)))
    return joined.withColumn("missing", F.greatest(F.lit(0), F.col("target") - F.col("have")))
