"""Splits, quotas and interleavings that are the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def before_totals(rows: DataFrame, order: list[str], value: str, bucket: Column, out: str) -> DataFrame:
    """rows with `out`: the sum of `value` over all rows before in the order, and `_total` over all.
    bucket: a number or text that never decreases along the order and has few values; sums run
    within buckets, and only the buckets' totals meet in one task."""
    own = rows.withColumn("_bucket", bucket)
    totals = own.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_bucket", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_base"), F.sum("_sum").over(Window.partitionBy()).alias("_total"))
    within = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return own.join(bases, "_bucket").withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_bucket", "_base")


def bounds_of(rows: DataFrame, value: str, parts: int = 256) -> list:
    """Bounds that part the values of a numeric column into about equal shares; at most `parts`
    numbers reach the driver, whatever the rows."""
    asked = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx(value, asked, 10_000).alias("q")).first()["q"]
    return sorted(set(found or []))


def bucket_of(value: Column, bounds: list) -> Column:
    """How many of the bounds are below the value."""
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < value)) if bounds else F.lit(0)


def leak_free_split(rows: DataFrame, key: str, fraction: float, rank: Column) -> DataFrame:
    """rows with `split`: whole groups go to eval, in order of `rank`, while the rows of the
    groups before are fewer than the target.  rank: a text that spreads evenly, as a digest does.
    The running sum is over groups, in buckets of the rank's first three characters."""
    groups = rows.groupBy(key).agg(F.count("*").alias("_n")).withColumn("_rank", rank)
    summed = before_totals(groups, ["_rank", key], "_n", F.coalesce(F.substring("_rank", 1, 3), F.lit("")), "_before")
    flagged = summed.select(key, F.when(F.col("_before") < F.floor(F.col("_total") * fraction), "eval").otherwise("train").alias("split"))
    return rows.join(flagged, key)


def focus_mix(rows: DataFrame, family: str, focus: list[str], anchor: int, order: Column, families: int) -> DataFrame:
    """All rows of the focus families and an equal quota of each other one."""
    quota = max(1, anchor // max(families - len(focus), 1))
    others = rows.where(~F.col(family).isin(focus)).withColumn("_nth", F.row_number().over(Window.partitionBy(family).orderBy(order)))
    return rows.where(F.col(family).isin(focus)).unionByName(others.where(F.col("_nth") <= quota).drop("_nth"))


def budget_cycle(pool: DataFrame, key: str, order: str, budget: int) -> DataFrame:
    """budget draws per key that go round its pool."""
    own = Window.partitionBy(key)
    numbered = pool.withColumns({"_pos": F.row_number().over(own.orderBy(order)) - 1, "_n": F.count("*").over(own)})
    draws = F.filter(F.sequence(F.lit(0), F.lit(budget - 1)), lambda i: F.pmod(i, F.col("_n")) == F.col("_pos"))
    return numbered.withColumn("draw", F.explode(draws)).drop("_pos", "_n")


#: Slots of a hundred that each tier has.
SHARES = {1: 50, 2: 30, 3: 15, 4: 5}
# End of fixed values.


def tier_interleave(spark, rows: DataFrame, tier: str, order: str, slots: int) -> DataFrame:
    """slots by hundred: 50 of tier 1, 30 of tier 2, 15 of tier 3, 5 of tier 4, each tier in turn;
    a slot of an empty tier goes to tier 1, and without tier 1 the slots take all rows in order.
    order: a numeric column that tells rows apart.  Four counts reach the driver."""
    sizes = {r[tier]: r["n"] for r in rows.where(F.col(tier).isin(*SHARES)).groupBy(tier).agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1):
        rows, sizes, given = rows.withColumn(tier, F.lit(1)), {1: rows.count()}, [1] * 100
        if not sizes[1]:
            return spark.range(0).select(F.col("id").alias("slot")).join(rows, F.lit(False))
    else:
        given = [t if sizes.get(t) else 1 for t, share in SHARES.items() for _ in range(share)]
    turn = [given[:k].count(t) for k, t in enumerate(given)]
    at = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % 100).cast("int").alias("_at"))
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("_at"))
    nth = F.floor(F.col("slot") / 100) * pick([given.count(t) for t in given]) + pick(turn)
    at = at.select("slot", pick(given).alias("_tier"), F.pmod(nth, pick([sizes[t] for t in given])).cast("bigint").alias("_pos"))
    bounds = bounds_of(rows, order)
    placed = before_totals(rows.where(F.col(tier).isin(*sizes)).withColumn("_one", F.lit(1)), [order], "_one", F.struct(F.col(tier), bucket_of(F.col(order), bounds)), "_all").drop("_one", "_total")
    starts = {t: sum(n for u, n in sizes.items() if u < t) for t in sizes}
    base = F.get(F.array(*[F.lit(starts.get(t, 0)) for t in range(5)]), F.col(tier).cast("int"))
    placed = placed.withColumn("_pos", (F.col("_all") - base).cast("bigint")).withColumn("_tier", F.col(tier)).drop("_all")
    return at.join(placed, ["_tier", "_pos"]).drop("_tier", "_pos")


def round_targets(families: DataFrame, target: str, chunk: int) -> DataFrame:
    """One row per family and round with what the round should reach; saturated rounds left out."""
    rounds = F.sequence(F.lit(1), F.greatest(F.ceil(F.col(target) / chunk).cast("int"), F.lit(1)))
    return families.withColumn("round", F.explode(rounds)).withColumn("goal", F.least(F.col(target), F.col("round") * chunk))


def draw(seed: str, index: Column, salt: str, n: int) -> Column:
    """A reproducible choice in [0, n) for an index, from 60 bits of a digest that any engine has."""
    digest = F.sha2(F.concat_ws("|", F.lit(seed), F.lit(salt), index.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def prefix_until(rows: DataFrame, key: str, order: str, failed: Column) -> DataFrame:
    """Rows of each key up to and with the first failure."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_f", F.coalesce(F.max(failed.cast("int")).over(before), F.lit(0))).where("_f = 0").drop("_f")
