"""Comparing all members of hash buckets in blocks of bounded size.

A bucket is cut into blocks by a hash of the member ids, and each pair of blocks is one group of
work; no pair of members becomes a row, and no group holds more than two blocks' members, however
large the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salt(member: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(member, F.lit("block")), blocks).cast("int")


def block_pairs(entries: DataFrame, bucket: str, member: str, block: int, hot: int) -> DataFrame:
    """entries (bucket, member) to (bucket, hot, lo, hi, side, member): every pair of members of a
    bucket meets in exactly one group (bucket, lo, hi), as two members of side 0 where lo = hi, else
    one of each side.  hot: whether the bucket has more members than that.  Buckets of one member
    are left out."""
    sizes = entries.groupBy(bucket).agg(F.count("*").alias("_n")).where("_n > 1")
    dealt = entries.join(sizes, bucket).select(bucket, member, (F.col("_n") > hot).alias("hot"), F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    dealt = dealt.withColumn("_own", salt(member, F.col("_blocks")))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.select(
        bucket,
        "hot",
        F.least("_own", "_other").alias("lo"),
        F.greatest("_own", "_other").alias("hi"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
        member,
    )
