"""The register of queries and what they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.jsonl import MESSAGE

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, folder) under the name, and its DuckDB SQL."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def message(role, content, calls=None, call_id=None) -> Column:
    """A turn of the samples' message type."""
    lit = lambda x: F.lit(x) if x is None or isinstance(x, str) else x
    return F.struct(lit(role).alias("role"), lit(content).alias("content"), lit(calls).alias("tool_calls"), lit(call_id).alias("tool_call_id")).cast(MESSAGE)


def call(name: str, arguments: Column, call_id: Column | str = "c") -> Column:
    own = F.lit(call_id) if isinstance(call_id, str) else call_id
    return F.struct(own.alias("id"), F.lit("function").alias("type"), F.struct(F.lit(name).alias("name"), arguments.alias("arguments")).alias("function"))


def conversations(spark: SparkSession, sf_dir: str, text: Column | None = None) -> DataFrame:
    """(conv_id, messages): turns in order, null texts empty; text: what the turns say instead."""
    said = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", message(F.col("role"), said).alias("m")))).alias("ts"))
    return rows.select("conv_id", F.transform("ts", lambda t: t["m"]).alias("messages"))


def array_of(*items) -> Column:
    return F.array(*[F.lit(i) if isinstance(i, str) else i for i in items])
