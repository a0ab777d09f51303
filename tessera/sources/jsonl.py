"""Tolerant JSON-lines sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("tool_calls", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("function", T.StructType([T.StructField("name", T.StringType()), T.StructField("arguments", T.StringType())]))]))),
        T.StructField("tool_call_id", T.StringType()),
    ]
)
META = T.StructType([T.StructField(n, T.StringType()) for n in ("key", "family", "shape", "model", "method", "domain", "persona")] + [T.StructField("index", T.LongType()), T.StructField("generator_version", T.StringType()), T.StructField("teacher", T.StringType())])
SAMPLE = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), T.StructField("_meta", META)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str = SAMPLE) -> DataFrame:
    """Rows of JSON lines; blank, torn and malformed lines are left out."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = "_corrupt_line"
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).json(path)
    return rows.where(F.col(bad).isNull()).drop(bad).dropna("all")


def valid_cache(rows: DataFrame, version: str = "2.0") -> DataFrame:
    """Samples with key, family and the current generator version."""
    return rows.where(F.col("_meta.key").isNotNull() & F.col("_meta.family").isNotNull() & (F.col("_meta.generator_version") == version))


def write_jsonl(rows: DataFrame, path: str) -> int:
    """One JSON object a line, UTF-8 as it is; returns the number of rows, counted while writing."""
    seen = Observation()
    counted = rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).observe(seen, F.count("*").alias("n"))
    counted.write.mode("overwrite").text(path)
    return seen.get["n"]


def write_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """All rows as Parquet, a folder for each split."""
    rows.write.mode("overwrite").partitionBy(split).parquet(path)
