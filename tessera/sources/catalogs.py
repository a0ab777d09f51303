"""Catalog relations: model specifications, personas and situations, read from JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FAILURE = "struct<exc:string,message:string>"
METHOD = f"struct<name:string,intent:string,from_state:string,to_state:string,kwargs:string,failures:array<{FAILURE}>,returns_action:boolean>"
SPEC = f"model string, label string, domain string, personas array<string>, methods array<{METHOD}>, create_fields map<string,string>, search_fields array<string>, state_field string, doc_prefix string, weight int, tier string"
PERSONA = "role string, name string, voice string"
SITUATION = "model string, domain string, text string"


def read_catalog(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One relation of the catalog; malformed lines fail the read, since a catalog is curated."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
