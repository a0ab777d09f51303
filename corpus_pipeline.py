"""The corpus pipeline: language, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the
next one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, minhash, packing, secrets
from tessera.llm.store import materialize, release, scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets lang to the predicted language; documents without letters, or of which no language is
    likelier than all others together, go.  The model learns from the stage's own labelled texts."""
    found = langid.language_id(docs.select(*COLUMNS))
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the least doc_id (five-word
    shingles, similarity 0.8).  doc_id is the key of documents: rows that repeat one stay or go
    together; rows of null id stay."""
    drop = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(drop, "doc_id", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows it; every document stays."""
    found = secrets.scan_secrets(docs.select(*COLUMNS))
    clean = found.withColumn("text", secrets.redact(F.col("text"), F.col("secrets")))
    changed = F.size("secrets") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the pieces of all documents with their sequence, offset and token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_documents),
]

#: Language scores, sketches and token ids cannot be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what only a
    stage needed goes when it is written, and so does its input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before = docs
        with scope():
            result = stage(spark, docs, sf_dir)
            docs = materialize(result, name, keep=True)
        release(before)
    return docs
