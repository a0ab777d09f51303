"""The registered queries of this subpackage: thin layers that derive the reported columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, langid, licenses, minhash, packing, secrets, topk, urls, vectors

URL_RULES = [
    ("com", "/", urls.ALLOW),
    ("example.com", "/en/", urls.BLOCK),
    ("www.example.com", "/en/", urls.ALLOW),
    ("net", "/es/", urls.BLOCK),
    ("net", "/fr/", urls.BLOCK),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_50k.json"))
    docs = coder.tokenized(_table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return docs.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, numerator=85, denominator=100)


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "decided_by")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out("doc_id").alias("held_out"))
    train = docs.where("not held_out").select("text", "lang")
    return langid.language_id(docs.select("doc_id", "text", "held_out"), train).select("doc_id", "held_out", "lang_pred", "score")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.span_text("base"), 256).alias("base_sha256"), secrets.span_text("secrets").alias("spans"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "\\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role")))).alias("t"))
    extra = extra.select(F.lit(-7).alias("conv_id"), "t.turn", "t.role", F.lit(own).alias("text"))
    turns = turns.union(extra.select(*[F.col(c).cast(turns.schema[c].dataType) for c in turns.columns]))
    coder = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_50k.json"))
    packs, members = chat.prefix_packs(turns, coder)
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    leaves = chat.read_packs(packs, coder).select(
        "path_key",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return members.join(leaves, "path_key").drop("path_key")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_vectors": op2_vectors,
    "op3_minhash": op3_minhash,
    "op4_urls": op4_urls,
    "op5_langid": op5_langid,
    "op6_licences": op6_licences,
    "op7_packing": op7_packing,
    "op8_topk": op8_topk,
    "op9_secrets": op9_secrets,
    "op10_chat": op10_chat,
}
