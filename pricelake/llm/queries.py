"""One query per operator, over its whole table with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricelake.llm import chat, ctw, exact, jaccard, merkle, mixing, packing, pseudonyms, quality, repair, secrets, topk, urls
from pricelake.llm.oracles import ORACLES
from pricelake.llm.store import stored


#: For the checks only; a real run passes its own secret.
PSEUDONYM_KEY = b"example key of the checks"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_context_tree(spark: SparkSession, sf: str) -> DataFrame:
    return ctw.score(_table(spark, sf, "documents"))


def op2_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonyms.pseudonymize(_table(spark, sf, "documents"), key=PSEUDONYM_KEY)


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    measured = quality.measure(_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    measured = stored(measured.drop("text"), "measures")
    return quality.judge(measured).select("doc_id", *quality.COUNTS, "base_failed", "kept", "lang", "source")


def op4_top_k(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows.where("vec_id % 50 = 0"), rows, k=5, scale=256.0)


def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(_table(spark, sf, "documents"))


def op6_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    made = chat.format_chats(chat.text_parts(rows.unionByName(extra)))
    made = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learnt"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents")).drop("text")


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


#: (verdict, host and path).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op9_url_templates(spark: SparkSession, sf: str) -> DataFrame:
    """The last number of a page's path is the id of its document, whose labels teach the method."""
    pages = _table(spark, sf, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.host_and_path(F.col("url"))[1], r"([0-9]{1,18})[^0-9/]*/?$", 1)
    labels = _table(spark, sf, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    taught = pages.select("page_id", F.when(number != "", number).cast("bigint").alias("doc_id"))
    return urls.judge(pages, taught.join(labels, "doc_id").select("page_id", "bad"), URL_RULES)


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf, "documents"), width=4, percent=85)


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    whole = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = repair.damage(whole)
    return repair.report(rows, repair.repair(rows), whole)


def op12_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf, "documents"))


__all__ = ["ORACLES", "QUERIES"]
QUERIES = {f.__name__: f for f in (op1_context_tree, op2_pseudonyms, op3_quality_rules, op4_top_k, op5_secret_scan, op6_chat_format, op7_mixing, op8_packing, op9_url_templates, op10_jaccard_join, op11_conversation_repair, op12_exact_dedup, op13_merkle_manifest)}
