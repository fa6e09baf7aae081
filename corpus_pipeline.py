"""A corpus pipeline of five stages: quality, near copies, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``. Each is judged by its own input only.

* ``quality_rules`` drops the documents that the adaptive quality rules reject.
* ``near_duplicates`` keeps the document with the smallest id of each group that is linked by five-word shingles at 0.8.
* ``secret_scan`` keeps every document and replaces the secrets in its text.
* ``mix_sources`` samples documents by probabilities fitted to tempered source, language and topic shares.
* ``pack`` returns the pieces of 4096-token windows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import jaccard, mixing, packing, quality, secrets
from pricelake.llm.store import remove, scope, set_aside, stored

#: Intermediate tables of the stage before the current one.
_made: list[str] = []


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage's input is its predecessor's written output, so the predecessor's intermediate tables are removed first."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _made)
        own: list[str] = []
        with scope(own):
            out = f(spark, docs, sf_dir)
        if f.__name__ != "pack":  # nobody is told when the last stage's rows have been read
            _made.extend(own)
        return out

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, put_back = set_aside(docs)
    measured = stored(quality.measure(docs), "measured", spark)
    limits = stored(quality.thresholds(measured), "limits")
    return put_back(quality.judge(measured, limits=limits).where("kept"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, width=5, percent=80)


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, put_back = set_aside(docs)
    return put_back(mixing.mix(docs).where("kept"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: The random forest, the fitted mixture and the packing can't be said in SQL: tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name, spark)
    return docs
