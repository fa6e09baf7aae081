"""Ledger of runs: what was written where, and up to which date. One row per run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pricelake.sinks.tables import exists

LEDGER = "id long, product string, data_source string, destination string, occurred_at string, " \
         "min_date string, max_date string"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def ledger_last(ledger: DataFrame, order: str = "id", **keys: str) -> DataFrame:
    """The newest entry for the given keys: one row or none."""
    for column, value in keys.items():
        ledger = ledger.filter(F.col(column) == value)
    return ledger.orderBy(F.col(order).desc(), F.col("id").desc()).limit(1)


def ledger_entry(spark: SparkSession, path: str, order: str = "id", **keys: str) -> Row | None:
    return ledger_last(read_ledger(spark, path), order, **keys).first()


def next_id(spark: SparkSession, path: str) -> int:
    return read_ledger(spark, path).agg(F.coalesce(F.max("id"), F.lit(0)) + 1).first()[0]


def ledger_append(
    spark: SparkSession,
    path: str,
    product: str | None,
    data_source: str,
    destination: str,
    min_date: str | None,
    max_date: str | None,
    run_id: int | None = None,
    occurred_at: str | None = None,
) -> None:
    run_id = next_id(spark, path) if run_id is None else run_id
    at = occurred_at or dt.datetime.now().isoformat(timespec="seconds")
    row = (run_id, product, data_source, destination, at, min_date, max_date)
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(path)
