"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricelake.session import scratch_path


#: An Arrow batch that goes to Python ends with the row that reaches so many bytes. Spark's 64 MB are held by the JVM and the worker of each task.
BATCH_BYTES = 4 << 20
#: Paths written inside ``scope``, if one is open.
_open: list[list[str]] = []


@contextmanager
def scope(made: list[str]) -> Iterator[None]:
    """Inside, the paths that ``stored`` writes are also put into ``made``, for ``remove``."""
    _open.append(made)
    try:
        yield
    finally:
        _open.pop()


def remove(spark: SparkSession, made: list[str]) -> None:
    """Remove tables that nothing reads any more, wherever the shared folder is."""
    while made:
        path = spark._jvm.org.apache.hadoop.fs.Path(made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, per_task: int = 50_000) -> Iterator[None]:
    """Inside, a shuffle has a task for every ``per_task`` rows (two per core at least, as many as set at most), also where AQE doesn't join them.

    It sets ``spark.sql.shuffle.partitions`` of the session and puts it back.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), max(2 * spark.sparkContext.defaultParallelism, -(-rows // per_task)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def while_stored(spark: SparkSession) -> Iterator[None]:
    """Inside, a batch for Python has ``BATCH_BYTES`` and its last row at most, whatever the number of rows, and a query's shuffle files go
    when it ends; else they stay until the driver happens to collect its garbage. It sets the session's values and puts them back.
    """
    own = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write a table to the shared folder and read it: cuts the lineage and survives a lost executor."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, label)
    if _open:
        _open[-1].append(path)
    with while_stored(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, used: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars")) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its other columns under names that clash with nothing, and what gives the old columns back."""
    names = docs.columns
    new = {c: c if c in used else f"_aside_{i}" for i, c in enumerate(names)}
    return docs.select(*(F.col(f"`{c}`").alias(new[c]) for c in names)), lambda df: df.select(*(F.col(new[c]).alias(c) for c in names))
