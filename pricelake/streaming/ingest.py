"""The incremental runs as Structured Streaming jobs; the checkpoint takes the place of the ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricelake.sinks.tables import append_once, overwrite_partitions


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Files that arrive below `path`, each read once."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def ingest(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    partition: str = "date",
    cluster: Sequence[str] = (),
) -> StreamingQuery:
    """Store each batch of new files raw, and transform the days it touches anew, from all raw rows of those days.

    So a day that comes in several batches is numbered and labelled as one. Raw rows are stored by batch number below
    `<target>_raw`, and whole days are replaced, so a batch that is run again changes nothing. `partition` names the day both in
    the raw rows (text or date) and in the transformed ones.
    """
    raw_path = f"{target}_raw"
    day = F.to_date(F.col(partition).cast("string"))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        append_once(batch.withColumn("_day", day), raw_path, number, "_day")
        new = spark.read.parquet(raw_path).filter(F.col("run_id") == str(number)).select("_day").distinct()
        if new.isEmpty():
            return
        rows = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("_day", T.DateType())])).parquet(raw_path)
        rows = rows.join(new, "_day", "left_semi").select(*batch.columns)
        overwrite_partitions(transform(rows), target, partition, cluster)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_lowest(stream: DataFrame, target: str, checkpoint: str, key: str, time: str, value: str) -> StreamingQuery:
    """Lowest value per key and day, however late a row comes.

    Each batch stores its own minima below `<target>_parts`; the days it touches are made anew from all minima of theirs.
    """
    parts_path = f"{target}_parts"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        minima = batch.groupBy(F.to_date(time).alias("date"), F.col(key).alias("id")).agg(F.min(value).alias("price"))
        append_once(minima, parts_path, number, "date")
        parts = spark.read.parquet(parts_path)
        new = parts.filter(F.col("run_id") == str(number)).select("date").distinct()
        if new.isEmpty():
            return
        days = parts.join(new, "date", "left_semi").groupBy("date", "id").agg(F.min("price").alias("price"))
        overwrite_partitions(days, target, "date", ("id",))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
