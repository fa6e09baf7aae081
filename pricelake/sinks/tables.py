"""Writers. Data is spread by AQE's rebalance, so that a large day becomes several files and not one task."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.star import apply_upserts
from pricelake.session import scratch_path
from pricelake.sinks import manifest
from pricelake.sources.files import list_files, read_csv_by_name

#: Parts an upserted table is split into by key hash.
BUCKETS = 16


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def append_daily(
    df: DataFrame, path: str, schema: T.StructType, cluster: Sequence[str] = ("name", "size"), reprocess: bool = False
) -> None:
    """Append to a table partitioned by day, rows clustered inside the files. Columns beyond `schema` are kept.

    `reprocess` replaces the whole table, unless `df` has no rows, and takes the columns of `schema` only.
    """
    if reprocess and df.isEmpty():
        return
    columns = [F.col(f.name).cast(f.dataType) for f in schema]
    if not reprocess:
        columns += [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    _by_day(df.select(*columns), "date", cluster).write.mode("overwrite" if reprocess else "append").partitionBy(
        "date"
    ).parquet(path)


def append_once(df: DataFrame, path: str, run_id: int | str, partition: str = "date", cluster: Sequence[str] = ()) -> None:
    """Append as part of the run `run_id`: a repeated run replaces its own rows, and only those."""
    tagged = df.withColumn("run_id", F.lit(str(run_id)))
    _by_day(tagged, partition, ("run_id", *cluster)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition, "run_id").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: str, cluster: Sequence[str] = ()) -> None:
    """Replace just the partitions that `df` holds."""
    _by_day(df, by, cluster).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All columns any file has; the bookkeeping column of `append_once` is left out."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("run_id")


def sync_columns(df: DataFrame, target: T.StructType, drop_removed: bool = True) -> DataFrame:
    """`df` in the columns of `target`: absent ones as typed nulls, extra ones dropped or kept at the end."""
    columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    if not drop_removed:
        columns += [F.col(c) for c in df.columns if c not in target.fieldNames()]
    return df.select(*columns)


def upsert(
    spark: SparkSession, path: str, df: DataFrame, key: str | Sequence[str], replace: bool = False, buckets: int = BUCKETS, keep: int = 2
) -> None:
    """Merge `df` into the table at `path`: matches are replaced, the rest is added. `replace` drops what was there.

    The table is split by key hash into `buckets` (fixed when it is first written or replaced). Only the buckets that `df` touches are read and
    written; then a manifest names each bucket's folder, so readers keep the old table until all of the new one is there, and a second writer at the
    same time fails. The folders of the newest `keep` manifests stay.
    """
    keys = [key] if isinstance(key, str) else list(key)
    number, content = manifest.latest(spark, path)
    if replace or content is None:
        content = {"parts": {}, "buckets": buckets, "schema": df.schema.json()}
    schema = _wider(T.StructType.fromJson(json.loads(content["schema"])), df.schema)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(content["buckets"])).alias("_bucket")
    incoming = scratch_path(spark, "upsert")
    sync_columns(df, schema).select("*", bucket).write.parquet(incoming)
    incoming = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.LongType())])).parquet(incoming)
    touched = [str(r[0]) for r in incoming.select("_bucket").distinct().collect()]  # at most `buckets` numbers
    old = [f"{path}/{f}" for b in touched for f in content["parts"].get(b, [])]
    current = spark.read.schema(schema).parquet(*old).select("*", bucket) if old else None
    folder = manifest.new_folder(number)
    merged = apply_upserts(current, incoming, keys)
    merged.hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *keys).write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    parts = content["parts"] | {b: [f"{folder}/_bucket={b}"] for b in touched}
    manifest.commit(spark, path, number, content | {"parts": parts, "schema": schema.json()})
    manifest.clean(spark, path, keep)


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of an upserted table, or None."""
    _, content = manifest.latest(spark, path)
    if content is None:
        return None
    schema = T.StructType.fromJson(json.loads(content["schema"]))
    found = [f"{path}/{f}" for f in sorted(manifest.folders(content))]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def publish(df: DataFrame, path: str, index: Sequence[str], append: bool = False) -> None:
    """Copy for serving: index columns first, files sorted by them. Replaces the copy unless `append`."""
    ordered = df.select(*index, *[c for c in df.columns if c not in index])
    ordered.sortWithinPartitions(*index).write.mode("append" if append else "overwrite").parquet(path)


def publish_jdbc(
    df: DataFrame, url: str, table: str, append: bool = False, batch_rows: int = 100_000, **options: str
) -> int:
    """Bulk insert into a database in batches of `batch_rows`; returns the number of rows sent."""
    sent = Observation()
    writer = df.observe(sent, F.count(F.lit(1)).alias("rows")).write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch_rows), **options
    )
    writer.mode("append" if append else "overwrite").save()
    return sent.get["rows"]


def write_batches(df: DataFrame, path: str, batch_rows: int = 100_000, mode: str = "append") -> int:
    """Write files of at most `batch_rows` rows; returns the total, counted while writing."""
    sent = Observation()
    df.observe(sent, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("maxRecordsPerFile", batch_rows).parquet(path)
    return sent.get["rows"]


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", partition: str | None = "date") -> DataFrame:
    """Daily snapshot as snappy Parquet or headered CSV. Columns without a type become text; no rows is an error."""
    untyped = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    df = df.withColumns({c: F.col(c).cast("string") for c in untyped})
    if df.isEmpty():
        raise ValueError("no rows to write")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition:
        writer = writer.partitionBy(partition)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.options(header="true").format(fmt).load(path)


def migrate_csv(
    spark: SparkSession, source: str, target: str, schema: T.StructType, dry_run: bool = False
) -> DataFrame:
    """Copy headered CSV to Parquet by day; the source stays. Returns files, failures, bytes before and after.

    Columns go by each file's header; short rows are filled with nulls. A row with a value that does not fit `schema` is left
    out and its file counts and is named as failed; the other rows of that file are copied. The day is also kept as a column
    of the files, in the folders as `day`.
    """
    text = read_csv_by_name(spark, source, schema, recursiveFileLookup="true", pathGlobFilter="*.csv")
    cast = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    unfit = F.lit(False)
    for f in schema:
        unfit = unfit | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    rows = text.select(F.struct(*cast).alias("row"), unfit.alias("_bad"), "_file")
    failed = rows.filter("_bad").select(F.array_sort(F.collect_set("_file"))).scalar()
    before = list_files(spark, source, "*.csv").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("csv_bytes")
    )
    totals = before.withColumn("failed", failed).withColumn("failed_files", F.size("failed").cast("long"))
    if dry_run:
        return totals.select(
            "files", "failed_files", "csv_bytes", F.lit(0).cast("long").alias("parquet_bytes"),
            F.lit(None).cast("double").alias("saved_pct"), "failed",
        )
    good = rows.filter("NOT _bad").select("row.*")
    overwrite_partitions(good.withColumn("day", F.col("date")), target, "day")
    written = list_files(spark, target, "*.parquet").select(F.coalesce(F.sum("bytes"), F.lit(0))).scalar()
    after = totals.withColumn("parquet_bytes", written)
    saved = F.round(100 * (1 - F.try_divide(F.col("parquet_bytes"), F.col("csv_bytes"))), 1)
    return after.select("files", "failed_files", "csv_bytes", "parquet_bytes", saved.alias("saved_pct"), "failed")


def report_json(df: DataFrame) -> DataFrame:
    """One JSON text per row; dates in ISO form, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}).alias("json"))


def min_max_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """First and last date as ISO text; (null, null) when the column is absent or holds no date."""
    return df.agg(*date_bounds(df, column))


def date_bounds(df: DataFrame, column: str = "date") -> list[Column]:
    if column in df.columns:
        kind = dict(df.dtypes)[column]
        value = F.try_to_date(column) if kind == "string" else F.col(column).cast("date")
    else:
        value = F.lit(None).cast("date")
    return [F.min(value).cast("string").alias("min_date"), F.max(value).cast("string").alias("max_date")]


def _by_day(df: DataFrame, by: str, cluster: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", by).sortWithinPartitions(by, *cluster)


def _wider(current: T.StructType, incoming: T.StructType) -> T.StructType:
    """Columns of both, the current ones first."""
    return T.StructType([*current.fields, *[f for f in incoming if f.name not in current.fieldNames()]])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there are Parquet files; a damaged table is there, and reading it raises."""
    fs, at = manifest.file_system(spark, path)
    if not fs.exists(at()):
        return False
    found = fs.listFiles(at(), True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False
