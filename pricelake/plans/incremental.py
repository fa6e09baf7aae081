"""Incremental runs driven by the ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.clean import CLEANERS, STAGING
from pricelake.session import scratch_path
from pricelake.sinks.ledger import ledger_append, ledger_entry, next_id
from pricelake.sinks.search_index import refresh_index
from pricelake.sinks import manifest
from pricelake.sinks.tables import append_once, date_bounds, publish, read_current, upsert
from pricelake.sources.files import read_raw_mixed, scan_since

# Columns the files of a day are clustered by, per product.
CLUSTERING = {"merc": ("name", "size"), "carr": ("name",)}


def run_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    ledger: str,
    product: str,
    raw_schema: T.StructType,
    clean: Callable[[DataFrame], DataFrame] | None = None,
    reprocess: bool = False,
) -> bool:
    """Clean the files newer than the last run and append them; says whether rows were written.

    The rows carry the run's number, so a run that is repeated after a failure replaces its own rows. `reprocess`
    reads all files, without the ledger, and replaces the table.
    """
    clean = clean or CLEANERS[product]
    keys = {"product": product, "data_source": source, "destination": target}
    last = None if reprocess else ledger_entry(spark, ledger, **keys)
    raw = read_raw_mixed(spark, source, raw_schema, last.max_date if last else None)
    if raw.isEmpty():
        return False
    run_id = next_id(spark, ledger)
    rows = clean(raw).select(*STAGING.fieldNames())
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *date_bounds(rows))
    cluster = CLUSTERING.get(product, ("name",))
    if reprocess:
        # The rows of the new run replace all earlier runs, but only once they are complete and not empty.
        made = scratch_path(spark, "reprocess")
        rows.write.parquet(made)
        if seen.get["rows"]:
            whole = spark.read.schema(rows.schema).parquet(made).withColumn("run_id", F.lit(str(run_id)))
            whole.hint("rebalance", "date").sortWithinPartitions("date", "run_id", *cluster).write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).partitionBy("date", "run_id").parquet(target)
    else:
        append_once(rows, target, run_id, "date", cluster)
    written = seen.get
    if not written["rows"]:
        return False
    ledger_append(spark, ledger, product, source, target, written["min_date"], written["max_date"], run_id)
    return True


@dataclass(frozen=True)
class PublishTask:
    """A table to copy for serving. `searched` also keeps a token index next to it, by what has changed."""

    table: DataFrame
    name: str
    path: str
    index: Sequence[str]
    incremental: bool = False
    searched: Sequence[str] = ()


def run_publish(spark: SparkSession, tasks: Sequence[PublishTask], ledger: str, overlap_days: int = 0) -> list[str]:
    """Copy each table, or what is newer than its last copy; returns the names written.

    Rows that changed within dates copied before are taken again with `overlap_days`, by replacing those days.
    """
    done = []
    for task in tasks:
        last = ledger_entry(spark, ledger, "occurred_at", destination=task.path) if task.incremental else None
        rows = scan_since(task.table, last.max_date if last else None)
        if last and overlap_days:
            start = F.date_sub(F.lit(last.max_date).cast("date"), overlap_days)
            rows = task.table.filter(F.col("date") > start)
        if rows.isEmpty():
            continue
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *date_bounds(rows))
        if task.incremental:
            # One partition per day makes a repeated or overlapping copy replace its days.
            days = rows.select(*task.index, *[c for c in rows.columns if c not in task.index])
            days.hint("rebalance", "date").sortWithinPartitions("date", *task.index).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic" if last else "static"
            ).partitionBy("date").parquet(task.path)
        else:
            publish(rows, task.path, task.index)
        bounds = seen.get
        if task.searched:
            refresh_index(spark.read.parquet(task.path), f"{task.path}_tokens", task.index[0], task.searched)
        ledger_append(spark, ledger, None, task.name, task.path, bounds["min_date"], bounds["max_date"])
        done.append(task.name)
    return done


def day_fingerprints(df: DataFrame, by: str = "date") -> DataFrame:
    """(day, rows, xor, total): an order-free fingerprint of each day's rows; equal rows count as often as they occur."""
    columns = sorted(df.columns)
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    # a decimal sum doesn't overflow, and unlike the xor it sees pairs of equal rows
    return df.groupBy(F.col(by).cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(first).alias("xor"), F.sum(second.cast("decimal(20,0)")).cast("string").alias("total")
    )


def publish_changed(table: DataFrame, path: str, index: Sequence[str]) -> list[str]:
    """Make the copy at `path`, one folder per `date`, equal to `table` by writing only the days that differ; returns those days.

    The fingerprints of the last copy lie beside it (`<path>_days`). Days are copied first and their fingerprints recorded last, so a run that
    dies is made up for by the next one. Days that the table no longer has are removed. Rows without a date are a day of their own. A change
    of columns changes all days. `table` is read twice: all rows for the fingerprints, the changed days for the copy.
    """
    spark = table.sparkSession
    columns = F.lit(",".join(f"{n}:{t}" for n, t in sorted(table.dtypes)))
    found = scratch_path(spark, "fingerprints")
    day_fingerprints(table).select(F.coalesce("day", F.lit("")).alias("day"), "rows", "xor", "total", columns.alias("columns")).write.parquet(found)
    new = spark.read.parquet(found)
    old = read_current(spark, f"{path}_days")
    if old is None:
        changed, gone = new, []
    else:
        changed = new.join(old, new.columns, "left_anti")
        gone = [r[0] for r in old.filter("rows > 0").join(new, "day", "left_anti").select("day").collect()]  # days, not rows
    days = sorted(r[0] for r in changed.select("day").collect())
    if days:
        name = F.coalesce(F.col("date").cast("string"), F.lit(""))
        rows = table.filter(name.isin(days)) if len(days) <= 1000 else table.join(changed.select("day"), name == F.col("day"), "left_semi")
        rows = rows.select(*index, *[c for c in table.columns if c not in index])
        rows.hint("rebalance", "date").sortWithinPartitions("date", *index).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("date").parquet(path)
    fs, at = manifest.file_system(spark, path)
    for day in gone:
        fs.delete(at(f"date={day or '__HIVE_DEFAULT_PARTITION__'}"), True)
    removed = spark.createDataFrame([(d, 0, 0, "0", "") for d in gone], new.schema)
    if days or gone:
        upsert(spark, f"{path}_days", changed.unionByName(removed), "day", buckets=1)
    return sorted([*days, *gone])
