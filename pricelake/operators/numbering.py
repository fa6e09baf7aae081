"""Duplicate numbers: 1, 2, 3 ... within a group, exact and safe for groups of any size.

A plain `row_number` sorts a whole group in one task. Here that is done only for groups that fit one task: their rows are shuffled once, by group.
The copies of larger groups are counted before the shuffle, and their rows are range partitioned by group and sort tuple; a row's number is its number
inside its range plus the rows of its group in earlier ranges, a prefix sum over one row per group and range. Such copies are written out last, after their numbers are known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.session import scratch_path

HOT_GROUP_ROWS = 1_000_000
SAMPLE_RATE = 256


def number_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "dedup_id",
    hot_rows: int = HOT_GROUP_ROWS,
    drop_copies: bool = False,
) -> DataFrame:
    """Add `out` = 1..n within each `keys` group: by `order` (nulls first), then by the other columns.

    Copies of a row get numbers of their own, or are dropped with `drop_copies`.

    Text outside `keys` sorts by its digest, so that a group of any make-up can be cut evenly.
    Groups of more than `hot_rows` rows are cut into ranges; the result is the same on both ways. The rows (with `drop_copies` the distinct
    ones) are written to the scratch folder first: all later steps read them, and with no large group what is left is one window.
    """
    columns = df.columns
    types = dict(df.dtypes)
    values = [*order, *[c for c in columns if c not in keys and c not in order]]
    texts = [c for c in values if types[c] == "string"]
    numbers = [c for c in values if types[c] != "string"]
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in texts])) if texts else F.lit("")
    # Structs compare field by field, nulls first: one value stands for the whole order.
    place = F.struct(*numbers, digest.alias("_digest"), *texts)

    # Rows that all differ would only fill the memory of a count before the shuffle, so copies are counted in large groups alone.
    rows = stored(df.distinct() if drop_copies else df, "rows-to-number")
    hot = stored(_hot_groups(rows, keys, hot_rows).coalesce(1), "hot-groups")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(place))
    if hot.isEmpty():
        return rows.withColumn(out, number)

    plain = rows.join(hot, _same(rows, hot, keys), "left_anti").withColumn(out, number)
    large = rows.join(hot, _same(rows, hot, keys), "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    large = stored(large, "distinct-rows")
    ranges = max(2, -(-large.count() // hot_rows))
    large = large.repartitionByRange(ranges, *keys, place).withColumn("_range", F.spark_partition_id())
    large = stored(large, "ranges")  # the cuts are sampled: written, they are the same for the sums and the rows
    before = _rows_before(large, keys)
    large = large.withColumn("_in_range", _running([*keys, "_range"], place))
    at_range = _same(large, before, keys, "_at_") & (large["_range"] == before["_at_range"])
    large = large.join(before, at_range).withColumn("_end", F.col("_in_range") + F.col("_before"))
    # A great many copies of one row travel as blocks, so that no single task writes them all.
    first = F.col("_end") - F.col("_n")
    large = large.withColumn("_first", F.explode(F.sequence(first + 1, "_end", F.lit(hot_rows).cast("long"))))
    large = large.withColumn("_end", F.least(F.col("_first") + F.lit(hot_rows - 1), "_end")).repartition(*keys, "_first")
    return plain.unionByName(_written_out(large, columns, out))


def _written_out(numbered: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    number = F.explode(F.sequence(F.col("_first").cast("int"), F.col("_end").cast("int")))
    return numbered.select(*columns, number.alias(out))


def _running(keys: Sequence[str], place: Column) -> Column:
    """Rows of a group up to each distinct row, its copies included."""
    return F.sum("_n").over(Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hot_groups(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Groups that may be too large for one task: at most about one for `hot_rows` rows of the table.

    They are found on a sample of the rows, copies included. The list doesn't change a number, only the way to it.
    """
    rate = min(SAMPLE_RATE, max(1, hot_rows // 1000))
    sampled = rows if rate == 1 else rows.filter(F.rand(42) * rate < 1)
    groups = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_seen"))
    hot = groups.filter(F.col("_seen") * rate > hot_rows)
    return hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])


def _rows_before(large: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each large group before each of its ranges, over one row per group and range."""
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = large.groupBy(*keys, "_range").agg(F.sum("_n").alias("_size"))
    return sizes.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys],
        F.col("_range").alias("_at_range"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "_hot_") -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return condition
