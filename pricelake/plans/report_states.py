"""Reports kept as mergeable states: a batch of fact rows updates its months without reading older rows.

Three states lie below one root, split into cells, one per month and hash of the product:

* ``months``: per (month, product, category) the first and last day, and the prices of the first and last arrival. Taking the first or last of
  two is the same in any order and any number of times, so late, repeated and unordered batches give what a full build gives.
* ``trends``: per (month, category) of a cell the count, mean and sum of squared differences of each measure, merged pairwise over cells.
* ``movers``: the rows of a cell whose variation is among its ``n`` highest or lowest values; the months' movers are among them.

A batch reads and writes the cells that its rows fall into and no others. One manifest, created last, makes all three states current at once: a run that
dies changes nothing, and its batch can simply be given again. States only grow: a fact row that is withdrawn or rewritten needs ``replace`` of
its months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.functions import clip, variation_pct
from pricelake.operators.refs import arrival, dated
from pricelake.operators.reports import top_movers
from pricelake.session import scratch_path
from pricelake.sinks import manifest

KEYS = ["year_month_period", "product_key", "category_key"]
PRICES = ["price", "original_price"]
MEASURES = {"price": "price_variation_percent", "orig_price": "orig_price_variation_percent"}
STATES = ("months", "trends", "movers")


def month_states(fact: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """The state of one batch of fact rows, one row per month, product and category."""
    number = "dedup_id" if "dedup_id" in fact.columns else None
    rows = dated(fact, dates).withColumns({"year_month_period": F.trunc("date", "month"), "_arrival": arrival("date", number)})
    ends = {"first": F.min_by, "last": F.max_by}
    return rows.groupBy(*KEYS).agg(
        F.min("_arrival").alias("first_arrival"), F.max("_arrival").alias("last_arrival"),
        F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"),
        *[pick(p, "_arrival").alias(f"{end}_{p}") for end, pick in ends.items() for p in PRICES],
    )


def merge_months(states: DataFrame) -> DataFrame:
    """One row per key out of any number of states."""
    ends = {"first": F.min_by, "last": F.max_by}
    return states.groupBy(*KEYS).agg(
        F.min("first_arrival").alias("first_arrival"), F.max("last_arrival").alias("last_arrival"),
        F.min("earliest_date").alias("earliest_date"), F.max("latest_date").alias("latest_date"),
        *[pick(f"{end}_{p}", f"{end}_arrival").alias(f"{end}_{p}") for end, pick in ends.items() for p in PRICES],
    )


def monthly_report(months: DataFrame, as_of: str) -> DataFrame:
    """The columns of ``reports.monthly_products``."""
    columns = [*map(F.col, KEYS), F.lit(str(as_of)).cast("date").alias("processing_date"), F.col("earliest_date"), F.col("latest_date")]
    for price, label in zip(PRICES, ("price", "orig_price"), strict=True):
        first, last = F.col(f"first_{price}"), F.col(f"last_{price}")
        columns += [
            first.alias(f"earliest_{label}"), last.alias(f"latest_{label}"), (last - first).alias(f"{label}_variation_abs"),
            variation_pct(last, first).alias(f"{label}_variation_percent"),
        ]
    return months.select(*columns)


def trend_states(monthly: DataFrame) -> DataFrame:
    """Per cell, month and category: rows, and per measure (n, mean, m2) plain and clipped."""
    stats = [F.count(F.lit(1)).alias("product_count")]
    for name, column in MEASURES.items():
        n = F.count(column)
        stats += [
            F.struct(n.alias("n"), F.avg(column).alias("mean"), (F.var_pop(column) * n).alias("m2")).alias(name),
            F.avg(clip(column, -1.0, 1.0)).alias(f"clipped_{name}"),
        ]
    return monthly.groupBy("cell", "year_month_period", "category_key").agg(*stats)


def trends_report(trends: DataFrame) -> DataFrame:
    """The columns of ``reports.category_trends``. A month and category has a state per cell, so the lists are as short as a month has cells."""
    fields = ["cell", "product_count", *MEASURES, *(f"clipped_{m}" for m in MEASURES)]
    held = trends.groupBy("year_month_period", "category_key").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("states"))
    columns = [F.col("year_month_period"), F.col("category_key"), _total(F.col("states.product_count")).alias("product_count")]
    for name in MEASURES:
        merged = F.reduce(F.col(f"states.{name}"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")), _merged)
        clipped = F.transform("states", _clipped_sum(name))
        n = merged["n"]
        columns += [
            F.when(n > 0, merged["mean"]).alias(f"avg_{name}_var_pct"),
            F.when(n > 1, F.sqrt(F.try_divide(merged["m2"], n - 1))).alias(f"stdev_{name}_var_pct"),
            F.try_divide(F.reduce(clipped, F.lit(0.0), lambda x, y: x + y), n).alias(f"avg_clipped_{name}_var_pct"),
        ]
    return held.select(*columns)


def _clipped_sum(name: str):
    return lambda state: F.coalesce(state[f"clipped_{name}"] * state[name]["n"], F.lit(0.0))


def _total(values: Column) -> Column:
    return F.reduce(values, F.lit(0).cast("long"), lambda x, y: x + y)


def _merged(x: Column, y: Column) -> Column:
    """Count, mean and sum of squared differences of two disjoint sets of values."""
    n = x["n"] + y["n"]
    delta = y["mean"] - x["mean"]
    both = F.struct(
        n.alias("n"),
        (x["mean"] + delta * F.try_divide(y["n"], n)).alias("mean"),
        (x["m2"] + y["m2"] + delta * delta * F.try_divide(x["n"] * y["n"], n)).alias("m2"),
    )
    return F.when(y["n"] == 0, x).otherwise(both)


def mover_states(monthly: DataFrame, n: int) -> DataFrame:
    """The rows of each cell that can be among the ``n`` highest or lowest values of their month; all ties are kept."""
    rows = monthly.select("cell", *KEYS, "price_variation_percent")
    value = F.col("price_variation_percent")
    values = rows.select("cell", value).distinct()

    def ends(order: Column) -> DataFrame:
        ranked = values.withColumn("_rank", F.row_number().over(Window.partitionBy("cell").orderBy(order)))
        return ranked.filter(F.col("_rank") <= n).select(F.col("cell").alias("_cell"), value.alias("_value"))

    most = ends(value.desc_nulls_last()).union(ends(value.asc_nulls_first())).distinct()
    return rows.join(most, (F.col("cell") == F.col("_cell")) & value.eqNullSafe(F.col("_value")), "left_semi")


def read_state(spark: SparkSession, root: str, state: str, cells: list[str] | None = None) -> DataFrame | None:
    """The current state, or its ``cells`` only; None where there is none."""
    return _read(spark, root, state, manifest.latest(spark, root)[1], cells)


def _read(spark: SparkSession, root: str, state: str, content: dict | None, cells: list[str] | None) -> DataFrame | None:
    parts = content["parts"] if content else {}
    versions: dict[str, list[str]] = {}
    for cell in parts if cells is None else [c for c in cells if c in parts]:
        versions.setdefault(parts[cell][0], []).append(cell)
    tables = [
        spark.read.option("basePath", f"{root}/{v}/{state}").parquet(*(f"{root}/{v}/{state}/cell={c}" for c in sorted(some)))
        for v, some in sorted(versions.items())
    ]
    if not tables:
        return None
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def apply_batch(
    spark: SparkSession, root: str, fact: DataFrame, as_of: str, dates: DataFrame | None = None,
    replace: bool = False, n: int = 5, split: int = 8, keep: int = 2,
) -> list[str]:
    """Take up a batch of fact rows; returns the cells that were written.

    ``replace`` forgets what was known of the batch's months. ``split`` (cells a month is split into) and ``n`` (movers) are fixed when the states are
    first written.
    """
    number, content = manifest.latest(spark, root)
    content = content or {"parts": {}, "split": split, "movers": n}
    folder = manifest.new_folder(number)
    month = F.coalesce(F.date_format("year_month_period", "yyyy-MM"), F.lit("none"))
    cell = F.concat(month, F.lit("_"), F.pmod(F.xxhash64("product_key"), F.lit(content["split"])).cast("string"))
    batch = scratch_path(spark, "batch")
    month_states(fact, dates).withColumn("cell", cell).write.parquet(batch)
    batch = spark.read.parquet(batch)
    cells = sorted(r[0] for r in batch.select("cell").distinct().collect())  # months times `split` at most
    if not cells:
        return []
    old = None if replace else _read(spark, root, "months", content, cells)
    states = batch if old is None else batch.unionByName(old)
    merged = merge_months(states).withColumn("cell", cell)
    _write(merged, f"{root}/{folder}/months", *KEYS[1:])
    monthly = monthly_report(spark.read.parquet(f"{root}/{folder}/months"), as_of).withColumn("cell", cell)
    _write(trend_states(monthly), f"{root}/{folder}/trends", "category_key")
    _write(mover_states(monthly, content["movers"]), f"{root}/{folder}/movers", "product_key")
    months = {c.rsplit("_", 1)[0] for c in cells} if replace else set()
    parts = {c: f for c, f in content["parts"].items() if c.rsplit("_", 1)[0] not in months}
    manifest.commit(spark, root, number, content | {"parts": parts | {c: [folder] for c in cells}})
    manifest.clean(spark, root, keep)
    return cells


def _write(df: DataFrame, path: str, *cluster: str) -> None:
    df.hint("rebalance", "cell").sortWithinPartitions("cell", *cluster).write.partitionBy("cell").parquet(path)


def reports(spark: SparkSession, root: str, as_of: str) -> dict[str, DataFrame]:
    """The three reports out of the current states, under the names of ``models.build_reports``."""
    _, content = manifest.latest(spark, root)
    months, trends, movers = (_read(spark, root, s, content, None) for s in STATES)
    if months is None:
        return {}
    return {
        "monthly_products": monthly_report(months, as_of),
        "monthly_category_trends": trends_report(trends),
        "monthly_product_top_movers": top_movers(movers, as_of, content["movers"]),
    }
