"""Reports: months, category trends, top movers, to-date comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import clip, direction, month_window, period_starts, since, variation_pct
from pricelake.operators.refs import arrival, dated


def monthly_products(
    fact: DataFrame, dates: DataFrame | None, as_of: str, only_current: bool = False
) -> DataFrame:
    """First and last price of each (month, product, category) and their variation.

    On one day the lowest dedup_id counts as the first and the highest as the last. `only_current` reads the month
    of `as_of` alone.
    """
    rows = fact
    if only_current and "fact_date" in fact.columns:
        rows = rows.filter(month_window("fact_date", as_of))
    rows = dated(rows, dates)
    if only_current:
        rows = rows.filter(month_window("date", as_of))
    number = "dedup_id" if "dedup_id" in fact.columns else None
    ends = (
        rows.withColumns({"year_month_period": F.trunc("date", "month"), "_arrival": arrival("date", number)})
        .groupBy("year_month_period", "product_key", "category_key")
        .agg(
            F.min("date").alias("earliest_date"),
            F.max("date").alias("latest_date"),
            F.min_by("price", "_arrival").alias("earliest_price"),
            F.max_by("price", "_arrival").alias("latest_price"),
            F.min_by("original_price", "_arrival").alias("earliest_orig_price"),
            F.max_by("original_price", "_arrival").alias("latest_orig_price"),
        )
    )
    return ends.select(
        "year_month_period", "product_key", "category_key",
        F.lit(str(as_of)).cast("date").alias("processing_date"),
        "earliest_date", "latest_date",
        "earliest_price", "latest_price",
        (F.col("latest_price") - F.col("earliest_price")).alias("price_variation_abs"),
        variation_pct("latest_price", "earliest_price").alias("price_variation_percent"),
        "earliest_orig_price", "latest_orig_price",
        (F.col("latest_orig_price") - F.col("earliest_orig_price")).alias("orig_price_variation_abs"),
        variation_pct("latest_orig_price", "earliest_orig_price").alias("orig_price_variation_percent"),
    )


def category_trends(monthly: DataFrame, as_of: str | None = None, months: int = 3) -> DataFrame:
    """Mean, spread and outlier-limited mean of the variations per (month, category)."""
    if as_of is not None:
        monthly = monthly.filter(since("year_month_period", as_of, months, "month", truncate=True))
    stats = [F.count(F.lit(1)).alias("product_count")]
    for name, column in (("price", "price_variation_percent"), ("orig_price", "orig_price_variation_percent")):
        stats += [
            F.avg(column).alias(f"avg_{name}_var_pct"),
            F.stddev_samp(column).alias(f"stdev_{name}_var_pct"),
            F.avg(clip(column, -1.0, 1.0)).alias(f"avg_clipped_{name}_var_pct"),
        ]
    return monthly.groupBy("year_month_period", "category_key").agg(*stats)


def top_movers(
    monthly: DataFrame, as_of: str, n: int = 5, drop_null: bool = False, months: int | None = None
) -> DataFrame:
    """Rows whose variation is among the `n` highest or lowest values of their month; all ties are kept.

    Ranks are taken over the distinct values of a month, never over its rows: the rank table holds 2n rows per
    month, so any number of tied rows is found by a broadcast join without gathering them.
    """
    value = F.col("price_variation_percent")
    rows = monthly.select("year_month_period", "product_key", "category_key", "price_variation_percent")
    if months is not None:
        rows = rows.filter(since("year_month_period", as_of, months, "month", truncate=True))
    if drop_null:
        rows = rows.filter(value.isNotNull())
    values = rows.select("year_month_period", "price_variation_percent").distinct()
    month = Window.partitionBy("year_month_period")

    def ranked(label: str, order) -> DataFrame:
        return (
            values.withColumn("rank", F.row_number().over(month.orderBy(order)))
            .filter(F.col("rank") <= n)
            .select(
                F.col("year_month_period").alias("_month"),
                F.col("price_variation_percent").alias("_value"),
                F.lit(label).alias("direction"),
                "rank",
            )
        )

    ranks = ranked("increase", value.desc_nulls_last()).unionByName(ranked("decrease", value.asc_nulls_first()))
    hit = (F.col("year_month_period") == F.col("_month")) & value.eqNullSafe(F.col("_value"))
    return rows.join(F.broadcast(ranks), hit).select(
        *rows.columns, "direction", "rank", F.lit(str(as_of)).cast("date").alias("processing_date")
    )


def latest_per_key(df: DataFrame, key: str, date: str, values: list[str]) -> DataFrame:
    """The newest row per key; (key, date) must be unique."""
    return df.groupBy(key).agg(F.max(date).alias(date), *[F.max_by(v, date).alias(v) for v in values])


def price_report(fact: DataFrame, products: DataFrame, as_of: str, scan_days: int = 366) -> DataFrame:
    """Latest price per product against its price on the first day of the month, 3 and 6 months, and the year.

    A product without a price on just that day has no comparison. All anchors are first days of a month, so one
    aggregate keeps those few prices in a map (at most 13 for 366 days) and no self-join is needed.
    """
    daily = (
        fact.filter(since("fact_date", as_of, scan_days))
        .groupBy("fact_date", "product_key")
        .agg(F.min("price").alias("price"))
    )
    first_days = F.collect_list(F.when(F.dayofmonth("fact_date") == 1, F.struct("fact_date", "price")))
    src = daily.groupBy("product_key").agg(
        F.max("fact_date").alias("latest_date"),
        F.max_by("price", "fact_date").alias("latest_price"),
        F.map_from_entries(first_days).alias("_first_days"),
    )
    columns = [F.col("product_key"), F.col("name"), F.col("size"), F.col("latest_date"), F.col("latest_price")]
    for period, start in period_starts("latest_date").items():
        price = F.try_element_at("_first_days", start)
        change = F.col("latest_price") - price
        columns += [
            start.alias(f"{period}_start_date"),
            price.alias(f"{period}_price"),
            change.alias(f"{period}_price_var_abs"),
            F.try_divide(change, price).alias(f"{period}_price_var_pct"),
        ]
    return src.join(products.select("product_key", "name", "size"), "product_key").select(*columns)


def top_ytd(report: DataFrame, ref_products: DataFrame, k: int = 10) -> DataFrame:
    """The `k` products of the newest day that moved most since the start of the year."""
    newest = report.select(F.max("latest_date")).scalar()
    pct, change = F.col("ytd_price_var_pct"), F.col("ytd_price_var_abs")
    labels = ref_products.select(F.col("id").alias("product_key"), "categories", "subcategories")
    return (
        report.filter(pct.isNotNull() & (F.col("latest_date") == newest))
        .join(labels, "product_key")
        .orderBy(F.abs(pct).desc(), F.abs(change).desc(), F.col("latest_date").desc(), F.col("product_key"))
        .limit(k)
        .select(
            "product_key", "name", "size", "categories", "subcategories", "latest_date", "latest_price",
            "ytd_start_date", "ytd_price", "ytd_price_var_abs", "ytd_price_var_pct",
            direction(pct).alias("direction"),
        )
    )
