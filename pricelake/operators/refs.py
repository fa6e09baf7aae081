"""Serving tables: current products and their price history with moving averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import since


def dated(fact: DataFrame, dates: DataFrame | None = None, how: str = "left") -> DataFrame:
    """The fact with a `date` column: looked up in the calendar, or taken from `fact_date`."""
    if dates is None:
        return fact.withColumn("date", F.col("fact_date"))
    # Bounded broadcast: one row per calendar day.
    return fact.join(F.broadcast(dates.select("date_key", "date")), "date_key", how)


def arrival(date: str = "date", number: str | None = "dedup_id") -> Column:
    """(date, dedup_id) as one long, so that ordered picks stay hash aggregates."""
    days = F.unix_date(date).cast("long") * F.lit(2**32)
    return days + F.coalesce(F.col(number), F.lit(0)) if number else days


def ref_products(
    fact: DataFrame,
    dates: DataFrame | None,
    categories: DataFrame,
    products: DataFrame,
    as_of: str | None = None,
    days: int = 120,
) -> DataFrame:
    """One row per product: its labels, sorted and joined with " | ", and the latest price.

    On the latest day the highest dedup_id, then the highest category_key decides.
    """
    number = "dedup_id" if "dedup_id" in fact.columns else None
    rows = dated(_recent(fact, as_of, days), dates, "inner")
    if as_of is not None:
        rows = rows.filter(since("date", as_of, days))
    per_category = (
        rows.withColumn("_arrival", arrival("date", number))
        .groupBy("product_key", "category_key")
        .agg(F.max("_arrival").alias("_arrival"), F.max_by("price", "_arrival").alias("price"))
    )
    labelled = per_category.join(
        categories.select("category_key", "category", "subcategory").dropna(), "category_key"
    )
    joined = {
        "categories": F.array_join(F.array_sort(F.collect_set("category")), " | "),
        "subcategories": F.array_join(F.array_sort(F.collect_set("subcategory")), " | "),
        "price": F.max_by("price", F.struct("_arrival", "category_key")),
    }
    return (
        labelled.groupBy("product_key")
        .agg(*[c.alias(name) for name, c in joined.items()])
        .join(products.select("product_key", "name", "size", "image_url"), "product_key", "left")
        .select(
            F.col("product_key").alias("id"), "name", "size", "categories", "subcategories", "price", "image_url"
        )
    )


def dedup_daily(df: DataFrame, key: str = "id", date: str = "date", price: str = "price") -> DataFrame:
    """One price per day and product: the lowest. Counted down before the shuffle, whatever the copies."""
    return df.groupBy(key, date).agg(F.min(price).alias(price))


def moving_averages(
    daily: DataFrame, days: Sequence[int] = (7, 15, 30), as_of: str | None = None, months: int = 6
) -> DataFrame:
    """`sma<n>` over the last n calendar days, today included; absent days shorten the sample.

    `daily` holds one row per (id, date), so a window group is bounded by the calendar. With `as_of` only the last
    `months` come out, after a warm-up of the longest window, so that the first averages are whole.
    """
    if as_of is not None:
        start = F.add_months(F.lit(str(as_of)).cast("date"), -months)
        daily = daily.filter(F.col("date") >= F.date_sub(start, max(days) - 1))
    history = Window.partitionBy("id").orderBy(F.unix_date("date"))
    averages = {f"sma{n}": F.avg("price").over(history.rangeBetween(-(n - 1), 0)) for n in days}
    result = daily.select("date", "id", "price", *[c.alias(name) for name, c in averages.items()])
    return result if as_of is None else result.filter(F.col("date") >= start)


def price_details(
    fact: DataFrame, dates: DataFrame | None = None, as_of: str | None = None, months: int = 6
) -> DataFrame:
    """Price history per product and day with its moving averages."""
    rows = fact
    if as_of is not None and "fact_date" in fact.columns:
        warm_up = F.date_sub(F.add_months(F.lit(str(as_of)).cast("date"), -months), 29)
        rows = fact.filter(F.col("fact_date") >= warm_up)
    rows = dated(rows, dates).select("date", F.col("product_key").alias("id"), "price")
    return moving_averages(dedup_daily(rows), as_of=as_of, months=months)


def _recent(fact: DataFrame, as_of: str | None, days: int) -> DataFrame:
    """Filter on the partition column itself, so that whole days are pruned."""
    if as_of is None or "fact_date" not in fact.columns:
        return fact
    return fact.filter(since("fact_date", as_of, days))
