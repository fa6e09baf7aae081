"""Star schema: calendar, category and product dimensions, daily price fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions import calendar_columns, discount_measures, surrogate_key, valid_url
from pricelake.sources.files import date_spine

# Default bounds of the calendar (the end is exclusive).
SPINE_START, SPINE_END = "2024-11-01", "2035-12-31"
LONG_AGO = "1900-01-01"

# The columns of the dimension.
DIM_PRODUCT = T.StructType(
    [
        T.StructField("product_key", T.StringType()),
        T.StructField("product_nk", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("first_seen_date", T.DateType()),
        T.StructField("last_seen_date", T.DateType()),
    ]
)


def dim_date(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per day from `start` up to, not including, `end`."""
    columns = calendar_columns("date")
    return date_spine(spark, start, end).select(*[c.alias(name) for name, c in columns.items()]).orderBy("date")


def dim_category(stg: DataFrame) -> DataFrame:
    pairs = stg.filter(F.col("category").isNotNull() | F.col("subcategory").isNotNull())
    pairs = pairs.select("category", "subcategory").distinct()
    key = surrogate_key("category", "subcategory")
    return pairs.select(key.alias("category_key"), key.alias("category_nk"), "category", "subcategory")


def incremental_window(
    df: DataFrame, target: DataFrame | None, seen: str, days: int, column: str = "date"
) -> DataFrame:
    """The rows dated within `days` before the newest `seen` date of `target`; all rows without a target."""
    if target is None:
        return df
    newest = target.select(F.coalesce(F.max(seen), F.lit(LONG_AGO).cast("date"))).scalar()
    return df.filter(F.col(column) >= F.date_sub(newest, days))


def maintain_dim_product(stg: DataFrame, current: DataFrame | None = None, days_back: int = 30) -> DataFrame:
    """Rows to upsert into the product dimension: newest image, first and last day seen.

    With `current` only the overlap window of `stg` is read, and the dates known so far are kept or widened.
    """
    rows = incremental_window(stg, current, "last_seen_date", days_back)
    # Step one leaves one row per product and image, so that the ordered pick below sees little.
    images = rows.groupBy("name", "size", "image_url").agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )
    newest = F.expr("max_by(image_url, struct(last, image_url)) FILTER (WHERE image_url IS NOT NULL)")
    incoming = (
        images.groupBy("name", "size")
        .agg(newest.alias("new_url"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("product_nk", surrogate_key("name", "size"))
    )
    if current is not None:
        known = current.select(
            "product_nk",
            F.col("image_url").alias("old_url"),
            F.col("first_seen_date").alias("old_first"),
            F.col("last_seen_date").alias("old_last"),
        )
        incoming = incoming.join(known, "product_nk", "left")
        url = F.coalesce("new_url", "old_url")
        first, last = F.least("old_first", "first"), F.greatest("old_last", "last")
    else:
        url, first, last = F.col("new_url"), F.col("first"), F.col("last")
    return incoming.select(
        surrogate_key("product_nk").alias("product_key"),
        "product_nk",
        "name",
        "size",
        valid_url(url).alias("image_url"),
        first.alias("first_seen_date"),
        last.alias("last_seen_date"),
    )


def apply_upserts(current: DataFrame | None, upserts: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """`current` with the rows of equal key replaced by `upserts` and the new keys added."""
    if current is None:
        return upserts
    keys = [key] if isinstance(key, str) else list(key)
    return current.join(upserts.select(*keys), keys, "left_anti").unionByName(upserts, allowMissingColumns=True)


def build_fact(
    stg: DataFrame,
    dates: DataFrame,
    products: DataFrame | None = None,
    categories: DataFrame | None = None,
    current: DataFrame | None = None,
    days_back: int = 30,
    load_ts: dt.datetime | None = None,
) -> DataFrame:
    """Daily price fact; rows that lack a dimension row drop out.

    The keys are hashes of the row itself. Without `products` and `categories`, as when both were built from `stg`, every row with
    a category has its dimension rows, so nothing is looked up and the rows are not shuffled. Dimensions that are given are
    semi-joined, which AQE broadcasts by measured size, or splits for a product that holds a large share. Only the calendar,
    one row per day, is broadcast by hint.
    """
    rows = incremental_window(stg, current, "fact_date", days_back)
    rows = rows.filter(F.col("category").isNotNull() | F.col("subcategory").isNotNull())
    rows = rows.withColumns(
        {"_product": surrogate_key("name", "size"), "category_key": surrogate_key("category", "subcategory")}
    )
    keys = F.broadcast(dates.select(F.col("date").alias("_day"), "date_key"))
    rows = rows.join(keys, F.col("date") == F.col("_day"))
    if categories is not None:
        rows = rows.join(categories.select("category_key"), "category_key", "left_semi")
    if products is not None:
        known = products.select(F.col("product_nk").alias("_nk"))
        rows = rows.join(known, F.col("_product") == F.col("_nk"), "left_semi")
    stamp = F.lit(load_ts) if load_ts else F.current_timestamp()
    return rows.select(
        "date_key", surrogate_key("_product").alias("product_key"), "category_key", "dedup_id", "price", "original_price",
        "discount_price", *[c.alias(name) for name, c in discount_measures().items()],
        F.col("date").alias("fact_date"),
        stamp.alias("load_ts"),
    )
