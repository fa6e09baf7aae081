"""Counts of listed records and distinct products, per file and over all files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import parse_category_label, stats_product_key


def listing_stats(df: DataFrame, file: str = "file", top: int = 0) -> DataFrame:
    """Records and distinct products by level: total, category, subcategory; `file` null means all files.

    Rows are first counted down to one per (file, labels, product), so the six grouping levels expand that and not
    the raw rows. `top` keeps the first rows of each level and file (0 keeps all).
    """
    category, subcategory = parse_category_label("category")
    product = stats_product_key("product_url", "name")
    counted = (
        df.select(F.col(file).alias("file"), category.alias("category"), subcategory.alias("subcategory"),
                  product.alias("product"))
        .groupBy("file", "category", "subcategory", "product")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    f, c, s = F.col("file"), F.col("category"), F.col("subcategory")
    grouped = counted.groupingSets([[], [c], [c, s], [f], [f, c], [f, c, s]], f, c, s).agg(
        F.sum("n").alias("records"),
        F.count_distinct("product").alias("unique_products"),
        F.grouping_id().alias("_level"),
    )
    # Bits of the level: file, category, subcategory; set means "all".
    level = (
        F.when(F.col("_level").bitwiseAND(F.lit(3)) == 3, "total")
        .when(F.col("_level").bitwiseAND(F.lit(3)) == 1, "category")
        .otherwise("subcategory")
    )
    result = grouped.select(
        F.when(F.col("_level").bitwiseAND(F.lit(4)) == 0, "file").otherwise("overall").alias("scope"),
        level.alias("level"), "file", "category", "subcategory", "records", "unique_products",
    )
    if top <= 0:
        return result
    order = Window.partitionBy("scope", "level", "file").orderBy(F.col("records").desc(), "category", "subcategory")
    return result.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= top).drop("_row")
