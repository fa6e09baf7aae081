"""Product search: token index, prefix search, substring search, paging, nested detail."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.functions import since, tokens

SEARCHED = ("name", "size", "categories", "subcategories")


def build_search_index(products: DataFrame, id_col: str = "id", cols: Sequence[str] = SEARCHED) -> DataFrame:
    """(token, id) pairs, each once. `id_col` is unique, so a row's own tokens need no shuffle to be distinct."""
    text = F.concat_ws(" ", id_col, *cols)
    return products.select(F.explode(tokens(text)).alias("token"), F.col(id_col).alias("id"))


def query_tokens(spark: SparkSession, term: str) -> list[str]:
    """The search words of a term, in order, folded by the expression that folds the products."""
    if not term or not term.strip():
        raise ValueError("empty search term")
    words = spark.range(1).select(tokens(F.lit(term)).alias("words")).first()["words"]
    if not words:
        raise ValueError(f"nothing to search for in {term!r}")
    return words


def search_fts(index: DataFrame, products: DataFrame, term: str, id_col: str = "id") -> DataFrame:
    """Products that have every word of `term`; the last word also matches as a prefix."""
    *whole, last = query_tokens(index.sparkSession, term)
    token = F.col("token")
    tests = [token == w for w in dict.fromkeys(whole)] + [token.startswith(last)]
    wanted = tests[0]
    for test in tests[1:]:
        wanted = wanted | test
    hits = index.filter(wanted)
    if len(tests) > 1:
        every = F.lit(True)
        for i in range(len(tests)):
            every = every & F.col(f"_{i}")
        hits = hits.groupBy("id").agg(*[F.max(t).alias(f"_{i}") for i, t in enumerate(tests)]).filter(every)
    return products.join(hits.select(F.col("id").alias(id_col)), id_col, "left_semi")


def search_substring(df: DataFrame, term: str, cols: Sequence[str] = SEARCHED) -> DataFrame:
    """Rows with `term`, read literally and without case, in any of the columns."""
    if not term or not term.strip():
        raise ValueError("empty search term")
    found = F.lit(False)
    for c in cols:
        found = found | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(term.lower())), F.lit(False))
    return df.filter(found)


def page(df: DataFrame, limit: int = 20, offset: int = 0, order: str = "id") -> DataFrame:
    """One page in `order`, with `total_count` and `has_more`. The total is a count of its own, not a window.

    All `offset + limit` rows go through one task; for deep pages use `page_after`.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    if offset < 0:
        raise ValueError("offset must not be negative")
    total = df.select(F.count(F.lit(1))).scalar()
    return (
        df.orderBy(order)
        .offset(offset)
        .limit(limit)
        .withColumn("total_count", total)
        .withColumn("has_more", F.lit(offset + limit) < F.col("total_count"))
    )


def page_after(df: DataFrame, last: object = None, limit: int = 20, order: str = "id") -> DataFrame:
    """The page after the row whose `order` is `last` (None: the first page), with `total_count` and `has_more`.

    Reads one page however deep it lies; `order` is unique.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    rest = df if last is None else df.filter(F.col(order) > F.lit(last))
    # One row more than the page tells whether there is more.
    rows = rest.orderBy(order).limit(limit + 1)
    numbered = rows.withColumn("_n", F.row_number().over(Window.orderBy(order)))
    more = F.max("_n").over(Window.partitionBy()) > limit
    total = df.select(F.count(F.lit(1))).scalar()
    return numbered.withColumns({"total_count": total, "has_more": more}).filter(F.col("_n") <= limit).drop("_n")


def product_detail(
    products: DataFrame, details: DataFrame, ids: Iterable[str] | None, as_of: str, months: int = 6
) -> DataFrame:
    """Products with their last `months` of daily prices nested in `price_details`, by date.

    One row per product and day goes in, so a list is bounded by the calendar. Products without recent prices are
    left out; `ids=None` means all of them.
    """
    recent = details.filter(since("date", as_of, months, "month"))
    if ids is not None:
        ids = list(ids)
        recent = recent.filter(F.col("id").isin(ids))
        products = products.filter(F.col("id").isin(ids))
    nested = recent.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("date", "price", "sma7", "sma15", "sma30"))).alias("price_details")
    )
    return products.join(nested, "id").select(
        "id", "name", "size", "categories", "subcategories",
        F.col("price").alias("current_price"), "image_url", "price_details",
    )
