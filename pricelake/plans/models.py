"""Whole builds: star schema, serving tables and reports, in memory or as stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.refs import price_details, ref_products
from pricelake.operators.reports import category_trends, monthly_products, price_report, top_movers, top_ytd
from pricelake.operators.star import SPINE_END, SPINE_START, build_fact, dim_category, dim_date, incremental_window, maintain_dim_product
from pricelake.sinks.tables import exists, overwrite_partitions, read_current, upsert, write_table


def build_star(stg: DataFrame, start: str = SPINE_START, end: str = SPINE_END) -> dict[str, DataFrame]:
    dates = dim_date(stg.sparkSession, start, end)
    products, categories = maintain_dim_product(stg), dim_category(stg)
    return {
        "dim_date": dates,
        "dim_product": products,
        "dim_category": categories,
        "fact_product_price_daily": build_fact(stg, dates),  # both dimensions come from the same rows
    }


def build_reports(star: dict[str, DataFrame], as_of: str, top_n: int = 5, top_k: int = 10) -> dict[str, DataFrame]:
    """Full builds of the serving tables and reports from the star tables."""
    fact, dates = star["fact_product_price_daily"], star["dim_date"]
    products, categories = star["dim_product"], star["dim_category"]
    refs = ref_products(fact, dates, categories, products)
    monthly = monthly_products(fact, dates, as_of)
    report = price_report(fact, products, as_of)
    return {
        "ref_products": refs,
        "ref_product_price_details": price_details(fact, dates),
        "monthly_products": monthly,
        "monthly_category_trends": category_trends(monthly),
        "monthly_product_top_movers": top_movers(monthly, as_of, top_n),
        "product_price_report": report,
        "product_price_report_top_ytd": top_ytd(report, refs, top_k),
    }


def refresh(
    spark: SparkSession,
    stg: DataFrame,
    root: str,
    as_of: str,
    full: bool = False,
    start: str = SPINE_START,
    end: str = SPINE_END,
    months: int = 3,
    days_back: int = 30,
    ref_days: int | None = None,
    detail_months: int | None = None,
) -> dict[str, DataFrame]:
    """Build or bring up to date all stored tables below `root`; each step reads the stored result of the last.

    Dimensions and keyed reports are merged, the fact and the price history are replaced by day, the monthly
    reports by month. After the first run only the overlap windows are read, so late rows are taken up: `days_back` days of
    staging, and the windows of the serving tables if they are given.
    """
    first = full or not exists(spark, f"{root}/fact_product_price_daily")
    recent = None if first else as_of

    def at(name: str) -> str:
        return f"{root}/{name}"

    def merge(name: str, rows: DataFrame, key: str) -> DataFrame:
        upsert(spark, at(name), rows, key, replace=first)
        return read_current(spark, at(name))

    write_table(dim_date(spark, start, end), at("dim_date"))
    dates = spark.read.parquet(at("dim_date"))
    known = None if first else read_current(spark, at("dim_product"))
    products = merge("dim_product", maintain_dim_product(stg, known, days_back), "product_nk")
    stored = None if first else spark.read.parquet(at("fact_product_price_daily"))
    recent_rows = incremental_window(stg, stored, "fact_date", days_back)
    categories = merge("dim_category", dim_category(recent_rows), "category_nk")

    # The dimensions hold all rows of the same window by now.
    rows = build_fact(stg, dates, current=stored, days_back=days_back)
    _replace(rows, at("fact_product_price_daily"), "fact_date", first, ("product_key", "category_key"))
    fact = spark.read.parquet(at("fact_product_price_daily"))

    window = {} if ref_days is None else {"days": ref_days}
    refs = merge("ref_products", ref_products(fact, None, categories, products, recent, **window), "id")
    window = {} if detail_months is None else {"months": detail_months}
    details = price_details(fact, None, recent, **window)
    _replace(details, at("ref_product_price_details"), "date", first, ("id",))

    monthly = monthly_products(fact, None, as_of, only_current=not first)
    _replace(monthly, at("monthly_products"), "year_month_period", first, ("product_key",))
    monthly = spark.read.parquet(at("monthly_products"))
    trends = category_trends(monthly, recent, months)
    _replace(trends, at("monthly_category_trends"), "year_month_period", first, ("category_key",))
    movers = top_movers(monthly, as_of, months=None if first else months)
    _replace(movers, at("monthly_product_top_movers"), "year_month_period", first, ("direction",))

    report = merge("product_price_report", price_report(fact, products, as_of), "product_key")
    write_table(top_ytd(report, refs), at("product_price_report_top_ytd"))

    tables = {name: spark.read.parquet(at(name)) for name in (
        "ref_product_price_details", "monthly_category_trends", "monthly_product_top_movers",
        "product_price_report_top_ytd",
    )}
    tables.update(
        dim_date=dates, dim_product=products, dim_category=categories, fact_product_price_daily=fact,
        ref_products=refs, monthly_products=monthly, product_price_report=report,
    )
    return tables


def _replace(df: DataFrame, path: str, by: str, whole: bool, cluster: tuple[str, ...]) -> None:
    if whole:
        df.hint("rebalance", by).sortWithinPartitions(by, *cluster).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(by).parquet(path)
    else:
        overwrite_partitions(df, path, by, cluster)
