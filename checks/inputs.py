"""Price observations derived from the given tables, in Spark and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-11-04"
CUTOFF = "2001-06-01"
EVENTS_AS_OF = "2024-01-30"
CALENDAR = ("1995-01-01", "2002-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed price observation per line item."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    return (
        lines.withColumn("original_price", F.expr("floor(l_extendedprice / l_quantity * 100) / 100.0D"))
        .withColumn("noun", F.split("p_name", " ")[1])
        .selectExpr(
            "to_date(l_shipdate) AS date",
            "concat(p_brand, ' ', noun) AS name",
            "p_type AS size",
            "noun AS category",
            "CASE l_returnflag WHEN 'A' THEN 'fresh' WHEN 'N' THEN 'frozen' ELSE 'pantry' END AS subcategory",
            "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN concat('ftp://img.example.com/', l_partkey)"
            " ELSE concat('https://img.example.com/', l_partkey, '.jpg?w=300') END AS image_url",
            "original_price",
            "CASE WHEN l_discount > 0 THEN floor(original_price * (1 - l_discount) * 100) / 100.0D END AS discount_price",
            "floor(original_price / p_size * 100) / 100.0D AS price_per_unit",
            "CASE p_size % 3 WHEN 0 THEN 'Kg' WHEN 1 THEN 'ud' ELSE 'L' END AS unit",
            "l_orderkey",
            "l_linenumber",
        )
    )


OBS = """
priced AS (
  SELECT *, floor(l_extendedprice / l_quantity * 100) / 100.0::DOUBLE AS original_price, split_part(p_name, ' ', 2) AS noun
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
obs AS (
  SELECT l_shipdate::DATE AS date,
    p_brand || ' ' || noun AS name,
    p_type AS size,
    noun AS category,
    CASE l_returnflag WHEN 'A' THEN 'fresh' WHEN 'N' THEN 'frozen' ELSE 'pantry' END AS subcategory,
    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'ftp://img.example.com/' || l_partkey
         ELSE 'https://img.example.com/' || l_partkey || '.jpg?w=300' END AS image_url,
    original_price,
    CASE WHEN l_discount > 0 THEN floor(original_price * (1 - l_discount) * 100) / 100.0::DOUBLE END AS discount_price,
    floor(original_price / p_size * 100) / 100.0::DOUBLE AS price_per_unit,
    CASE p_size % 3 WHEN 0 THEN 'Kg' WHEN 1 THEN 'ud' ELSE 'L' END AS unit,
    l_orderkey, l_linenumber
  FROM priced
)"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as scraped text: accents, blanks, "12,34 €", category paths, gaps."""
    euro = "concat(replace(cast(cast({0} AS decimal(18,2)) AS string), '.', ','), ' €')"
    return obs(spark, sf_dir).selectExpr(
        "cast(date AS string) AS date",
        "concat(' Jamón  ', name, ' ') AS name",
        "concat(size, CASE WHEN l_linenumber = 3 THEN ' Ñ' ELSE '' END) AS size",
        "CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN category WHEN 5 THEN concat('Á', category, ' > ', subcategory, ' > Más')"
        " ELSE concat(category, ' > ', subcategory) END AS category",
        "image_url",
        euro.format("original_price") + " AS original_price",
        f"CASE WHEN l_linenumber = 4 THEN '€' ELSE {euro.format('discount_price')} END AS discount_price",
        f"CASE WHEN l_linenumber > 1 THEN concat({euro.format('price_per_unit')}, '/', unit) END AS price_per_unit",
        "CASE WHEN l_linenumber > 2 THEN concat('https://shop.example.com/', replace(name, ' ', '-')) END AS product_url",
    )


RAW = OBS + """,
raw AS (
  SELECT date::VARCHAR AS date,
    ' Jamón  ' || name || ' ' AS name,
    size || CASE WHEN l_linenumber = 3 THEN ' Ñ' ELSE '' END AS size,
    CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN category WHEN 5 THEN 'Á' || category || ' > ' || subcategory || ' > Más'
         ELSE category || ' > ' || subcategory END AS category,
    image_url,
    replace(original_price::DECIMAL(18,2)::VARCHAR, '.', ',') || ' €' AS original_price,
    CASE WHEN l_linenumber = 4 THEN '€' ELSE replace(discount_price::DECIMAL(18,2)::VARCHAR, '.', ',') || ' €' END AS discount_price,
    CASE WHEN l_linenumber > 1 THEN replace(price_per_unit::DECIMAL(18,2)::VARCHAR, '.', ',') || ' €/' || unit END AS price_per_unit,
    CASE WHEN l_linenumber > 2 THEN 'https://shop.example.com/' || replace(name, ' ', '-') END AS product_url
  FROM obs
)"""


def events_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from the event stream: 30 days, one product per user and event type."""
    return table(spark, sf_dir, "events").selectExpr(
        "to_date(ts) AS date",
        "cast(event_id AS int) AS dedup_id",
        "concat('user ', user_id) AS name",
        "event_type AS size",
        "'events' AS category",
        "event_type AS subcategory",
        "cast(NULL AS string) AS image_url",
        "value AS price",
        "value AS original_price",
        "cast(NULL AS double) AS discount_price",
        "cast(NULL AS double) AS price_per_unit",
        "cast(NULL AS string) AS unit",
    )


EVENTS_STG = """
events_stg AS (
  SELECT ts::DATE AS date, event_id::INTEGER AS dedup_id, 'user ' || user_id AS name, event_type AS size,
    'events' AS category, event_type AS subcategory, NULL::VARCHAR AS image_url, value AS price,
    value AS original_price, NULL::DOUBLE AS discount_price, NULL::DOUBLE AS price_per_unit, NULL::VARCHAR AS unit
  FROM events
)"""
STG_COLUMNS = "date, dedup_id, name, size, category, subcategory, image_url, price, original_price, discount_price, price_per_unit, unit"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("user_id AS id", "to_date(ts) AS date", "value AS price")
