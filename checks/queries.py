"""Every operator over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from pricelake import functions as P
from pricelake.operators import clean, quality, refs, reports, search, star, stats
from pricelake.operators.numbering import number_duplicates
from pricelake.plans import incremental, models, report_states
from pricelake.session import scratch_path
from pricelake.sinks import ledger, tables
from pricelake.sinks import search_index as token_index
from pricelake.sources import files, listings
from pricelake.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql.strip()
        return f

    return register


_STORED: dict[tuple[str, str, str], str] = {}
#: Files of a stored input; None leaves it to Spark. The bench sets it, so that a scan has a task per core.
FILES: int | None = None


def stored(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table written once per application, as each model of the reference is a stored table."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        made = build()
        (made if FILES is None else made.repartition(FILES)).write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def rounded(df: DataFrame, *columns: str, digits: int = 10) -> DataFrame:
    """Averages depend on the order of addition in the last bits only."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --------------------------------------------------------------------------- cleaning

PRICE = "TRY_CAST(replace(replace(replace({0}, '€', ''), ',', '.'), ' ', '') AS DOUBLE)"
STRIP = "strip_accents(lower(trim({0})))"
COLLAPSE = "strip_accents(trim(lower(regexp_replace({0}, ' +', ' ', 'g'))))"
NUMBERED = (
    "row_number() OVER (PARTITION BY date, name, size, category, subcategory ORDER BY original_price NULLS FIRST, "
    "discount_price NULLS FIRST, price_per_unit NULLS FIRST, md5(coalesce(image_url, '') || '|' || coalesce(unit, '')), "
    "image_url NULLS FIRST, unit NULLS FIRST)::INTEGER"
)


@query("parse_price", f"WITH {I.RAW} SELECT original_price AS text, {PRICE.format('original_price')} AS original_price, "
                      f"{PRICE.format('discount_price')} AS discount_price FROM raw")
def parse_price(spark, sf):
    return I.raw(spark, sf).select(
        F.col("original_price").alias("text"),
        P.parse_price("original_price").alias("original_price"),
        P.parse_price("discount_price", inner_spaces=True).alias("discount_price"),
    )


@query("parse_unit_price", f"""
WITH {I.RAW}
SELECT price_per_unit AS text, nullif(regexp_extract(price_per_unit, '€/(\\w+)', 1), '') AS unit,
  {PRICE.format("regexp_replace(price_per_unit, '€/.*$', '')")} AS price_per_unit
FROM raw""")
def parse_unit_price(spark, sf):
    texts = I.raw(spark, sf).select(F.col("price_per_unit").alias("text"), "price_per_unit")
    return clean.parse_unit_price(texts).select("text", "unit", "price_per_unit")


@query("parse_dates", f"WITH {I.RAW} SELECT date::DATE AS date, count(*) AS n FROM raw GROUP BY 1")
def parse_dates(spark, sf):
    return clean.parse_dates(I.raw(spark, sf)).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("split_category_first_two", f"""
WITH {I.RAW}
SELECT category AS path, string_split(category, ' > ')[1] AS category, string_split(category, ' > ')[2] AS subcategory FROM raw""")
def split_category_first_two(spark, sf):
    paths = I.raw(spark, sf).select(F.col("category").alias("path"), "category")
    return clean.split_category(paths).select("path", "category", "subcategory")


SPLIT_ONCE = """string_split(category, ' > ')[1] AS category,
    CASE WHEN contains(category, ' > ') THEN substr(category, strpos(category, ' > ') + 3) ELSE category END AS subcategory"""


@query("split_category_keep_rest", f"WITH {I.RAW} SELECT category AS path, {SPLIT_ONCE} FROM raw")
def split_category_keep_rest(spark, sf):
    paths = I.raw(spark, sf).select(F.col("category").alias("path"), "category")
    return clean.split_category(paths, "category").select("path", "category", "subcategory")


@query("standardize_text", f"""
WITH {I.RAW}
SELECT {STRIP.format('name')} AS name, {STRIP.format('size')} AS size, {STRIP.format('category')} AS category,
  {COLLAPSE.format('name')} AS collapsed
FROM raw""")
def standardize_text(spark, sf):
    labels = I.raw(spark, sf).select("name", "size", "category", F.col("name").alias("collapsed"))
    once = clean.standardize_text(labels, ["name", "size", "category"])
    return clean.standardize_text(once.withColumn("collapsed", labels["collapsed"]), ["collapsed"], collapse=True)


@query("strip_accents", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def strip_accents(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", P.strip_accents("text").alias("text"))


@query("strip_accents_exact", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def strip_accents_exact(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", P.strip_accents_exact("text").alias("text"))


@query("ensure_columns", f"WITH {I.OBS} SELECT name, size, NULL::DOUBLE AS weight, 'ES' AS country FROM obs")
def ensure_columns(spark, sf):
    rows = I.obs(spark, sf).select("name", "size")
    return clean.ensure_columns(rows, {"size": "string", "weight": "double", "country": "string"}, {"country": "ES"})


@query("price_and_rounding", f"""
WITH {I.OBS}
SELECT l_orderkey, l_linenumber, coalesce(discount_price, original_price) AS price, round_even(round(original_price * 100) / 4, 0) / 100 AS quarter FROM obs""")
def price_and_rounding(spark, sf):
    rows = I.obs(spark, sf).withColumn("quarter", F.col("original_price") / 4)
    return clean.round_prices(clean.add_price(rows), ["quarter"]).select("l_orderkey", "l_linenumber", "price", "quarter")


@query("number_duplicates", f"""
WITH {I.OBS}
SELECT date, name, size, category, subcategory, image_url, original_price, discount_price, price_per_unit, unit,
  {NUMBERED} AS dedup_id
FROM obs""")
def number(spark, sf):
    return number_duplicates(_staged_columns(spark, sf), clean.GROUP, ["original_price", "discount_price", "price_per_unit"])


@query("number_duplicates_one_hot_group", """
SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value NULLS FIRST)::INTEGER AS dedup_id FROM events""")
def number_hot(spark, sf):
    rows = I.table(spark, sf, "events").select("event_type", "value")
    return number_duplicates(rows, ["event_type"], ["value"], hot_rows=500)


@query("number_duplicates_copies", """
WITH made AS (
  SELECT event_type, round(value) AS value, CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN '' ELSE 'u' END AS url FROM events)
SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value NULLS FIRST, md5(coalesce(url, '')), url NULLS FIRST)::INTEGER AS dedup_id,
  unnest([7, 500, 1000000]) AS hot_rows FROM made""")
def number_copies(spark, sf):
    """Many copies beside rows of equal value and digest, null and empty: the way taken changes no number."""
    kinds = "CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN '' ELSE 'u' END AS url"
    rows = I.table(spark, sf, "events").selectExpr("event_type", "round(value) AS value", kinds)
    made = [number_duplicates(rows, ["event_type"], ["value"], hot_rows=n).withColumn("hot_rows", F.lit(n)) for n in (7, 500, 1_000_000)]
    return made[0].union(made[1]).union(made[2])


@query("recategorize", f"""
WITH {I.OBS},
rows AS (SELECT date, name, size, category, subcategory, original_price, discount_price FROM obs),
labels AS (SELECT DISTINCT name, size, category, subcategory FROM obs WHERE date > DATE '{I.CUTOFF}')
SELECT DISTINCT r.date, r.name, r.size, l.category, l.subcategory, original_price, discount_price
FROM rows r LEFT JOIN labels l ON r.name = l.name AND r.size = l.size""")
def recategorize(spark, sf):
    rows = I.obs(spark, sf).select("date", "name", "size", "category", "subcategory", "original_price", "discount_price")
    return clean.recategorize(rows, I.CUTOFF)


@query("recategorize_keep_old", f"""
WITH {I.OBS},
rows AS (SELECT date, name, size, category, subcategory, original_price FROM obs),
labels AS (SELECT DISTINCT name, size, category, subcategory FROM obs WHERE date > DATE '2001-11-01')
SELECT DISTINCT r.date, r.name, r.size, coalesce(l.category, r.category) AS category,
  coalesce(l.subcategory, r.subcategory) AS subcategory, original_price
FROM rows r LEFT JOIN labels l ON r.name IS NOT DISTINCT FROM l.name AND r.size IS NOT DISTINCT FROM l.size""")
def recategorize_keep_old(spark, sf):
    rows = I.obs(spark, sf).select("date", "name", "size", "category", "subcategory", "original_price")
    return clean.recategorize(rows, "2001-11-01", null_safe=True, keep_old=True)


NULL_KEYS = "CASE WHEN l_linenumber = 2 THEN NULL ELSE name END AS name, CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE size END AS size"


@query("recategorize_null_keys", f"""
WITH {I.OBS},
rows AS (SELECT date, {NULL_KEYS}, category, subcategory, original_price FROM obs),
labels AS (SELECT DISTINCT name, size, category, subcategory FROM rows WHERE date > DATE '2001-11-01'),
joined AS (SELECT r.date, r.name, r.size, l.category, l.subcategory, original_price
  FROM rows r LEFT JOIN labels l ON r.name IS NOT DISTINCT FROM l.name AND r.size IS NOT DISTINCT FROM l.size)
SELECT DISTINCT * FROM joined""")
def recategorize_null_keys(spark, sf):
    names = [c.strip() for c in NULL_KEYS.replace("IN (2, 3)", "BETWEEN 2 AND 3").split(", ")]
    rows = I.obs(spark, sf).selectExpr("date", *names, "category", "subcategory", "original_price")
    return clean.recategorize(rows, "2001-11-01", null_safe=True)


@query("previous_price_and_inflation", f"""
WITH {I.OBS},
rows AS (SELECT DISTINCT date, name, size, category, subcategory, original_price, discount_price FROM obs),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY date, name, size, category, subcategory
    ORDER BY original_price NULLS FIRST, discount_price NULLS FIRST)::INTEGER AS dedup_id FROM rows),
history AS (
  SELECT *, lag(original_price) OVER (PARTITION BY name, size, dedup_id
    ORDER BY date, category NULLS FIRST, subcategory NULLS FIRST, original_price, discount_price) AS prev_original_price FROM numbered)
SELECT date, name, size, category, subcategory, dedup_id, original_price, discount_price, prev_original_price,
  original_price / nullif(prev_original_price, 0) - 1 AS inflation_percent,
  original_price - prev_original_price AS inflation_abs,
  CASE WHEN discount_price = prev_original_price THEN true END AS is_fake_discount
FROM history""")
def previous_price(spark, sf):
    rows = I.obs(spark, sf).select(*clean.GROUP, *clean.PRICES).distinct()
    numbered = number_duplicates(rows, clean.GROUP, clean.PRICES)
    return numbered.transform(clean.add_prev_price).transform(clean.add_inflation).transform(clean.add_fake_discount)


V1 = f"""{I.RAW},
typed AS (
  SELECT date::DATE AS date, {COLLAPSE.format('name')} AS name, {COLLAPSE.format('size')} AS size,
    {COLLAPSE.format("string_split(category, ' > ')[1]")} AS category,
    {COLLAPSE.format("string_split(category, ' > ')[2]")} AS subcategory,
    {PRICE.format('original_price')} AS original_price, {PRICE.format('discount_price')} AS discount_price
  FROM raw),
labels AS (SELECT DISTINCT name, size, category, subcategory FROM typed WHERE date > DATE '{I.CUTOFF}'),
moved AS (
  SELECT DISTINCT t.date, t.name, t.size, l.category, l.subcategory, t.original_price, t.discount_price
  FROM typed t LEFT JOIN labels l ON t.name = l.name AND t.size = l.size),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY date, name, size, category, subcategory
    ORDER BY original_price NULLS FIRST, discount_price NULLS FIRST)::INTEGER AS dedup_id FROM moved),
history AS (
  SELECT *, lag(original_price) OVER (PARTITION BY name, size, dedup_id ORDER BY date, category NULLS FIRST,
    subcategory NULLS FIRST, original_price NULLS FIRST, discount_price NULLS FIRST) AS prev_original_price FROM numbered)
SELECT date, dedup_id, name, size, category, subcategory, original_price, prev_original_price, discount_price,
  CASE WHEN discount_price = prev_original_price THEN true END AS is_fake_discount,
  original_price / nullif(prev_original_price, 0) - 1 AS inflation_percent,
  original_price - prev_original_price AS inflation_abs
FROM history"""


@query("clean_v1", f"WITH {V1}")
def clean_v1(spark, sf):
    rows = I.raw(spark, sf).select("name", "original_price", "discount_price", "size", "category", F.to_date("date").alias("date"))
    return clean.clean_v1(rows, I.CUTOFF)


ROUND2 = "round_even({0}, 2)"
STAGE_TAIL = f"""
staged AS (
  SELECT date, {STRIP.format('name')} AS name, {STRIP.format('size')} AS size, {STRIP.format('category')} AS category,
    {STRIP.format('subcategory')} AS subcategory, image_url, {ROUND2.format('original_price')} AS original_price,
    {ROUND2.format('discount_price')} AS discount_price, {ROUND2.format('price_per_unit')} AS price_per_unit,
    {STRIP.format('unit')} AS unit
  FROM split),
numbered AS (SELECT *, {NUMBERED} AS dedup_id FROM staged)
SELECT date, dedup_id, name, size, category, subcategory, image_url, coalesce(discount_price, original_price) AS price,
  original_price, discount_price, price_per_unit, unit
FROM numbered"""


@query("clean_v2_merc", f"""
WITH {I.RAW},
parsed AS (
  SELECT date::DATE AS date, name, size, {SPLIT_ONCE}, image_url, {PRICE.format('original_price')} AS original_price,
    {PRICE.format('discount_price')} AS discount_price, NULL::DOUBLE AS price_per_unit, NULL::VARCHAR AS unit
  FROM raw),
labels AS (SELECT DISTINCT name, size, category, subcategory FROM parsed WHERE date > DATE '{I.CUTOFF}'),
split AS (
  SELECT DISTINCT p.date, p.name, p.size, l.category, l.subcategory, image_url, original_price, discount_price, price_per_unit, unit
  FROM parsed p LEFT JOIN labels l ON p.name IS NOT DISTINCT FROM l.name AND p.size IS NOT DISTINCT FROM l.size),
{STAGE_TAIL}""")
def clean_v2_merc(spark, sf):
    columns = ["name", "original_price", "discount_price", "size", "category", "image_url", "date"]
    return clean.clean_v2_merc(I.raw(spark, sf).select(*columns), I.CUTOFF)


@query("clean_v2_carr", f"""
WITH {I.RAW},
split AS (
  SELECT date::DATE AS date, name, NULL::VARCHAR AS size, {SPLIT_ONCE}, image_url,
    {PRICE.format('original_price')} AS original_price, {PRICE.format('discount_price')} AS discount_price,
    {PRICE.format("regexp_replace(price_per_unit, '€/.*$', '')")} AS price_per_unit,
    nullif(regexp_extract(price_per_unit, '€/(\\w+)', 1), '') AS unit
  FROM raw),
{STAGE_TAIL}""")
def clean_v2_carr(spark, sf):
    return clean.clean_v2_carr(I.raw(spark, sf).drop("size"))


def _staged_columns(spark, sf) -> DataFrame:
    return I.obs(spark, sf).select(*clean.GROUP, "image_url", "original_price", "discount_price", "price_per_unit", "unit")


def staging(spark: SparkSession, sf: str) -> DataFrame:
    """Staging rows without the category replacement, as input of the star."""
    order = ["original_price", "discount_price", "price_per_unit"]
    return stored(spark, sf, "staging", lambda: clean.add_price(
        number_duplicates(_staged_columns(spark, sf), clean.GROUP, order)
    ))


# --------------------------------------------------------------------------- star

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
STG = f"""{I.OBS},
stg AS (SELECT *, coalesce(discount_price, original_price) AS price, {NUMBERED} AS dedup_id FROM obs)"""


def sql_key(*columns: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce({c}, '{NULL_TOKEN}')" for c in columns) + "))"


DIM_DATE_COLUMNS = """
  d AS date, strftime(d, '%Y%m%d')::INTEGER AS date_key, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
  month(d)::INTEGER AS month, strftime(d, '%Y%m')::INTEGER AS month_key, monthname(d) AS month_name,
  isoyear(d)::INTEGER AS iso_year, week(d)::INTEGER AS iso_week, date_trunc('week', d)::DATE AS week_start_date,
  (date_trunc('week', d) + INTERVAL 6 DAY)::DATE AS week_end_date, strftime(d, '%G%V') AS iso_week_key,
  isodow(d)::INTEGER AS day_of_week, day(d)::INTEGER AS day_of_month, dayofyear(d)::INTEGER AS day_of_year,
  isodow(d) IN (6, 7) AS is_weekend, date_trunc('month', d)::DATE AS month_start_date, last_day(d) AS month_end_date,
  date_trunc('quarter', d)::DATE AS quarter_start_date,
  (date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS quarter_end_date,
  date_trunc('year', d)::DATE AS year_start_date, (date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE AS year_end_date"""
SPINE = f"""
spine AS (SELECT d::DATE AS d FROM generate_series(DATE '{I.CALENDAR[0]}', DATE '{I.CALENDAR[1]}' - INTERVAL 1 DAY, INTERVAL 1 DAY) t(d))"""
STAR = f"""{STG}, {SPINE},
dim_date AS (SELECT {DIM_DATE_COLUMNS} FROM spine),
dim_category AS (
  SELECT DISTINCT {sql_key('category', 'subcategory')} AS category_key, {sql_key('category', 'subcategory')} AS category_nk,
    category, subcategory FROM stg WHERE category IS NOT NULL OR subcategory IS NOT NULL),
pick AS (
  SELECT name, size, arg_max(image_url, row(date, image_url)) FILTER (WHERE image_url IS NOT NULL) AS url,
    min(date) AS first_seen_date, max(date) AS last_seen_date FROM stg GROUP BY name, size),
dim_product AS (
  SELECT md5({sql_key('name', 'size')}) AS product_key, {sql_key('name', 'size')} AS product_nk, name, size,
    CASE WHEN regexp_matches(url, '^https?://') THEN url END AS image_url, first_seen_date, last_seen_date FROM pick),
fact AS (
  SELECT d.date_key, p.product_key, c.category_key, s.dedup_id, s.price, s.original_price, s.discount_price,
    (s.discount_price IS NOT NULL AND s.discount_price < s.original_price) AS is_discounted,
    s.original_price - s.price AS discount_abs, (s.original_price - s.price) / nullif(s.original_price, 0) AS discount_pct,
    s.date AS fact_date
  FROM stg s JOIN dim_date d ON d.date = s.date
  JOIN dim_product p ON p.product_nk = {sql_key('s.name', 's.size')}
  JOIN dim_category c ON c.category_nk = {sql_key('s.category', 's.subcategory')})"""


def star_tables(spark, sf) -> dict[str, DataFrame]:
    built = models.build_star(staging(spark, sf), *I.CALENDAR)
    return {name: stored(spark, sf, name, lambda df=df: df) for name, df in built.items()}


@query("dim_date_with_activity", f"""
WITH {STAR} SELECT dim_date.*, coalesce(n, 0) AS observations FROM dim_date LEFT JOIN (SELECT date, count(*) AS n FROM obs GROUP BY 1) USING (date)""")
def dim_date_with_activity(spark, sf):
    counts = I.obs(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return (
        star.dim_date(spark, *I.CALENDAR).join(counts, "date", "left")
        .withColumn("observations", F.coalesce("n", F.lit(0))).drop("n")
    )


@query("dim_category", f"WITH {STAR} SELECT * FROM dim_category")
def dim_category(spark, sf):
    return star.dim_category(staging(spark, sf))


@query("dim_product", f"WITH {STAR} SELECT * FROM dim_product")
def dim_product(spark, sf):
    return star.maintain_dim_product(staging(spark, sf))


@query("dim_product_incremental", f"""
WITH {STG},
old AS (SELECT name, size, arg_max(image_url, row(date, image_url)) FILTER (WHERE image_url IS NOT NULL) AS url, min(date) AS f, max(date) AS l
  FROM stg WHERE date < DATE '2001-09-01' GROUP BY 1, 2),
new AS (SELECT name, size, arg_max(image_url, row(date, image_url)) FILTER (WHERE image_url IS NOT NULL) AS url, min(date) AS f, max(date) AS l
  FROM stg WHERE date >= (SELECT max(l) - 30 FROM old) GROUP BY 1, 2),
old_kept AS (SELECT name, size, CASE WHEN regexp_matches(url, '^https?://') THEN url END AS url, f, l FROM old),
joined AS (
  SELECT coalesce(n.name, o.name) AS name, coalesce(n.size, o.size) AS size, coalesce(n.url, o.url) AS url,
    least(o.f, n.f) AS f, greatest(o.l, n.l) AS l
  FROM old_kept o FULL JOIN new n ON o.name = n.name AND o.size = n.size)
SELECT md5({sql_key('name', 'size')}) AS product_key, {sql_key('name', 'size')} AS product_nk, name, size,
  CASE WHEN regexp_matches(url, '^https?://') THEN url END AS image_url, f AS first_seen_date, l AS last_seen_date FROM joined""")
def dim_product_incremental(spark, sf):
    rows = staging(spark, sf)
    known = lambda: star.maintain_dim_product(rows.filter("date < DATE '2001-09-01'"))  # read three times below
    current = stored(spark, sf, "dim-product-before", known)
    return star.apply_upserts(current, star.maintain_dim_product(rows, current), "product_nk")


@query("fact_product_price_daily", f"WITH {STAR} SELECT * FROM fact")
def fact(spark, sf):
    return models.build_star(staging(spark, sf), *I.CALENDAR)["fact_product_price_daily"].drop("load_ts")


@query("fact_incremental_window", f"WITH {STAR} SELECT * FROM fact WHERE fact_date >= (SELECT max(fact_date) FROM fact WHERE fact_date < DATE '2001-09-01') - 30")
def fact_incremental(spark, sf):
    t = star_tables(spark, sf)
    known = t["fact_product_price_daily"].filter("fact_date < DATE '2001-09-01'")
    return star.build_fact(staging(spark, sf), t["dim_date"], t["dim_product"], t["dim_category"], known).drop("load_ts")


# --------------------------------------------------------------------------- serving tables

AVERAGES = ", ".join(
    f"round(avg(price) OVER (PARTITION BY id ORDER BY date RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW), 10) AS sma{n}"
    for n in (7, 15, 30)
)


@query("daily_lowest_price", "SELECT user_id AS id, ts::DATE AS date, min(value) AS price FROM events GROUP BY 1, 2")
def dedup_daily(spark, sf):
    return refs.dedup_daily(I.daily(spark, sf))


@query("moving_averages", f"""
WITH base AS (SELECT ts::DATE AS date, user_id AS id, min(value) AS price FROM events GROUP BY 1, 2)
SELECT date, id, price, {AVERAGES} FROM base""")
def moving_averages(spark, sf):
    return rounded(refs.moving_averages(refs.dedup_daily(I.daily(spark, sf))), "sma7", "sma15", "sma30")


DETAILS = f"""{STAR},
base AS (SELECT fact_date AS date, product_key AS id, min(price) AS price FROM fact GROUP BY 1, 2),
details AS (SELECT date, id, price, {AVERAGES} FROM base)"""


@query("ref_product_price_details", f"WITH {DETAILS} SELECT * FROM details")
def price_details(spark, sf):
    built = star_tables(spark, sf)
    return rounded(refs.price_details(built["fact_product_price_daily"], built["dim_date"]), "sma7", "sma15", "sma30")


@query("ref_product_price_details_recent", f"WITH {DETAILS} SELECT * FROM details WHERE date >= DATE '{I.AS_OF}' - INTERVAL 6 MONTH")
def price_details_recent(spark, sf):
    fact_table = star_tables(spark, sf)["fact_product_price_daily"]
    return rounded(refs.price_details(fact_table, as_of=I.AS_OF), "sma7", "sma15", "sma30")


def sql_refs(where: str = "") -> str:
    """Labels and newest prices are looked up apart, from sorted distinct lists and a ranked row."""
    labels = lambda c: f"array_to_string(list_sort(list_distinct(list({c}))), ' | ')"
    return f"""
seen AS (SELECT * FROM fact JOIN dim_category USING (category_key) {where}),
labels AS (SELECT product_key, {labels('category')} AS categories, {labels('subcategory')} AS subcategories FROM seen GROUP BY product_key),
newest_price AS (
  SELECT product_key, price FROM seen
  QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY fact_date DESC, dedup_id DESC, category_key DESC) = 1),
refs AS (
  SELECT product_key AS id, name, size, categories, subcategories, price, image_url
  FROM labels JOIN newest_price USING (product_key) LEFT JOIN dim_product USING (product_key))"""


@query("ref_products", f"WITH {STAR}, {sql_refs()} SELECT * FROM refs")
def ref_products(spark, sf):
    t = star_tables(spark, sf)
    return refs.ref_products(t["fact_product_price_daily"], t["dim_date"], t["dim_category"], t["dim_product"])


@query("ref_products_recent", f"WITH {STAR}, {sql_refs(f'WHERE fact_date >= DATE {chr(39)}{I.AS_OF}{chr(39)} - 120')} SELECT * FROM refs")
def ref_products_recent(spark, sf):
    t = star_tables(spark, sf)
    return refs.ref_products(t["fact_product_price_daily"], None, t["dim_category"], t["dim_product"], I.AS_OF)


# --------------------------------------------------------------------------- reports

def sql_variation(latest: str, earliest: str) -> str:
    return f"round(({latest} - {earliest}) / nullif({earliest}, 0), 4)"


MONTHLY = f"""{STAR},
ends AS (
  SELECT date_trunc('month', fact_date)::DATE AS year_month_period, product_key, category_key,
    min(fact_date) AS earliest_date, max(fact_date) AS latest_date,
    arg_min(price, row(fact_date, dedup_id)) AS earliest_price, arg_max(price, row(fact_date, dedup_id)) AS latest_price,
    arg_min(original_price, row(fact_date, dedup_id)) AS earliest_orig_price,
    arg_max(original_price, row(fact_date, dedup_id)) AS latest_orig_price
  FROM fact GROUP BY 1, 2, 3),
monthly AS (
  SELECT year_month_period, product_key, category_key, DATE '{I.AS_OF}' AS processing_date, earliest_date, latest_date,
    earliest_price, latest_price, latest_price - earliest_price AS price_variation_abs,
    {sql_variation('latest_price', 'earliest_price')} AS price_variation_percent,
    earliest_orig_price, latest_orig_price, latest_orig_price - earliest_orig_price AS orig_price_variation_abs,
    {sql_variation('latest_orig_price', 'earliest_orig_price')} AS orig_price_variation_percent
  FROM ends)"""


def monthly_table(spark, sf) -> DataFrame:
    return stored(spark, sf, "monthly_products", lambda: monthly_products(spark, sf))


@query("monthly_products", f"WITH {MONTHLY} SELECT * FROM monthly")
def monthly_products(spark, sf):
    t = star_tables(spark, sf)
    return reports.monthly_products(t["fact_product_price_daily"], t["dim_date"], I.AS_OF)


@query("monthly_products_current", f"WITH {MONTHLY} SELECT * FROM monthly WHERE year_month_period = DATE '2001-11-01'")
def monthly_products_current(spark, sf):
    t = star_tables(spark, sf)
    return reports.monthly_products(t["fact_product_price_daily"], t["dim_date"], I.AS_OF, only_current=True)


def sql_trends(where: str = "") -> str:
    stats_sql = ", ".join(
        f"""round(avg({c}), 12) AS avg_{n}_var_pct, round(stddev_samp({c}), 10) AS stdev_{n}_var_pct,
    round(avg(CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, 1), -1) END), 12) AS avg_clipped_{n}_var_pct"""
        for n, c in (("price", "price_variation_percent"), ("orig_price", "orig_price_variation_percent"))
    )
    return f"SELECT year_month_period, category_key, count(*) AS product_count, {stats_sql} FROM monthly {where} GROUP BY 1, 2"


MEANS = [f"{s}_{n}_var_pct" for n in ("price", "orig_price") for s in ("avg", "avg_clipped")]
SPREADS = ["stdev_price_var_pct", "stdev_orig_price_var_pct"]


def rounded_trends(df: DataFrame) -> DataFrame:
    """A mean of 4-digit values over a power of two ends within 12 digits, so rounding there never meets a tie."""
    return rounded(rounded(df, *MEANS, digits=12), *SPREADS)


@query("monthly_category_trends", f"WITH {MONTHLY} {sql_trends()}")
def category_trends(spark, sf):
    return rounded_trends(reports.category_trends(monthly_table(spark, sf)))


@query("monthly_category_trends_recent", f"WITH {MONTHLY} {sql_trends(where=f'WHERE year_month_period >= DATE {chr(39)}2001-08-01{chr(39)}')}")
def category_trends_recent(spark, sf):
    return rounded_trends(reports.category_trends(monthly_table(spark, sf), I.AS_OF, months=3))


def sql_movers(where: str = "") -> str:
    """Both rankings in one pass; a row that is in both comes out twice."""
    return f"""
ranked AS (
  SELECT year_month_period, product_key, category_key, price_variation_percent,
    [{{'direction': 'increase', 'rank': dense_rank() OVER (month ORDER BY price_variation_percent DESC NULLS LAST)}},
     {{'direction': 'decrease', 'rank': dense_rank() OVER (month ORDER BY price_variation_percent NULLS FIRST)}}] AS places
  FROM monthly {where} WINDOW month AS (PARTITION BY year_month_period))
SELECT year_month_period, product_key, category_key, price_variation_percent, place.direction AS direction, place.rank::INTEGER AS rank,
  DATE '{I.AS_OF}' AS processing_date
FROM ranked, unnest(places) AS u(place) WHERE place.rank <= 5"""


@query("monthly_product_top_movers", f"WITH {MONTHLY}, {sql_movers()}")
def top_movers(spark, sf):
    return reports.top_movers(monthly_table(spark, sf), I.AS_OF)


def states_root(spark, sf) -> str:
    """Report states kept over five batches, once per application: rows of all months late and early, a batch given twice, a month given anew."""
    key = (spark.sparkContext.applicationId, sf, "report-states")
    if key not in _STORED:
        root, fact = scratch_path(spark, "report-states"), star_tables(spark, sf)["fact_product_price_daily"]
        part = F.pmod(F.xxhash64("fact_date", "product_key", "category_key", "dedup_id"), F.lit(3))
        for i in (2, 0, 0, 1):
            report_states.apply_batch(spark, root, fact.filter(part == i).drop("date"), I.AS_OF, split=2)
        again = fact.filter("fact_date >= DATE '2001-10-01' AND fact_date < DATE '2001-11-01'")
        report_states.apply_batch(spark, root, again.drop("date"), I.AS_OF, replace=True)
        _STORED[key] = root
    return _STORED[key]


@query("monthly_products_by_batches", f"WITH {MONTHLY} SELECT * FROM monthly")
def monthly_by_batches(spark, sf):
    return report_states.reports(spark, states_root(spark, sf), I.AS_OF)["monthly_products"]


@query("category_trends_by_batches", f"WITH {MONTHLY} {sql_trends()}")
def trends_by_batches(spark, sf):
    return rounded_trends(report_states.reports(spark, states_root(spark, sf), I.AS_OF)["monthly_category_trends"])


@query("top_movers_by_batches", f"WITH {MONTHLY}, {sql_movers()}")
def movers_by_batches(spark, sf):
    return report_states.reports(spark, states_root(spark, sf), I.AS_OF)["monthly_product_top_movers"]


@query("monthly_product_top_movers_recent",
       f"WITH {MONTHLY}, {sql_movers('WHERE price_variation_percent IS NOT NULL AND year_month_period >= DATE ' + chr(39) + '2001-08-01' + chr(39))}")
def top_movers_recent(spark, sf):
    return reports.top_movers(monthly_table(spark, sf), I.AS_OF, drop_null=True, months=3)


#: Column prefix -> the first day of the period, from the newest day.
ANCHORS = {
    "mtd": "date_trunc('month', latest_date)", "mtd3": "date_trunc('month', latest_date) - INTERVAL 2 MONTH",
    "mtd6": "date_trunc('month', latest_date) - INTERVAL 5 MONTH", "ytd": "date_trunc('year', latest_date)",
}


def sql_report(days: str, keys: str, wanted: tuple[str, ...] = tuple(ANCHORS)) -> str:
    """One aggregate per product over its days: the price of an anchor day is the only one that passes its filter."""
    prices = ", ".join(f"max(price) FILTER (WHERE fact_date = ({ANCHORS[p]})::DATE) AS {p}_price" for p in wanted)
    columns = ", ".join(
        f"({ANCHORS[p]})::DATE AS {p}_start_date, {p}_price, latest_price - {p}_price AS {p}_price_var_abs, "
        f"(latest_price - {p}_price) / nullif({p}_price, 0) AS {p}_price_var_pct" for p in wanted
    )
    return f"""
newest AS (SELECT *, max(fact_date) OVER (PARTITION BY {keys}) AS latest_date FROM {days}),
anchored AS (
  SELECT {keys}, latest_date, max(price) FILTER (WHERE fact_date = latest_date) AS latest_price, {prices}
  FROM newest GROUP BY {keys}, latest_date),
varied AS (SELECT {keys}, latest_date, latest_price, {columns} FROM anchored)"""


REPORT = f"""
days AS (SELECT fact_date, product_key, min(price) AS price FROM fact WHERE fact_date >= DATE '{I.AS_OF}' - 366 GROUP BY 1, 2),
{sql_report('days', 'product_key')},
report AS (SELECT product_key, name, size, varied.* EXCLUDE (product_key) FROM varied JOIN dim_product USING (product_key))"""


@query("product_price_report", f"WITH {STAR}, {REPORT} SELECT * FROM report")
def price_report(spark, sf):
    t = star_tables(spark, sf)
    return reports.price_report(t["fact_product_price_daily"], t["dim_product"], I.AS_OF)


@query("product_price_report_top_ytd", f"""
WITH {STAR}, {sql_refs()}, {REPORT}
SELECT product_key, report.name, report.size, categories, subcategories, latest_date, latest_price, ytd_start_date, ytd_price,
  ytd_price_var_abs, ytd_price_var_pct,
  CASE WHEN ytd_price_var_pct > 0 THEN 'increase' WHEN ytd_price_var_pct < 0 THEN 'decrease' ELSE 'flat' END AS direction
FROM report JOIN refs ON refs.id = product_key
WHERE ytd_price_var_pct IS NOT NULL AND latest_date = (SELECT max(latest_date) FROM report)
ORDER BY abs(ytd_price_var_pct) DESC, abs(ytd_price_var_abs) DESC, latest_date DESC, product_key LIMIT 10""")
def top_ytd(spark, sf):
    t = star_tables(spark, sf)
    f = t["fact_product_price_daily"]
    report = reports.price_report(f, t["dim_product"], I.AS_OF)
    return reports.top_ytd(report, refs.ref_products(f, None, t["dim_category"], t["dim_product"]))


EVENTS_REPORT = f"""
{I.EVENTS_STG},
days AS (SELECT date AS fact_date, name, size, min(price) AS price FROM events_stg GROUP BY 1, 2, 3),
{sql_report('days', 'name, size', ('ytd',))},
ytd AS (SELECT * FROM varied)"""


def events_report(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = I.events_stg(spark, sf)
    built = models.build_star(rows, "2024-01-01", "2024-02-01")
    f = stored(spark, sf, "events_fact", lambda: built["fact_product_price_daily"])
    return (
        reports.price_report(f, built["dim_product"], I.EVENTS_AS_OF),
        refs.ref_products(f, None, built["dim_category"], built["dim_product"]),
    )


@query("price_report_of_events", f"""
WITH {EVENTS_REPORT} SELECT name, size, latest_date, latest_price, ytd_start_date, ytd_price, ytd_price_var_abs, ytd_price_var_pct FROM ytd""")
def price_report_of_events(spark, sf):
    report, _ = events_report(spark, sf)
    return report.select(
        "name", "size", "latest_date", "latest_price", "ytd_start_date", "ytd_price", "ytd_price_var_abs", "ytd_price_var_pct"
    )


@query("top_ytd_of_events", f"""
WITH {EVENTS_REPORT}
SELECT name, size, 'events' AS categories, size AS subcategories, latest_price, ytd_price, ytd_price_var_abs, ytd_price_var_pct,
  CASE WHEN ytd_price_var_pct > 0 THEN 'increase' WHEN ytd_price_var_pct < 0 THEN 'decrease' ELSE 'flat' END AS direction
FROM ytd WHERE ytd_price_var_pct IS NOT NULL AND latest_date = (SELECT max(latest_date) FROM ytd)
ORDER BY abs(ytd_price_var_pct) DESC, abs(ytd_price_var_abs) DESC, latest_date DESC, md5({sql_key('name', 'size')}) LIMIT 10""")
def top_ytd_of_events(spark, sf):
    report, current = events_report(spark, sf)
    return reports.top_ytd(report, current).select(
        "name", "size", "categories", "subcategories", "latest_price", "ytd_price", "ytd_price_var_abs", "ytd_price_var_pct", "direction"
    )


@query("latest_per_key", """
SELECT id, date, price FROM (SELECT user_id AS id, ts::DATE AS date, min(value) AS price FROM events GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC) = 1""")
def latest_per_key(spark, sf):
    return reports.latest_per_key(refs.dedup_daily(I.daily(spark, sf)), "id", "date", ["price"])


@query("last_saturday", """
SELECT o_orderkey, (o_orderdate::DATE - ((isodow(o_orderdate) % 7 + 1) % 7)::INTEGER)::DATE AS last_saturday FROM orders""")
def last_saturday(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", P.last_saturday(F.to_date("o_orderdate")).alias("last_saturday"))


@query("period_starts", """
SELECT o_orderkey, date_trunc('month', d)::DATE AS mtd, date_trunc('month', d - INTERVAL 2 MONTH)::DATE AS mtd3,
  date_trunc('month', d - INTERVAL 5 MONTH)::DATE AS mtd6, date_trunc('year', d)::DATE AS ytd
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def period_starts(spark, sf):
    starts = P.period_starts(F.to_date("o_orderdate"))
    return I.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in starts.items()])


@query("clean_url", """
SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') THEN regexp_replace(trim(url), '[?].*$', '') END AS without_query,
  CASE WHEN regexp_matches(url, '^https?://') THEN regexp_replace(trim(url), '[?#].*$', '') END AS without_fragment FROM pages""")
def clean_url(spark, sf):
    return I.table(spark, sf, "pages").select(
        "page_id", P.clean_url("url").alias("without_query"), P.clean_url("url", drop_fragment=True).alias("without_fragment")
    )


# --------------------------------------------------------------------------- search

def products(spark, sf) -> DataFrame:
    """A product per part, with the serving columns."""
    return I.table(spark, sf, "part").selectExpr(
        "cast(p_partkey AS string) AS id", "concat(p_brand, ' Jamón ', p_name) AS name", "p_type AS size",
        "split(p_name, ' ')[1] AS categories", "split(p_name, ' ')[0] AS subcategories", "p_retailprice AS price",
        "cast(NULL AS string) AS image_url",
    )


PRODUCTS = """
products AS (
  SELECT p_partkey::VARCHAR AS id, p_brand || ' Jamón ' || p_name AS name, p_type AS size, split_part(p_name, ' ', 2) AS categories,
    split_part(p_name, ' ', 1) AS subcategories, p_retailprice AS price, NULL::VARCHAR AS image_url FROM part)"""
INDEX = """
tokens AS (
  SELECT DISTINCT unnest(regexp_extract_all(strip_accents(lower(concat_ws(' ', id, name, size, categories, subcategories))), '[\\p{L}\\p{N}]+')) AS token, id
  FROM products)"""


@query("search_index", f"WITH {PRODUCTS}, {INDEX} SELECT token, id FROM tokens")
def search_index(spark, sf):
    return search.build_search_index(products(spark, sf))


@query("search_prefix", f"WITH {PRODUCTS}, {INDEX} SELECT * FROM products WHERE id IN (SELECT id FROM tokens WHERE token LIKE 'wid%')")
def search_prefix(spark, sf):
    p = products(spark, sf)
    return search.search_fts(search.build_search_index(p), p, "WID")


@query("search_all_words", f"""
WITH {PRODUCTS}, {INDEX}
SELECT * FROM products WHERE id IN (SELECT id FROM tokens WHERE token = 'jamon') AND id IN (SELECT id FROM tokens WHERE token = 'promo')
  AND id IN (SELECT id FROM tokens WHERE token LIKE 'gi%')""")
def search_all_words(spark, sf):
    p = products(spark, sf)
    return search.search_fts(search.build_search_index(p), p, "Jamón promo gi")


@query("search_documents", r"""
WITH tokens AS (SELECT DISTINCT unnest(regexp_extract_all(strip_accents(lower(concat_ws(' ', doc_id::VARCHAR, text))), '[\p{L}\p{N}]+')) AS token, doc_id FROM documents)
SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM tokens WHERE token = 'and') AND doc_id IN (SELECT doc_id FROM tokens WHERE token LIKE 'th%')""")
def search_documents(spark, sf):
    docs = I.table(spark, sf, "documents")
    index = search.build_search_index(docs, "doc_id", ["text"])
    return search.search_fts(index, docs, "and th", "doc_id").select("doc_id", "lang", "source", "n_chars")


FOLDED = "concat(p_partkey, CASE p_partkey % 4 WHEN 0 THEN ' ガム' WHEN 1 THEN ' 한국 김치' WHEN 2 THEN ' 5 \u212b' ELSE ' plain' END)"


@query("search_scripts", """
SELECT p_partkey::VARCHAR AS id, 'ガム' AS term FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT p_partkey::VARCHAR, '한국 김' FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT p_partkey::VARCHAR, 'å' FROM part WHERE p_partkey % 4 = 2""")
def search_scripts(spark, sf):
    """Names in several scripts are found by their own words."""
    rows = I.table(spark, sf, "part").selectExpr("cast(p_partkey AS string) AS id", f"{FOLDED} AS name")
    index = stored(spark, sf, "script-index", lambda: search.build_search_index(rows, "id", ["name"]))
    found = [search.search_fts(index, rows, t).select("id", F.lit(t).alias("term")) for t in ("ガム", "한국 김", "å")]
    return found[0].union(found[1]).union(found[2])


@query("search_page_after", f"""
WITH {PRODUCTS}, {INDEX}, hits AS (SELECT * FROM products WHERE id IN (SELECT id FROM tokens WHERE token LIKE 'ring%'))
SELECT *, (SELECT count(*) FROM hits) AS total_count, (SELECT count(*) FROM hits WHERE id > '5') > 5 AS has_more FROM hits WHERE id > '5' ORDER BY id LIMIT 5""")
def search_page_after(spark, sf):
    p = products(spark, sf)
    return search.page_after(search.search_fts(search.build_search_index(p), p, "ring"), "5", limit=5)


@query("search_substring", f"""
WITH {PRODUCTS} SELECT * FROM products WHERE contains(lower(name), 'bolt') OR contains(lower(size), 'bolt')
  OR contains(lower(categories), 'bolt') OR contains(lower(subcategories), 'bolt')""")
def search_substring(spark, sf):
    return search.search_substring(products(spark, sf), "BOLT")


@query("search_page", f"""
WITH {PRODUCTS}, {INDEX}, hits AS (SELECT * FROM products WHERE id IN (SELECT id FROM tokens WHERE token LIKE 'ring%'))
SELECT *, (SELECT count(*) FROM hits) AS total_count, 15 < (SELECT count(*) FROM hits) AS has_more FROM hits ORDER BY id LIMIT 5 OFFSET 10""")
def search_page(spark, sf):
    p = products(spark, sf)
    return search.page(search.search_fts(search.build_search_index(p), p, "ring"), limit=5, offset=10)


@query("product_detail", f"""
WITH {DETAILS}, {sql_refs()},
recent AS (SELECT * FROM details WHERE date >= DATE '{I.AS_OF}' - INTERVAL 6 MONTH)
SELECT refs.id, name, size, categories, subcategories, refs.price AS current_price, image_url, count(*) AS details,
  string_agg(date::VARCHAR, ',' ORDER BY date) AS dates, round(sum(recent.price), 4) AS paid, min(sma30) AS lowest_sma30
FROM refs JOIN recent ON recent.id = refs.id GROUP BY ALL""")
def product_detail(spark, sf):
    t = star_tables(spark, sf)
    f = t["fact_product_price_daily"]
    current = refs.ref_products(f, None, t["dim_category"], t["dim_product"])
    nested = search.product_detail(current, refs.price_details(f), None, I.AS_OF)
    prices = F.col("price_details")
    return nested.select(
        "id", "name", "size", "categories", "subcategories", "current_price", "image_url",
        F.size(prices).cast("long").alias("details"),
        F.array_join(F.transform(prices["date"], lambda d: d.cast("string")), ",").alias("dates"),
        F.round(F.aggregate(prices["price"], F.lit(0.0), lambda a, p: a + p), 4).alias("paid"),
        F.round(F.array_min(prices["sma30"]), 10).alias("lowest_sma30"),
    )


# --------------------------------------------------------------------------- data quality and counts

@query("quality_rules", f"""
WITH {STAR}
SELECT 'not_null:price' AS rule, count(*) FILTER (WHERE price IS NULL) AS failures, CASE WHEN count(*) FILTER (WHERE price IS NULL) > 0 THEN 'fail' ELSE 'pass' END AS status FROM fact
UNION ALL SELECT 'not_null:discount_price', count(*) FILTER (WHERE discount_price IS NULL), CASE WHEN count(*) FILTER (WHERE discount_price IS NULL) > 0 THEN 'fail' ELSE 'pass' END FROM fact
UNION ALL SELECT 'accepted:dedup_id', count(*) FILTER (WHERE dedup_id NOT IN (1, 2)), CASE WHEN count(*) FILTER (WHERE dedup_id NOT IN (1, 2)) > 0 THEN 'fail' ELSE 'pass' END FROM fact
UNION ALL SELECT 'expression:cheap', count(*) FILTER (WHERE NOT discount_price < 500), CASE WHEN count(*) FILTER (WHERE NOT discount_price < 500) > 0 THEN 'fail' ELSE 'pass' END FROM fact
UNION ALL SELECT 'unique:date_key,product_key,category_key,dedup_id', count(*), CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END
  FROM (SELECT 1 FROM fact GROUP BY date_key, product_key, category_key, dedup_id HAVING count(*) > 1)
UNION ALL SELECT 'unique:product_key', count(*), CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END
  FROM (SELECT 1 FROM fact GROUP BY product_key HAVING count(*) > 1)
UNION ALL SELECT 'relationship:category_key', count(*), CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END
  FROM fact WHERE category_key NOT IN (SELECT category_key FROM dim_category WHERE subcategory <> 'fresh')
UNION ALL SELECT 'freshness:fact_date', date_diff('day', max(fact_date), DATE '2001-11-06'), 'warn' FROM fact""")
def quality_rules(spark, sf):
    t = star_tables(spark, sf)
    f = t["fact_product_price_daily"]
    rules = {
        **quality.not_null("price", "discount_price"),
        **quality.accepted("dedup_id", [1, 2]),
        **quality.expression("cheap", "discount_price < 500"),
    }
    return quality.report([
        quality.row_rules(f, rules),
        quality.dq_unique(f, ["date_key", "product_key", "category_key", "dedup_id"]),
        quality.dq_unique(f, ["product_key"]),
        quality.dq_relationship(f, "category_key", t["dim_category"].filter("subcategory <> 'fresh'"), "category_key"),
        quality.dq_freshness(f, "fact_date", "2001-11-06"),
    ])


LABELS = """
labelled AS (
  SELECT 'carr_' || date || '.csv' AS file, parts, coalesce('url::' || nullif(trim(product_url), ''), 'name::' || lower(trim(regexp_replace(name, '\\s+', ' ', 'g')))) AS product
  FROM (SELECT *, list_filter(list_transform(string_split(coalesce(category, ''), '>'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM raw)),
stats_rows AS (
  SELECT file, CASE WHEN len(parts) = 0 THEN '(missing)' ELSE parts[1] END AS category,
    CASE WHEN len(parts) = 0 THEN '(missing)' WHEN len(parts) = 1 THEN '(none)' ELSE array_to_string(parts[2:], ' > ') END AS subcategory, product
  FROM labelled)"""


@query("listing_stats", f"""
WITH {I.RAW}, {LABELS}
SELECT CASE WHEN grouping(file) = 0 THEN 'file' ELSE 'overall' END AS scope,
  CASE WHEN grouping(category) = 1 THEN 'total' WHEN grouping(subcategory) = 1 THEN 'category' ELSE 'subcategory' END AS level,
  file, category, subcategory, count(*) AS records, count(DISTINCT product) AS unique_products
FROM stats_rows GROUP BY GROUPING SETS ((), (category), (category, subcategory), (file), (file, category), (file, category, subcategory))""")
def listing_stats(spark, sf):
    rows = I.raw(spark, sf).withColumn("file", F.concat(F.lit("carr_"), "date", F.lit(".csv")))
    return stats.listing_stats(rows)


BLANK_ROWS = f"""
blank_rows AS (
  SELECT 'carr_' || date || '.csv' AS file, replace(name, ' ', chr(160)) AS name, replace(category, ' > ', chr(160) || ' > ' || chr(160)) AS category FROM raw),
pieces AS (
  SELECT file, lower(trim(regexp_replace(name, '[\\s\\x{{a0}}]+', ' ', 'g'))) AS product,
    list_filter(list_transform(string_split(coalesce(category, ''), '>'), lambda x: regexp_replace(x, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')), lambda x: x <> '') AS parts FROM blank_rows),
named AS (
  SELECT file, product, CASE WHEN len(parts) = 0 THEN '(missing)' ELSE parts[1] END AS category,
    CASE WHEN len(parts) = 0 THEN '(missing)' WHEN len(parts) = 1 THEN '(none)' ELSE array_to_string(parts[2:], ' > ') END AS subcategory FROM pieces)"""


@query("listing_stats_top", f"""
WITH {I.RAW}, {BLANK_ROWS},
counted AS (
  SELECT CASE WHEN grouping(file) = 0 THEN 'file' ELSE 'overall' END AS scope,
    CASE WHEN grouping(category) = 1 THEN 'total' WHEN grouping(subcategory) = 1 THEN 'category' ELSE 'subcategory' END AS level,
    file, category, subcategory, count(*) AS records, count(DISTINCT product) AS unique_products
  FROM named GROUP BY GROUPING SETS ((), (category), (category, subcategory), (file), (file, category), (file, category, subcategory)))
SELECT * FROM counted
QUALIFY row_number() OVER (PARTITION BY scope, level, file ORDER BY records DESC, category NULLS FIRST, subcategory NULLS FIRST) <= 3""")
def listing_stats_top(spark, sf):
    """The first rows of each level; non-breaking spaces count as blanks."""
    hard = "\u00a0"
    rows = I.raw(spark, sf).select(
        F.concat(F.lit("carr_"), "date", F.lit(".csv")).alias("file"), F.replace("name", F.lit(" "), F.lit(hard)).alias("name"),
        F.replace("category", F.lit(" > "), F.lit(f"{hard} > {hard}")).alias("category"), F.lit(hard).alias("product_url"),
    )
    return stats.listing_stats(rows, top=3)


@query("build_reports", f"""
WITH {MONTHLY}, {sql_refs()}, {REPORT}
SELECT 'ref_products' AS name, count(*) AS n FROM refs UNION ALL SELECT 'product_price_report', count(*) FROM report
UNION ALL SELECT 'monthly_products', count(*) FROM monthly
UNION ALL SELECT 'ref_product_price_details', count(DISTINCT (product_key, fact_date)) FROM fact""")
def build_reports(spark, sf):
    """All reports composed from the star; the tables that have SQL of their own are compared there."""
    made = models.build_reports(star_tables(spark, sf), I.AS_OF)
    names = ["ref_products", "product_price_report", "monthly_products", "ref_product_price_details"]
    counts = [made[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@query("min_max_dates", f"WITH {I.OBS} SELECT min(date)::VARCHAR AS min_date, max(date)::VARCHAR AS max_date FROM obs")
def min_max_dates(spark, sf):
    return tables.min_max_dates(I.obs(spark, sf))


@query("dev_sample", f"""
WITH {I.OBS} SELECT * FROM obs WHERE date BETWEEN DATE '{I.AS_OF}' - 30 AND DATE '{I.AS_OF}' AND name IN ('Brand#1 bolt', 'Brand#2 gear', 'Brand#3 rod')""")
def dev_sample(spark, sf):
    return files.dev_sample(I.obs(spark, sf), ["Brand#1 bolt", "Brand#2 gear", "Brand#3 rod"], I.AS_OF)


@query("scan_since", f"WITH {I.OBS} SELECT * FROM obs WHERE date > DATE '2001-10-01'")
def scan_since(spark, sf):
    return files.scan_since(I.obs(spark, sf), "2001-10-01")


@query("scan_range", f"WITH {I.OBS} SELECT * FROM obs WHERE date BETWEEN DATE '2000-01-01' AND DATE '2000-06-30'")
def scan_range(spark, sf):
    return files.scan_range(I.obs(spark, sf), "2000-01-01", "2000-06-30")


# --------------------------------------------------------------------------- files, sinks, runs

RAW_TEXT = "name, original_price, discount_price, size, category, image_url, date"


def _write_csv(df: DataFrame, path: str, *by: str) -> None:
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "header": "true"}
    writer = df.write.options(**keep)
    (writer.partitionBy(*by) if by else writer).csv(path)


def _events_raw(spark, sf) -> DataFrame:
    """The event stream as scraped text, one folder per day when written."""
    return I.table(spark, sf, "events").selectExpr(
        "concat('User ', user_id) AS name",
        "concat(replace(cast(cast(value AS decimal(18,2)) AS string), '.', ','), ' €') AS original_price",
        "cast(NULL AS string) AS discount_price", "event_type AS size", "concat('Events > ', event_type) AS category",
        "concat('https://img.example.com/', event_id, '.jpg') AS image_url", "cast(to_date(ts) AS string) AS date",
    )


def _daily_files(spark, sf, label: str, fmt: str = "parquet") -> str:
    path = scratch_path(spark, label)
    rows = _events_raw(spark, sf).withColumn("day", F.col("date")).hint("rebalance", "day")
    if fmt == "csv":
        _write_csv(rows, path, "day")
    else:
        rows.write.partitionBy("day").parquet(path)
    return path


EVENTS_RAW = """
events_raw AS (
  SELECT 'User ' || user_id AS name, replace(value::DECIMAL(18,2)::VARCHAR, '.', ',') || ' €' AS original_price, NULL::VARCHAR AS discount_price,
    event_type AS size, 'Events > ' || event_type AS category, 'https://img.example.com/' || event_id || '.jpg' AS image_url,
    ts::DATE::VARCHAR AS date FROM events)"""
EVENTS_CLEAN = f"""{EVENTS_RAW},
split AS (
  SELECT date::DATE AS date, name, size, 'Events' AS category, size AS subcategory, image_url,
    {PRICE.format('original_price')} AS original_price, NULL::DOUBLE AS discount_price, NULL::DOUBLE AS price_per_unit, NULL::VARCHAR AS unit
  FROM events_raw),
{STAGE_TAIL}"""


@query("scan_raw_csv", f"WITH {I.RAW} SELECT {RAW_TEXT} FROM raw")
def scan_raw_csv(spark, sf):
    path = scratch_path(spark, "raw-csv")
    rows = I.raw(spark, sf).select(*files.RAW_MERC.fieldNames())
    _write_csv(rows, path)
    return files.read_raw_csv(spark, path, files.RAW_MERC)


@query("scan_csv_and_parquet", f"WITH {EVENTS_RAW} SELECT * FROM events_raw")
def scan_mixed(spark, sf):
    path = scratch_path(spark, "mixed")
    rows = _events_raw(spark, sf)
    early = F.col("date") < "2024-01-15"
    _write_csv(rows.filter(early), f"{path}/csv")
    rows.filter(~early).write.parquet(f"{path}/parquet")
    return files.read_raw_mixed(spark, path, files.RAW_MERC).select(*rows.columns)


@query("mixed_layouts", f"""
WITH {EVENTS_RAW}
SELECT * REPLACE (CASE WHEN date < '2024-01-10' THEN NULL ELSE image_url END AS image_url) FROM events_raw""")
def mixed_layouts(spark, sf):
    """An old layout without images, a shuffled header, the declared layout and Parquet in one folder."""
    path = scratch_path(spark, "layouts")
    rows = _events_raw(spark, sf)
    _write_csv(rows.filter("date < '2024-01-10'").drop("image_url"), f"{path}/old")
    _write_csv(rows.filter("date BETWEEN '2024-01-10' AND '2024-01-14'").select(*reversed(rows.columns)), f"{path}/shuffled")
    _write_csv(rows.filter("date BETWEEN '2024-01-15' AND '2024-01-20'").select(*files.RAW_MERC.fieldNames()), f"{path}/declared")
    rows.filter("date > '2024-01-20'").write.parquet(f"{path}/parquet")
    return files.read_raw_mixed(spark, path, files.RAW_MERC).select(*rows.columns)


@query("snapshot_then_run", f"WITH {EVENTS_CLEAN}")
def snapshot_then_run(spark, sf):
    """Daily snapshots, with the day in the folder names only, as the source of an incremental run."""
    root = scratch_path(spark, "snapshots")
    tables.write_snapshot(_events_raw(spark, sf), f"{root}/raw")
    transform = lambda df: clean.clean_v2_merc(df, "2023-01-01", 1_000_000)
    incremental.run_incremental(spark, f"{root}/raw", f"{root}/staging", f"{root}/ledger", "merc", files.RAW_MERC, transform)
    return tables.read_table(spark, f"{root}/staging").select(*clean.STAGING.fieldNames())


@query("reprocess_empty", f"WITH {EVENTS_CLEAN}")
def reprocess_empty(spark, sf):
    """A reprocess that has no rows left leaves the table as it was."""
    root = scratch_path(spark, "empty-reprocess")
    tables.write_snapshot(_events_raw(spark, sf), f"{root}/raw")
    run = lambda transform, again: incremental.run_incremental(
        spark, f"{root}/raw", f"{root}/staging", f"{root}/ledger", "merc", files.RAW_MERC, transform, reprocess=again)
    run(lambda df: clean.clean_v2_merc(df, "2023-01-01", 1_000_000), False)
    run(lambda df: clean.clean_v2_merc(df, "2023-01-01", 1_000_000).filter("false"), True)
    return tables.read_table(spark, f"{root}/staging").select(*clean.STAGING.fieldNames())


@query("files_after_watermark", f"WITH {EVENTS_RAW} SELECT * FROM events_raw WHERE date > '2024-01-20'")
def files_after(spark, sf):
    path = _daily_files(spark, sf, "daily")
    rows = spark.read.schema(files.RAW_MERC).option("recursiveFileLookup", "true").parquet(path)
    return files.files_after(rows, "2024-01-20")


@query("newest_files", f"WITH {EVENTS_RAW} SELECT * FROM events_raw WHERE date IN (SELECT DISTINCT date FROM events_raw ORDER BY date DESC LIMIT 3)")
def newest_files(spark, sf):
    return files.newest_files(spark, _daily_files(spark, sf, "newest"), files.RAW_MERC, 3)


@query("csv_with_file_stats", f"""
WITH {EVENTS_RAW}
SELECT CASE WHEN grouping(file) = 0 THEN 'file' ELSE 'overall' END AS scope,
  CASE WHEN grouping(category) = 1 THEN 'total' WHEN grouping(subcategory) = 1 THEN 'category' ELSE 'subcategory' END AS level,
  file, category, subcategory, count(*) AS records, count(DISTINCT product) AS unique_products
FROM (SELECT 'day=' || date AS file, 'Events' AS category, size AS subcategory, lower(name) AS product FROM events_raw)
GROUP BY GROUPING SETS ((), (category), (category, subcategory), (file), (file, category), (file, category, subcategory))""")
def csv_with_file(spark, sf):
    """Statistics per day folder: Spark chooses the names of the files in it."""
    rows = files.read_csv_with_file(spark, _daily_files(spark, sf, "named", "csv") + "/*/*.csv", files.RAW_MERC)
    rows = rows.withColumn("file", F.substring_index("file", "/", 1))
    return stats.listing_stats(rows.withColumn("product_url", F.lit(None).cast("string")))


@query("file_inventory", f"WITH {EVENTS_RAW} SELECT count(DISTINCT date) AS days, true AS some_bytes, 0.3::DOUBLE AS ratio, true AS adds_up FROM events_raw")
def file_inventory(spark, sf):
    path = _daily_files(spark, sf, "inventory", "csv")
    made = files.file_inventory(spark, path)
    days = files.list_files(spark, path, "*.csv").agg(F.count_distinct(F.regexp_extract("path", "day=([^/]*)", 1)).alias("days"))
    return made.withColumn("days", days.scalar()).select(
        "days", (F.col("bytes") > 0).alias("some_bytes"), F.round(F.col("parquet_bytes") / F.col("bytes"), 6).alias("ratio"),
        (F.col("saved_bytes") + F.col("parquet_bytes") == F.col("bytes")).alias("adds_up"),
    )


MERC_HTML = (
    "concat('<html><body><h1>Order</h1>', concat_ws('', transform(array_sort(collect_list(struct(l_linenumber, name, size, text, discount_text, image_url))), "
    "x -> concat('<div class=\"product-cell\" data-testid=\"product-cell\">', coalesce(concat('<img loading=\"lazy\" src=\"', x.image_url, '\">'), ''), "
    "'<h4 data-testid=\"product-cell-name\"> ', x.name, ' &amp; co </h4><div class=\"product-format product-format__size\"><span>', x.size, ' </span><span>1 kg</span></div>', "
    "'<p data-testid=\"product-price\"> ', x.text, '</p>', coalesce(concat('<p class=\"d\" data-testid=\"product-price\">', x.discount_text, '</p>'), ''), "
    "'</div>'))), '</body></html>')"
)
CARR_HTML = (
    "concat('<main>', concat_ws('', transform(array_sort(collect_list(struct(l_linenumber, name, text, discount_text, unit_text, image_url))), "
    "x -> concat('<div class=\"product-card__parent\"><h2 class=\"product-card__title\"><a class=\"product-card__title-link\" href=\"/p/', replace(x.name, ' ', '-'), '\">', x.name, '</a></h2>', "
    "CASE WHEN x.discount_text IS NULL THEN concat('<span class=\"product-card__price\">', x.text, '</span>') "
    "ELSE concat('<span class=\"product-card__price--strikethrough\">', x.text, '</span><span class=\"product-card__price--current\">', x.discount_text, '</span>') END, "
    "'<span class=\"product-card__price-per-unit\">', x.unit_text, '</span>', "
    "coalesce(concat('<img class=\"product-card__image\" src=\"', x.image_url, '#main\">'), ''), '</div>'))), '</main>')"
)


def _listing_pages(spark, sf, html: str) -> DataFrame:
    """The given pages, and one listing page per order (an order has a bounded number of lines)."""
    euro = "concat(replace(cast(cast({0} AS decimal(18,2)) AS string), '.', ','), ' €')"
    rows = I.obs(spark, sf).selectExpr(
        "*", euro.format("original_price") + " AS text", euro.format("discount_price") + " AS discount_text",
        f"concat({euro.format('price_per_unit')}, '/', unit) AS unit_text",
    )
    orders = rows.groupBy("l_orderkey").agg(F.expr(html).alias("html"))
    listings_pages = orders.selectExpr("concat('https://shop.example.com/order/', l_orderkey) AS url", "html")
    return I.table(spark, sf, "pages").select("url", "html").unionByName(listings_pages)


SQL_EURO = "replace({0}::DECIMAL(18,2)::VARCHAR, '.', ',') || ' €'"


@query("extract_listings_merc", f"""
WITH {I.OBS}
SELECT name || ' & co' AS name, {SQL_EURO.format('original_price')} AS original_price, {SQL_EURO.format('discount_price')} AS discount_price,
  size || ' 1 kg' AS size, 'https://shop.example.com/order/' || l_orderkey AS category,
  CASE WHEN image_url LIKE 'http%' THEN regexp_replace(image_url, '[?].*$', '') END AS image_url FROM obs""")
def extract_merc(spark, sf):
    return listings.extract_listings(_listing_pages(spark, sf, MERC_HTML), "merc", F.col("url"))


@query("extract_listings_carr", f"""
WITH {I.OBS}
SELECT name, {SQL_EURO.format('original_price')} AS original_price, {SQL_EURO.format('discount_price')} AS discount_price,
  {SQL_EURO.format('price_per_unit')} || '/' || unit AS price_per_unit, 'Bebidas' AS category,
  CASE WHEN image_url LIKE 'http%' THEN regexp_replace(image_url, '[?#].*$', '') END AS image_url,
  'https://shop.example.com/p/' || replace(name, ' ', '-') AS product_url, 'https://shop.example.com/order/' || l_orderkey AS source_page FROM obs""")
def extract_carr(spark, sf):
    pages = _listing_pages(spark, sf, CARR_HTML)
    return listings.extract_listings(pages, "carr", F.lit("Bebidas"), "https://shop.example.com")


@query("append_daily", f"WITH {I.EVENTS_STG} SELECT {I.STG_COLUMNS}, 'b' AS batch FROM events_stg")
def append_daily(spark, sf):
    path = scratch_path(spark, "staging")
    rows = I.events_stg(spark, sf).withColumn("batch", F.lit("b"))
    early = F.col("date") < "2024-01-15"
    tables.append_daily(rows.filter(early), path, clean.STAGING)
    tables.append_daily(rows.filter(~early), path, clean.STAGING)
    return tables.read_table(spark, path).select(*clean.STAGING.fieldNames(), "batch")


@query("reprocess_table", f"WITH {I.EVENTS_STG} SELECT {I.STG_COLUMNS} FROM events_stg")
def reprocess(spark, sf):
    path = scratch_path(spark, "reprocess")
    rows = I.events_stg(spark, sf)
    tables.append_daily(rows, path, clean.STAGING)
    tables.append_daily(rows, path, clean.STAGING, reprocess=True)
    return tables.read_table(spark, path).select(*clean.STAGING.fieldNames())


@query("overwrite_partitions", f"""
WITH {I.EVENTS_STG} SELECT date, name, size, CASE WHEN date >= DATE '2024-01-20' THEN price * 2 ELSE price END AS price FROM events_stg""")
def overwrite_partitions(spark, sf):
    path = scratch_path(spark, "partitions")
    rows = I.events_stg(spark, sf).select("date", "name", "size", "price")
    tables.overwrite_partitions(rows, path, "date")
    late = rows.filter("date >= DATE '2024-01-20'").withColumn("price", F.col("price") * 2)
    tables.overwrite_partitions(late, path, "date", ("name",))
    return tables.read_table(spark, path)


@query("upsert", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS c_name, CASE WHEN c_custkey % 2 = 0 THEN 'new' END AS note FROM customer""")
def upsert(spark, sf):
    path = scratch_path(spark, "upsert")
    rows = I.table(spark, sf, "customer").select("c_custkey", "c_name")
    tables.upsert(spark, path, rows, "c_custkey")
    changed = rows.filter("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), F.lit("new").alias("note"))
    tables.upsert(spark, path, changed, "c_custkey")
    return tables.read_current(spark, path)


@query("upsert_buckets", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 100 = 1 THEN 0.0 WHEN o_orderkey % 64 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 64 = 2 AND o_orderkey % 100 <> 1 THEN 'second' END AS note
FROM orders""")
def upsert_buckets(spark, sf):
    """Three merges, of which the second adds a column, into a table of 64 buckets."""
    path = scratch_path(spark, "upsert-buckets")
    rows = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.upsert(spark, path, rows.filter("o_orderkey % 7 <> 0"), "o_orderkey", buckets=64)
    second = rows.filter("o_orderkey % 64 = 2").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("second").alias("note"))
    tables.upsert(spark, path, rows.filter("o_orderkey % 7 = 0"), "o_orderkey")
    tables.upsert(spark, path, second, "o_orderkey")
    tables.upsert(spark, path, rows.filter("o_orderkey % 100 = 1").withColumn("o_totalprice", F.lit(0.0)), "o_orderkey")
    return tables.read_current(spark, path)


@query("sync_columns", "SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS note FROM orders")
def sync_columns(spark, sf):
    target = spark.createDataFrame([], "o_orderkey long, o_totalprice double, note string").schema
    return tables.sync_columns(I.table(spark, sf, "orders"), target)


@query("publish_copy", f"WITH {PRODUCTS} SELECT * FROM products")
def publish_copy(spark, sf):
    path = scratch_path(spark, "published")
    tables.publish(products(spark, sf), path, ["id"])
    return spark.read.parquet(path)


@query("stored_search_index", f"WITH {PRODUCTS}, {INDEX} SELECT token, id FROM tokens WHERE token LIKE 'g%'")
def stored_index(spark, sf):
    path = scratch_path(spark, "tokens")
    token_index.write_index(search.build_search_index(products(spark, sf)), path)
    return token_index.read_index(spark, path, ["g*"])


REFRESHED = PRODUCTS.replace("p_brand || ' Jamón ' || p_name AS name", "CASE WHEN p_partkey % 20 = 3 THEN 'Zumo ' || p_name ELSE p_brand || ' Jamón ' || p_name END AS name").replace("FROM part)", "FROM part WHERE p_partkey % 20 <> 7)")


def _refreshed_index(spark, sf) -> tuple[str, DataFrame]:
    """An index over a part of the products, brought up to date with new, changed and removed ones, merged in between."""
    path = scratch_path(spark, "tokens")
    number = F.col("id").cast("long")
    now = products(spark, sf).withColumn("name", F.when(number % 20 == 3, F.concat(F.lit("Zumo "), F.substring_index("name", "Jamón ", -1))).otherwise(F.col("name")))
    token_index.refresh_index(products(spark, sf).filter(number % 10 != 1), path)
    token_index.refresh_index(now.filter(number % 10 != 1), path)
    token_index.merge_index(spark, path)
    now = now.filter(number % 20 != 7)
    token_index.refresh_index(now, path)
    return path, now


@query("refreshed_search_index", f"WITH {REFRESHED}, {INDEX} SELECT token, id FROM tokens")
def refreshed_index(spark, sf):
    path, _ = _refreshed_index(spark, sf)
    return token_index.read_index(spark, path)


@query("search_refreshed", f"""
WITH {REFRESHED}, {INDEX}
SELECT * FROM products WHERE id IN (SELECT id FROM tokens WHERE token = 'zumo') AND id IN (SELECT id FROM tokens WHERE token LIKE 'wi%')""")
def search_refreshed(spark, sf):
    path, now = _refreshed_index(spark, sf)
    return token_index.search_stored(now, path, "Zumo wi")


@query("write_snapshot", f"WITH {I.EVENTS_STG} SELECT {I.STG_COLUMNS} FROM events_stg")
def write_snapshot(spark, sf):
    return tables.write_snapshot(I.events_stg(spark, sf), scratch_path(spark, "snapshot")).select(*clean.STAGING.fieldNames())


@query("write_snapshot_csv", f"WITH {EVENTS_RAW} SELECT * FROM events_raw")
def write_snapshot_csv(spark, sf):
    rows = _events_raw(spark, sf)
    path = scratch_path(spark, "snapshot-csv")
    tables.write_snapshot(rows, path, "csv", partition=None)
    return files.read_raw_csv(spark, path, rows.schema)


@query("migrate_csv", f"WITH {EVENTS_RAW} SELECT * REPLACE (date::DATE AS date) FROM events_raw")
def migrate_csv(spark, sf):
    source, target = _daily_files(spark, sf, "old", "csv"), scratch_path(spark, "new")
    tables.migrate_csv(spark, source, target, files.RAW_MERC)
    return spark.read.parquet(target).select(*[c for c in files.RAW_MERC.fieldNames()])


@query("migrate_report", f"""
WITH {EVENTS_RAW} SELECT 0::BIGINT AS failed_files, true AS bytes_before, true AS bytes_after, 0::BIGINT AS named, count(*) AS n FROM events_raw""")
def migrate_report(spark, sf):
    source, target = _daily_files(spark, sf, "old-report", "csv"), scratch_path(spark, "new-report")
    told = tables.migrate_csv(spark, source, target, files.RAW_MERC)
    rows = spark.read.parquet(target).select(F.count("*")).scalar()
    return told.select(
        "failed_files", (F.col("csv_bytes") > 0).alias("bytes_before"), (F.col("parquet_bytes") > 0).alias("bytes_after"),
        F.size("failed").cast("long").alias("named"), rows.alias("n"),
    )


@query("run_by_retailer", f"""
WITH {EVENTS_CLEAN.replace("'Events' AS category, size AS subcategory", "NULL::VARCHAR AS category, NULL::VARCHAR AS subcategory")}""")
def run_by_retailer(spark, sf):
    """The transform is found by the retailer's name; no row is newer than its label day, so labels are null."""
    root = scratch_path(spark, "by-name")
    tables.write_snapshot(_events_raw(spark, sf), f"{root}/raw")
    incremental.run_incremental(spark, f"{root}/raw", f"{root}/staging", f"{root}/ledger", "merc", files.RAW_MERC)
    return tables.read_table(spark, f"{root}/staging").select(*clean.STAGING.fieldNames())


@query("empty_staging", f"WITH {I.EVENTS_STG} SELECT {I.STG_COLUMNS} FROM events_stg")
def empty_staging(spark, sf):
    return clean.empty_staging(spark).unionByName(I.events_stg(spark, sf))


@query("write_batches", f"WITH {I.EVENTS_STG} SELECT {I.STG_COLUMNS}, count(*) OVER () AS sent FROM events_stg")
def write_batches(spark, sf):
    path = scratch_path(spark, "batches")
    sent = tables.write_batches(I.events_stg(spark, sf), path, 1000)
    return spark.read.parquet(path).withColumn("sent", F.lit(sent).cast("long"))


@query("report_json", """SELECT to_json({'o_orderkey': o_orderkey, 'day': o_orderdate::DATE::VARCHAR}) AS json FROM orders""")
def report_json(spark, sf):
    return tables.report_json(I.table(spark, sf, "orders").selectExpr("o_orderkey", "to_date(o_orderdate) AS day"))


@query("incremental_run", f"WITH {EVENTS_CLEAN}")
def incremental_run(spark, sf):
    root = scratch_path(spark, "runs")
    source, target, log = f"{root}/raw", f"{root}/staging", f"{root}/ledger"
    days = _events_raw(spark, sf).withColumn("day", F.col("date"))

    def deliver(rows):
        rows.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(source)

    def run():
        return incremental.run_incremental(
            spark, source, target, log, "merc", files.RAW_MERC, lambda df: clean.clean_v2_merc(df, "2023-01-01", 1_000_000)
        )

    deliver(days.filter("date <= '2024-01-15'"))
    run()
    deliver(days.filter("date > '2024-01-15'"))
    run()
    run()
    return tables.read_table(spark, target).select(*clean.STAGING.fieldNames())


@query("ledger_of_runs", """
SELECT 'merc' AS product, CASE WHEN d <= DATE '2024-01-15' THEN 1 ELSE 2 END::BIGINT AS id, min(d)::VARCHAR AS min_date, max(d)::VARCHAR AS max_date
FROM (SELECT ts::DATE AS d FROM events) GROUP BY 2""")
def ledger_of_runs(spark, sf):
    path = scratch_path(spark, "ledger")
    for part in ("date <= '2024-01-15'", "date > '2024-01-15'"):
        bounds = tables.min_max_dates(I.events_stg(spark, sf).filter(part)).first()
        ledger.ledger_append(spark, path, "merc", "raw", "staging", bounds.min_date, bounds.max_date)
    return ledger.read_ledger(spark, path).select("product", "id", "min_date", "max_date")


@query("ledger_last", """
SELECT 'merc' AS product, min(d)::VARCHAR AS min_date, max(d)::VARCHAR AS max_date
FROM (SELECT ts::DATE AS d FROM events) WHERE d > DATE '2024-01-15'""")
def ledger_last(spark, sf):
    path = scratch_path(spark, "ledger")
    for product, part in (("merc", "date <= '2024-01-15'"), ("merc", "date > '2024-01-15'"), ("carr", "date < '2024-01-03'")):
        bounds = tables.min_max_dates(I.events_stg(spark, sf).filter(part)).first()
        ledger.ledger_append(spark, path, product, "raw", "staging", bounds.min_date, bounds.max_date)
    last = ledger.ledger_last(ledger.read_ledger(spark, path), product="merc", data_source="raw", destination="staging")
    return last.select("product", "min_date", "max_date")


@query("publish_run", "SELECT user_id AS id, ts::DATE AS date, min(value) AS price FROM events GROUP BY 1, 2")
def publish_run(spark, sf):
    root = scratch_path(spark, "publish")
    history = refs.dedup_daily(I.daily(spark, sf))

    def task(rows):
        return [incremental.PublishTask(rows, "details", f"{root}/details", ["date", "id"], incremental=True)]

    incremental.run_publish(spark, task(history.filter("date <= DATE '2024-01-10'")), f"{root}/ledger")
    incremental.run_publish(spark, task(history), f"{root}/ledger")
    incremental.run_publish(spark, task(history), f"{root}/ledger", overlap_days=5)
    return spark.read.parquet(f"{root}/details")


@query("publish_changed_days", """
SELECT user_id AS id, ts::DATE AS date, min(value) AS price, ts::DATE >= DATE '2024-01-20' OR ts::DATE = DATE '2024-01-05' AS copied_last
FROM events WHERE ts::DATE <> DATE '2024-01-03' GROUP BY 1, 2""")
def publish_changed_days(spark, sf):
    """A first copy without the last days and with other prices on one day and one day too many; the second copies what differs."""
    path = f"{scratch_path(spark, 'changed')}/details"
    history = refs.dedup_daily(I.daily(spark, sf))
    price = F.when(F.col("date") == "2024-01-05", F.col("price") + 1).otherwise(F.col("price"))
    incremental.publish_changed(history.filter("date < DATE '2024-01-20'").withColumn("price", price), path, ["date", "id"])
    days = incremental.publish_changed(history.filter("date <> DATE '2024-01-03'"), path, ["date", "id"])
    return spark.read.parquet(path).withColumn("copied_last", F.col("date").cast("string").isin(days))


@query("stored_models_refresh", f"""
WITH {I.EVENTS_STG}, lowest AS (SELECT name, size, date, min(price) AS price FROM events_stg GROUP BY 1, 2, 3),
months AS (
  SELECT name, size, date_trunc('month', date)::DATE AS year_month_period, arg_min(price, row(date, dedup_id)) AS earliest_price,
    arg_max(price, row(date, dedup_id)) AS latest_price FROM events_stg GROUP BY 1, 2, 3),
last AS (SELECT name, size, arg_max(price, date) AS report_price, max(date) AS latest_date, count(*) AS days FROM lowest GROUP BY 1, 2),
first AS (SELECT name, size, price AS mtd_price FROM lowest WHERE date = DATE '2024-01-01')
SELECT name, size, days, latest_date, report_price, mtd_price, earliest_price, latest_price,
  {sql_variation('latest_price', 'earliest_price')} AS price_variation_percent
FROM last JOIN months USING (name, size) LEFT JOIN first USING (name, size)""")
def stored_models(spark, sf):
    """Two runs over stored tables: the first half of the month, then the overlap and the rest."""
    root = scratch_path(spark, "models")
    rows = I.events_stg(spark, sf)
    calendar = {"start": "2024-01-01", "end": "2024-02-01"}
    models.refresh(spark, rows.filter("date < DATE '2024-01-16'"), root, "2024-01-15", **calendar)
    t = models.refresh(spark, rows, root, I.EVENTS_AS_OF, **calendar)
    days = t["ref_product_price_details"].groupBy("id").agg(F.count(F.lit(1)).alias("days"))
    report = t["product_price_report"].select(
        F.col("product_key").alias("id"), "name", "size", "latest_date", F.col("latest_price").alias("report_price"), "mtd_price"
    )
    monthly = t["monthly_products"].select(
        F.col("product_key").alias("id"), "earliest_price", "latest_price", "price_variation_percent"
    )
    return report.join(days, "id").join(monthly, "id").drop("id")


@query("stream_ingest", f"WITH {EVENTS_CLEAN}")
def stream_ingest(spark, sf):
    root = scratch_path(spark, "stream")
    source = _daily_files(spark, sf, "stream-source")
    # a day lies in several files, and a batch takes one third of them
    parts = f"{root}/parts"
    rows = spark.read.schema(files.RAW_MERC).option("recursiveFileLookup", "true").parquet(source)
    for i in range(3):
        rows.filter(F.pmod(F.xxhash64("image_url"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(parts)
    stream = ingest.read_stream(spark, parts, files.RAW_MERC, max_files=1)
    transform = lambda batch: clean.clean_v2_merc(batch, "2023-01-01")
    ingest.ingest(stream, transform, f"{root}/staging", f"{root}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{root}/staging").select(*clean.STAGING.fieldNames())


@query("stream_daily_lowest", "SELECT user_id AS id, ts::DATE AS date, min(value) AS price FROM events GROUP BY 1, 2")
def stream_daily_lowest(spark, sf):
    root = scratch_path(spark, "lowest")
    source = f"{root}/source"
    events = I.table(spark, sf, "events").selectExpr("user_id", "cast(ts AS timestamp) AS ts", "value")
    # the second batch brings late rows of all days
    for i in (1, 0):
        events.filter(F.pmod(F.xxhash64("user_id", "ts"), F.lit(2)) == i).coalesce(1).write.mode("append").parquet(source)
    stream = ingest.read_stream(spark, source, events.schema, max_files=1)
    ingest.daily_lowest(stream, f"{root}/days", f"{root}/checkpoint", "user_id", "ts", "value").awaitTermination()
    return spark.read.parquet(f"{root}/days").select("id", "date", "price")
