"""Cleaning raw price rows: parsing, labels, categories, duplicates, price history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions import parse_price, parse_unit, parse_unit_amount, standardize
from pricelake.operators.numbering import HOT_GROUP_ROWS, number_duplicates, stored

STAGING = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("dedup_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("original_price", T.DoubleType()),
        T.StructField("discount_price", T.DoubleType()),
        T.StructField("price_per_unit", T.DoubleType()),
        T.StructField("unit", T.StringType()),
    ]
)
HISTORY_COLUMNS = [
    "date", "dedup_id", "name", "size", "category", "subcategory", "original_price", "prev_original_price",
    "discount_price", "is_fake_discount", "inflation_percent", "inflation_abs",
]
GROUP = ["date", "name", "size", "category", "subcategory"]
PRICES = ["original_price", "discount_price"]
# Fixed value: labels seen after this day replace older ones.
RECATEGORIZED_ON = "2024-11-05"


def empty_staging(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STAGING)


def ensure_columns(df: DataFrame, types: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Add the absent columns with a typed default (null unless given); existing ones stay as they are."""
    defaults = defaults or {}
    return df.withColumns({c: F.lit(defaults.get(c)).cast(t) for c, t in types.items() if c not in df.columns})


def parse_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """Text YYYY-MM-DD to date; a bad value is an error under ANSI."""
    if dict(df.dtypes)[column] == "date":
        return df
    return df.withColumn(column, F.to_date(column, "yyyy-MM-dd"))


def parse_prices(df: DataFrame, columns: Sequence[str] = PRICES, inner_spaces: bool = True) -> DataFrame:
    df = ensure_columns(df, {c: "string" for c in columns})
    return df.withColumns({c: parse_price(F.col(c).cast("string"), inner_spaces) for c in columns})


def parse_unit_price(df: DataFrame, column: str = "price_per_unit") -> DataFrame:
    text = F.col(column).cast("string")
    return df.withColumns({"unit": parse_unit(text), column: parse_unit_amount(text)})


def split_category(df: DataFrame, fallback: str | None = None) -> DataFrame:
    """Category path to category and subcategory.

    Without `fallback` the second piece is the subcategory and more pieces are lost. With
    `fallback="category"` all after the first separator is kept, and the category stands in when there is none.
    """
    df = ensure_columns(df, {"category": "string"})
    pieces = F.split("category", " > ", 2 if fallback else -1)
    second = F.get(pieces, F.lit(1))
    if fallback:
        second = F.coalesce(second, F.get(pieces, F.lit(0)))
    return df.withColumns({"subcategory": second, "category": F.get(pieces, F.lit(0))})


def standardize_text(df: DataFrame, columns: Sequence[str], collapse: bool = False) -> DataFrame:
    df = ensure_columns(df, {c: "string" for c in columns})
    return df.withColumns({c: standardize(c, collapse) for c in columns})


def recent_labels(df: DataFrame, cutoff: str) -> DataFrame:
    """The (category, subcategory) pairs each (name, size) carries after `cutoff`."""
    columns = [F.col(c).alias(f"_{c}") for c in ("name", "size", "category", "subcategory")]
    return df.filter(F.col("date") > F.lit(cutoff).cast("date")).select(*columns).distinct()


def label_classes(df: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Labels that give the same duplicate numbers, so that rows are numbered once for a class of labels instead of once for each.

    Spellings of (name, size) that standardise alike are one product. Two standardised labels of a product are of one class when the same
    spellings carry them, equally often: their rows are the same. The smallest label stands for its class. Returned are the standing labels
    of each spelling, in the columns of `recent_labels` (one row for each time a spelling carries it; null where it carries none), and all
    standardised labels of each class. A list holds the labels of a product or the spellings of one.
    """
    keys, labels, both = ["name", "size"], ["category", "subcategory"], ["name", "size", "category", "subcategory"]
    seen = F.max(F.coalesce(F.col("date") > F.lit(cutoff).cast("date"), F.lit(False))).alias("_recent")
    carried = F.collect_list(F.when(F.col("_recent"), F.struct(*labels))).alias("_labels")
    none = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in labels]))
    spelt = df.groupBy(*both).agg(seen).groupBy(*keys).agg(carried)
    spelt = spelt.select(*keys, F.explode(F.when(F.size("_labels") > 0, F.col("_labels")).otherwise(none)).alias("_label"))
    spelt = spelt.select(F.struct(*keys).alias("_spelling"), *keys, *[F.col(f"_label.{c}").alias(c) for c in labels])
    counted = standardize_text(spelt, both).groupBy("_spelling", *both).agg(F.count(F.lit(1)).alias("_times"))
    held = counted.groupBy(*both).agg(F.sort_array(F.collect_list(F.struct("_spelling", "_times"))).alias("_spellings"))
    classes = held.groupBy(*keys, "_spellings").agg(F.sort_array(F.collect_list(F.struct(*labels))).alias("_labels"))
    classes = stored(classes.withColumn("_class", F.col("_labels")[0]), "label-classes")
    standing = [F.col(f"_class.{c}").alias(f"_{c}") for c in labels]
    each = classes.select(F.explode("_spellings").alias("_s"), *standing)
    each = each.select(*[F.col(f"_s._spelling.{c}").alias(f"_{c}") for c in keys], "_category", "_subcategory", F.col("_s._times").alias("_times"))
    each = each.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).drop("_time", "_times")
    members = classes.select(*[F.col(c).alias(f"_{c}") for c in keys], *standing, F.explode("_labels").alias("_label"))
    return each, members


def recategorize(
    df: DataFrame, cutoff: str = RECATEGORIZED_ON, null_safe: bool = False, keep_old: bool = False,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Give every row the labels its (name, size) carries after `cutoff`, and drop exact copies.

    A product with several recent labels yields one row per label; one without any gets null labels, or its old
    ones with `keep_old`. Copies are dropped before the join, since distinct rows times distinct labels stay
    distinct. The join is left to AQE: it broadcasts the labels only when their measured size allows, and else
    splits a product that holds many rows. `labels` stands in for `recent_labels`.
    """
    labels = recent_labels(df, cutoff) if labels is None else labels
    if keep_old:
        joined = _join_labels(df.distinct(), labels, null_safe)
        seen = F.col("_subcategory").isNotNull() | F.col("_category").isNotNull()
        columns = {c: F.when(seen, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("category", "subcategory")}
        # Old labels that were replaced can leave copies. The explicit shuffle keeps the join free to be split.
        return joined.withColumns(columns).select(*df.columns).repartition(*df.columns).distinct()
    rows = df.drop("category", "subcategory").distinct()
    return _relabelled(_join_labels(rows, labels, null_safe)).select(*df.columns)


def _join_labels(rows: DataFrame, labels: DataFrame, null_safe: bool) -> DataFrame:
    if null_safe:
        same = F.col("name").eqNullSafe(F.col("_name")) & F.col("size").eqNullSafe(F.col("_size"))
    else:
        same = (F.col("name") == F.col("_name")) & (F.col("size") == F.col("_size"))
    return rows.join(labels, same, "left")


def _relabelled(joined: DataFrame) -> DataFrame:
    return joined.withColumns({"category": F.col("_category"), "subcategory": F.col("_subcategory")})


def add_price(df: DataFrame) -> DataFrame:
    """The price paid: the discount price when there is one."""
    return df.withColumn("price", F.coalesce("discount_price", "original_price"))


def round_prices(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Round half to even."""
    return df.withColumns({c: F.bround(F.col(c).cast("double"), digits) for c in columns})


def add_prev_price(
    df: DataFrame, within: Sequence[str] = ("category", "subcategory", "original_price", "discount_price")
) -> DataFrame:
    """Original price in the previous row of (name, size, dedup_id), by date, then by the columns `within` a date.

    One dedup_id holds a (date, category, subcategory) once, so a window group grows with days and labels
    only, not with the number of rows of a product.
    """
    history = Window.partitionBy("name", "size", "dedup_id").orderBy("date", *within)
    return df.withColumn("prev_original_price", F.lag("original_price").over(history))


def add_inflation(df: DataFrame) -> DataFrame:
    now, before = F.col("original_price"), F.col("prev_original_price")
    return df.withColumns({"inflation_percent": F.try_divide(now, before) - 1, "inflation_abs": now - before})


def add_fake_discount(df: DataFrame) -> DataFrame:
    """True when the "discounted" price is the previous regular price; otherwise null, never false."""
    return df.withColumn(
        "is_fake_discount", F.when(F.col("discount_price") == F.col("prev_original_price"), F.lit(True))
    )


def clean_v1(df: DataFrame, cutoff: str = RECATEGORIZED_ON, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Raw rows to the table with price history (previous price, inflation, fake discounts).

    All rows of a (date, name, size) receive the same labels, so they are numbered before the labels multiply
    them: the numbers within each label are the same. The previous price is looked up before, too: the row of the first label has the
    price of the day before, that of each later label has the price of its own row, which stands before it with the label before.
    """
    labels = ["name", "size", "category", "subcategory"]
    typed = (
        parse_prices(df, inner_spaces=False)
        .transform(split_category)
        .transform(standardize_text, labels, collapse=True)
        .select("date", *labels, *PRICES)
    )
    numbered = number_duplicates(
        typed.select("date", "name", "size", *PRICES), ["date", "name", "size"], PRICES,
        hot_rows=hot_rows, drop_copies=True,
    )
    # by a struct: rows dealt for this window would count as dealt for the join, which AQE could then not split
    by_label = Window.partitionBy(F.struct("_name", "_size")).orderBy("_category", "_subcategory")
    recent = recent_labels(typed, cutoff).withColumn("_later", F.row_number().over(by_label) > 1)
    priced = numbered.transform(add_prev_price, within=PRICES)
    return (
        _relabelled(_join_labels(priced, recent, null_safe=False))
        .withColumn("prev_original_price", F.when(F.col("_later"), F.col("original_price")).otherwise(F.col("prev_original_price")))
        .transform(add_inflation)
        .transform(add_fake_discount)
        .select(*HISTORY_COLUMNS)
    )


def clean_v2_merc(df: DataFrame, cutoff: str = RECATEGORIZED_ON, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """First retailer: raw rows to staging. Labels are replaced on the raw text, before it is standardised.

    Rows are numbered once for each class of labels; a class's labels multiply them last, on their way out.
    """
    df = ensure_columns(df, {"size": "string", "image_url": "string", "price_per_unit": "double", "unit": "string"})
    split = df.transform(parse_dates).transform(parse_prices).transform(split_category, "category")
    standing, members = label_classes(split, cutoff)
    rows = _stage(recategorize(split, cutoff, null_safe=True, labels=standing), hot_rows, ["name", "size", "unit"])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("name", "size", "category", "subcategory")]
    columns = {c: F.col(f"_label.{c}") for c in ("category", "subcategory")}
    return rows.join(members, same).withColumns(columns).select(*STAGING.names)


def clean_v2_carr(df: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Second retailer: raw rows with a price per unit to staging."""
    absent = {c: "string" for c in ("size", "image_url", "discount_price", "price_per_unit")}
    split = (
        ensure_columns(df, absent)
        .transform(parse_unit_price)
        .transform(parse_dates)
        .transform(parse_prices)
        .transform(split_category, "category")
    )
    return _stage(split, hot_rows)


def _stage(df: DataFrame, hot_rows: int, labels: Sequence[str] = ("name", "size", "category", "subcategory", "unit")) -> DataFrame:
    prices = [*PRICES, "price_per_unit"]
    return (
        standardize_text(df, labels)
        .transform(round_prices, prices)
        .select(*GROUP, "image_url", *prices, "unit")
        .transform(number_duplicates, GROUP, prices, hot_rows=hot_rows)
        .transform(add_price)
        .select(*[F.col(f.name).cast(f.dataType) for f in STAGING])
    )


# The transforms by retailer.
CLEANERS = {"merc": clean_v2_merc, "carr": clean_v2_carr}
