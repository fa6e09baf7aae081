import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricelake.operators import clean
from pricelake.operators.numbering import number_duplicates
from pricelake.sources.files import RAW_CARR, RAW_V1

D = dt.date


def test_split_category(spark):
    df = spark.createDataFrame([("a > b",), ("a",), (None,), ("a > b > c",)], "category string")
    first = clean.split_category(df).select("category", "subcategory").collect()
    assert [tuple(r) for r in first] == [("a", "b"), ("a", None), (None, None), ("a", "b")]
    kept = clean.split_category(df, "category").select("category", "subcategory").collect()
    assert [tuple(r) for r in kept] == [("a", "b"), ("a", "a"), (None, None), ("a", "b > c")]
    absent = clean.split_category(df.select(F.lit(1).alias("x")), "category")
    assert {tuple(r) for r in absent.select("category", "subcategory").collect()} == {(None, None)}


def test_dates_are_strict(spark):
    good = spark.createDataFrame([("2024-02-29",)], "date string")
    assert clean.parse_dates(good).first()[0] == D(2024, 2, 29)
    with pytest.raises(PySparkException):
        clean.parse_dates(spark.createDataFrame([("29/02/2024",)], "date string")).collect()


def test_ensure_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    got = clean.ensure_columns(df, {"a": "string", "b": "double", "c": "string"}, {"c": "x"})
    assert got.dtypes == [("a", "int"), ("b", "double"), ("c", "string")] and tuple(got.first()) == (1, None, "x")


def test_price_and_rounding(spark):
    df = spark.createDataFrame([(1.005, None), (2.345, 0.125), (None, None)], "original_price double, discount_price double")
    got = clean.round_prices(clean.add_price(df), ["price", "discount_price"]).collect()
    assert [(r.price, r.discount_price) for r in got] == [(1.0, None), (0.12, 0.12), (None, None)]


def test_number_duplicates_orders_and_groups_nulls(spark):
    day = D(2024, 1, 1)
    df = spark.createDataFrame(
        [(day, "a", None, 2.0), (day, "a", None, 1.0), (day, "a", "x", 5.0), (day, "a", "x", 5.0)],
        "date date, name string, size string, original_price double")
    got = number_duplicates(df, ["date", "name", "size"], ["original_price"])
    assert rows(got, "size", "original_price", "dedup_id") == [(None, 1.0, 1), (None, 2.0, 2), ("x", 5.0, 1), ("x", 5.0, 2)]
    once = number_duplicates(df, ["date", "name", "size"], ["original_price"], drop_copies=True)
    assert once.count() == 3


@pytest.mark.parametrize("hot_rows", [7, 50, 1000, 1_000_000])
def test_number_duplicates_same_on_every_way(spark, hot_rows):
    """A third of the rows in one group, another third copies of one row; against brute force."""
    rng = random.Random(hot_rows)
    data = [("hot", rng.choice([1.0, 2.0]), f"u{rng.randrange(200)}") for _ in range(400)]
    data += [("copies", 3.0, "same")] * 400
    data += [(f"k{rng.randrange(150)}", rng.choice([None, 1.0]), rng.choice([None, "a", "b"])) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, price double, url string")
    got = number_duplicates(df, ["k"], ["price"], hot_rows=hot_rows).collect()

    import hashlib

    def key(r):
        digest = hashlib.md5((r[2] or "").encode()).hexdigest()
        return (r[1] is not None, r[1] or 0, digest, r[2] is not None, r[2] or "")

    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    expected = sorted((str((*r, i + 1)) for g in groups.values() for i, r in enumerate(sorted(g, key=key))))
    assert sorted(str(tuple(r)) for r in got) == expected


def _history(spark, data):
    return spark.createDataFrame(data, "date date, name string, size string, category string, subcategory string")


def test_recategorize(spark):
    old, new = D(2024, 10, 1), D(2024, 11, 6)
    df = _history(spark, [
        (old, "a", "1", "old", "x"), (new, "a", "1", "new", "y"),
        (old, "gone", "1", "old", "x"),
        (old, "two", "1", "old", "x"), (new, "two", "1", "n1", "y"), (new, "two", "1", "n2", "y"),
        (new, "nosize", None, "new", "z"),
        (old, "a", "1", "old", "x"),
    ])
    got = rows(clean.recategorize(df), "name", "date", "category")
    assert got == sorted([
        ("a", old, "new"), ("a", new, "new"), ("gone", old, None), ("two", old, "n1"), ("two", old, "n2"),
        ("two", new, "n1"), ("two", new, "n2"), ("nosize", new, None),
    ], key=lambda r: [(v is not None, str(v)) for v in r])
    safe = {(r.name, r.category) for r in clean.recategorize(df, null_safe=True).collect()}
    assert ("nosize", "new") in safe and ("gone", None) in safe
    kept = {(r.name, r.category) for r in clean.recategorize(df, keep_old=True).collect()}
    assert ("gone", "old") in kept and ("two", "n2") in kept


def test_previous_row_inflation_and_fake_discount(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), 10.0, None), (D(2024, 1, 9), 12.0, 10.0), (D(2024, 1, 10), 12.0, 11.0), (D(2024, 1, 11), 0.0, None),
         (D(2024, 1, 12), 3.0, None)],
        "date date, original_price double, discount_price double",
    ).withColumns({"name": F.lit("a"), "size": F.lit("1"), "dedup_id": F.lit(1), "category": F.lit("c"), "subcategory": F.lit("s")})
    got = df.transform(clean.add_prev_price).transform(clean.add_inflation).transform(clean.add_fake_discount).orderBy("date").collect()
    assert [r.prev_original_price for r in got] == [None, 10.0, 12.0, 12.0, 0.0]
    assert [r.is_fake_discount for r in got] == [None, True, None, None, None]
    assert [r.inflation_percent for r in got] == [None, pytest.approx(0.2), 0.0, -1.0, None]
    assert [r.inflation_abs for r in got] == [None, 2.0, 0.0, -12.0, 3.0]


def test_clean_v1_end_to_end(spark):
    data = [
        ("Cáfe  Molido", "1,00 €", None, "Bote", "Viejo > Uno", D(2024, 10, 1)),
        ("Café molido", "2,00 €", "1,00 €", "Bote", "Nuevo > Dos > Tres", D(2024, 11, 6)),
        ("Café molido", "2,50 €", None, "Bote", "Nuevo > Dos", D(2024, 11, 6)),
        ("Café molido", "2,50 €", None, "Bote", "Nuevo > Dos", D(2024, 11, 6)),
        ("Perdido", "€", "", "1 L", "Solo", D(2024, 10, 1)),
    ]
    got = clean.clean_v1(spark.createDataFrame(data, RAW_V1))
    assert got.columns == clean.HISTORY_COLUMNS
    found = {(r.date.day, r.name, r.dedup_id): r for r in got.collect()}
    assert len(found) == 4 == got.count()
    first, cheap, dear = found[(1, "cafe molido", 1)], found[(6, "cafe molido", 1)], found[(6, "cafe molido", 2)]
    assert (first.category, first.subcategory) == ("nuevo", "dos") and first.prev_original_price is None
    assert cheap.is_fake_discount is True and cheap.inflation_percent == 1.0 and cheap.prev_original_price == 1.0
    assert dear.original_price == 2.5 and dear.prev_original_price is None
    lost = found[(1, "perdido", 1)]
    assert (lost.category, lost.subcategory, lost.original_price, lost.discount_price) == (None, None, None, None)


def test_clean_v2_merc_relabels_raw_text(spark):
    raw = "date string, name string, category string, image_url string, original_price string, discount_price string"
    df = spark.createDataFrame([
        ("2024-10-01", "AGUA", "A > Vieja", "http://i", "1,00 €", None),
        ("2024-11-06", "Agua", "B > Nueva", "http://i", "1,00 €", "0,90 €"),
        ("2024-11-06", "agua ", "B > Nueva", "http://i", "1,00 €", "0,90 €"),
    ], raw)
    got = clean.clean_v2_merc(df)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in clean.STAGING]
    assert rows(got, "date", "category", "dedup_id", "price") == [
        (D(2024, 10, 1), None, 1, 1.0), (D(2024, 11, 6), "b", 1, 0.9), (D(2024, 11, 6), "b", 2, 0.9)]


def test_clean_v2_carr(spark):
    df = spark.createDataFrame([
        ("Leche", "1,58 €", "1,53 €", "1,53 €/l", "Lácteos > Leche > Entera", None, "/p/1", "/c", "2024-11-06"),
        ("Leche", "1,58 €", "1,53 €", "1,53 €/l", "Lácteos > Leche > Entera", None, "/p/2", "/c", "2024-11-06"),
        ("Pan", "0,50 €", None, None, None, None, None, "/c", "2024-11-06"),
    ], RAW_CARR)
    got = clean.clean_v2_carr(df)
    assert rows(got, "name", "dedup_id", "category", "subcategory", "price", "price_per_unit", "unit", "size") == [
        ("leche", 1, "lacteos", "leche > entera", 1.53, 1.53, "l", None),
        ("leche", 2, "lacteos", "leche > entera", 1.53, 1.53, "l", None),
        ("pan", 1, None, None, 0.5, None, None, None)]


def test_empty_input(spark):
    assert clean.empty_staging(spark).columns == clean.STAGING.fieldNames()
    assert clean.clean_v2_carr(spark.createDataFrame([], RAW_CARR)).count() == 0


def test_rows_are_numbered_once_for_labels_of_one_class(spark, monkeypatch):
    """Spellings that standardise alike carry the same or other labels, some twice; equal to numbering after the labels multiply the rows."""
    rng = random.Random(5)
    old, new = D(2024, 11, 1), D(2024, 11, 6)
    data = [
        (name, f"{rng.randrange(3)},5 €", None, size, "x > y", rng.choice([None, "https://i/1"]), str(old))
        for name in ("Ñame ", "name", "Name", "Pan", "Oil", None) for size in ("1 L", None) for _ in range(12)
    ]
    labels = {"Ñame ": ["a > b", "A > b", "c", None], "name": ["a > b", "c"], "Name": ["C", "d > e"], "Pan": ["a > b", "c", "d", "Á > b"], None: ["a", "b"]}
    data += [(name, "9", None, "1 L", label, None, str(new)) for name, all_labels in labels.items() for label in all_labels]
    df = spark.createDataFrame(data, "name string, original_price string, discount_price string, size string, category string, image_url string, date string")
    full = clean.ensure_columns(df, {"price_per_unit": "double", "unit": "string"})
    split = full.transform(clean.parse_dates).transform(clean.parse_prices).transform(clean.split_category, "category")
    want = clean._stage(clean.recategorize(split, null_safe=True), 1_000_000)
    numbered = []
    monkeypatch.setattr(clean, "number_duplicates", lambda rows, *a, **k: numbered.append(rows.count()) or number_duplicates(rows, *a, **k))
    got = clean.clean_v2_merc(df)
    assert rows(got) == rows(want) and got.columns == want.columns
    assert numbered == [want_rows_before_labels(split)] and numbered[0] < want.count()


def want_rows_before_labels(split):
    """Distinct rows, times the classes of labels of their spelling: the four labels of the first name stand in three classes, and so on."""
    standing, _ = clean.label_classes(split, clean.RECATEGORIZED_ON)
    keys = [F.col("name").eqNullSafe(F.col("_name")), F.col("size").eqNullSafe(F.col("_size"))]
    assert standing.filter("_name = 'Oil'").count() == 2
    # a > b twice, the second spelling once, c by all: each a class; one label alone: another.
    assert standing.filter("_name = 'name' AND _size = '1 L'").count() == 2
    assert standing.filter("_name = 'Pan' AND _size = '1 L'").count() == 3  # a > b stands twice, c and d are one class
    return split.drop("category", "subcategory").distinct().join(standing, keys).count()


def test_different_rows_are_shuffled_once_to_be_numbered(spark, monkeypatch):
    """They are written as they come; the window's shuffle by group is the only one, and no count before it holds them in memory."""
    from pricelake.operators import numbering

    written, write = [], numbering.stored
    monkeypatch.setattr(numbering, "stored", lambda df, label: written.append((label, df._jdf.queryExecution().toString())) or write(df, label))
    df = spark.range(1000).selectExpr("concat('k', id % 10) AS k", "cast(id AS double) AS price", "concat('u', id) AS url")
    got = number_duplicates(df, ["k"], ["price"])
    assert [label for label, _ in written] == ["rows-to-number", "hot-groups"]
    assert "Exchange" not in written[0][1] and "HashAggregate" not in written[0][1]
    assert got.filter("dedup_id = 100").count() == 10 and got.count() == 1000


def test_history_is_looked_up_before_labels_multiply_rows(spark, monkeypatch):
    """Three labels of a product: its rows go through the window once, the result is that of a window over all rows."""
    days = [D(2024, 11, d) for d in (1, 2, 3, 7)]
    data = [(name, f"{i}.5", f"{i - 1}.5", "1 L", label, day) for i, day in enumerate(days, 1) for name in ("a", "b", None) for label in ("x > y", "x", None)]
    looked, look = [], clean.add_prev_price
    monkeypatch.setattr(clean, "add_prev_price", lambda df, *a, **k: looked.append(df.count()) or look(df, *a, **k))
    got = clean.clean_v1(spark.createDataFrame(data, RAW_V1))
    assert looked == [12] and got.count() == 28
    want = look(got.drop("prev_original_price", "inflation_percent", "inflation_abs", "is_fake_discount"))
    want = want.transform(clean.add_inflation).transform(clean.add_fake_discount).select(*clean.HISTORY_COLUMNS)
    assert rows(got) == rows(want)


def test_the_dimension_before_is_aggregated_once(spark):
    """Its newest day, its dates and its untouched rows are read from the stored table."""
    from checks import queries

    got = queries.dim_product_incremental(spark, "/root/testdata/sf0.001")
    assert any("/dim-product-before-" in f for f in got.inputFiles())
    assert got.groupBy("product_nk").count().filter("count > 1").count() == 0
