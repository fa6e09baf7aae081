import datetime as dt
import unicodedata

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelake import functions as P

D = dt.date


@pytest.mark.parametrize("inner", [False, True])
def test_parse_price(spark, inner):
    texts = ["0,47 €", "8.20", "€", "", None, " 3,16 €", "1.234,56 €", "1d", "NaN", "0x1p3", "-2,5 €", ".5", "7,"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(P.parse_price("t", inner).alias("p"))
    assert [r.p for r in df.collect()] == [0.47, 8.2, None, None, None, 3.16, None, None, None, None, -2.5, 0.5, 7.0]


def test_parse_price_spaces_inside(spark):
    df = spark.createDataFrame([("1 234,5 €",)], "t string")
    assert df.select(P.parse_price("t")).first()[0] is None
    assert df.select(P.parse_price("t", inner_spaces=True)).first()[0] == 1234.5


def test_parse_unit(spark):
    df = spark.createDataFrame([("1,89 €/kg",), ("1,85 €/UD",), ("2 €",), (None,), ("3,10 €/kg aprox",)], "t string")
    got = df.select(P.parse_unit_amount("t"), P.parse_unit("t")).collect()
    assert [tuple(r) for r in got] == [(1.89, "kg"), (1.85, "UD"), (2.0, None), (None, None), (None, "kg")]


def test_standardize(spark):
    df = spark.createDataFrame([("  Jamón   Ibérico\t",), (None,), (" ÑANDÚ ",)], "t string")
    got = df.select(P.standardize("t").alias("a"), P.standardize("t", collapse=True).alias("b")).collect()
    assert got[0].a == "jamon   iberico" and got[1].a is None and got[2].a == "nandu"
    assert got[0].b == "jamon iberico\t" and got[1].b is None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x1FFF, exclude_categories=["Cs", "Cn"])), max_size=20))
def test_strip_accents_agrees_with_unicode(spark, texts):
    def bare(t):
        return "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")

    # Letters that decompose to several letters are for the exact variant only.
    texts = [t for t in texts if all(len(bare(c)) < 2 for c in t)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    got = df.select(P.strip_accents("t").alias("a"), P.strip_accents_exact("t").alias("b")).collect()
    assert [r.a for r in got] == [bare(t) for t in texts]
    assert [r.b for r in got] == [bare(t) for t in texts]


def test_strip_accents_exact_null_and_hangul(spark):
    df = spark.createDataFrame([(None,), ("각",)], "t string").select(P.strip_accents_exact("t").alias("t"))
    assert [r.t for r in df.collect()] == [None, "각"]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string").select(P.surrogate_key("x", "y").alias("k"))
    import hashlib

    token = "_dbt_utils_surrogate_key_null_"
    assert [r.k for r in df.collect()] == [hashlib.md5(s.encode()).hexdigest() for s in ("a-b", f"a-{token}")]


def test_urls(spark):
    urls = ["https://e.com/i.jpg?w=1", " http://e.com/a#x?y ", "/i.jpg", "//e.com/i.jpg", "data:image/gif;base64,x", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select(P.clean_url("u").alias("a"), P.clean_url("u", drop_fragment=True).alias("b")).collect()
    assert [r.a for r in got] == ["https://e.com/i.jpg", "http://e.com/a#x", None, None, None, None]
    assert [r.b for r in got] == ["https://e.com/i.jpg", "http://e.com/a", None, None, None, None]


def test_clip_variation_direction(spark):
    df = spark.createDataFrame([(None,), (3.0,), (-3.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(P.clip("x", -1.0, 1.0)).collect()] == [None, 1.0, -1.0, 0.5]
    assert [r[0] for r in df.select(P.direction("x")).collect()] == ["flat", "increase", "decrease", "increase"]
    pair = spark.createDataFrame([(4.75, 5.75), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in pair.select(P.variation_pct("a", "b")).collect()] == [-0.1739, None, None]


def test_calendar(spark):
    df = spark.createDataFrame([(D(2024, 12, 30),), (D(2024, 2, 29),)], "d date")
    got = df.select(*[c.alias(n) for n, c in P.calendar_columns("d").items()]).collect()[0].asDict()
    assert got["date_key"] == 20241230 and got["month_key"] == 202412 and got["month_name"] == "December"
    assert (got["iso_year"], got["iso_week"], got["iso_week_key"]) == (2025, 1, "202501")
    assert got["day_of_week"] == 1 and got["is_weekend"] is False
    assert got["week_end_date"] == D(2025, 1, 5) and got["quarter_end_date"] == D(2024, 12, 31)
    assert got["year_start_date"] == D(2024, 1, 1) and got["month_end_date"] == D(2024, 12, 31)


def test_period_starts_and_filters(spark):
    df = spark.createDataFrame([(D(2024, 3, 31),)], "d date")
    got = df.select(*[c.alias(n) for n, c in P.period_starts("d").items()]).first()
    assert tuple(got) == (D(2024, 3, 1), D(2024, 1, 1), D(2023, 10, 1), D(2024, 1, 1))
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-04-30')) AS d")
    assert days.filter(P.since("d", "2024-03-31", 30)).agg(F.min("d")).first()[0] == D(2024, 3, 1)
    assert days.filter(P.since("d", "2024-03-31", 1, "month", truncate=True)).agg(F.min("d")).first()[0] == D(2024, 2, 1)
    assert rows(days.filter(P.month_window("d", "2024-03-31")).agg(F.min("d"), F.max("d"))) == [(D(2024, 3, 1), D(2024, 3, 31))]


def test_last_saturday(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-06-01', DATE '2024-06-08')) AS d").select("d", P.last_saturday("d").alias("s"))
    assert [r.s.day for r in df.orderBy("d").collect()] == [1] * 7 + [8]


def test_category_label_and_product_key(spark):
    df = spark.createDataFrame([(None,), (" > ",), ("a",), (" a > b >> c ",)], "c string")
    first, rest = P.parse_category_label("c")
    assert [tuple(r) for r in df.select(first, rest).collect()] == [
        ("(missing)", "(missing)"), ("(missing)", "(missing)"), ("a", "(none)"), ("a", "b > c")]
    who = spark.createDataFrame([(" /p ", "x"), ("", " Foo  Bar "), (None, " "), (None, None)], "u string, n string")
    assert [r[0] for r in who.select(P.stats_product_key("u", "n")).collect()] == ["url::/p", "name::foo bar", "unknown", "unknown"]
