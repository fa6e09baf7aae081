import datetime as dt

import pytest
from conftest import rows

from pricelake.operators import search

D = dt.date


@pytest.fixture(scope="module")
def products(spark):
    data = [
        ("77", "Aceite de oliva", "1 L", "Aceites | Salsas", "Oliva", 5.0, None),
        ("78", "Jamón ibérico", "200 g", "Charcutería", "Jamón", 9.0, "https://e/j"),
        ("79", "Aceitunas 0,0%", "1 L", "Aperitivos", "Oliva", 2.0, None)]
    return spark.createDataFrame(
        data, "id string, name string, size string, categories string, subcategories string, price double, image_url string")


@pytest.mark.parametrize("term, ids", [
    ("ACEIT", ["77", "79"]), ("aceite oli", ["77"]), ("oli aceite", []), ("jamon", ["78"]), ("Jamón IB", ["78"]), ("7", ["77", "78", "79"]),
    ("aceitunas 0,0", ["79"]), ("nada", []), ("salsas ace", ["77"]), ("aceite aceite", ["77"])])
def test_search_fts(products, term, ids):
    index = search.build_search_index(products)
    assert [r[0] for r in rows(search.search_fts(index, products, term), "id")] == ids


@pytest.mark.parametrize("term", ["", "   ", "%%"])
def test_empty_terms_are_refused(products, term):
    with pytest.raises(ValueError):
        search.search_fts(search.build_search_index(products), products, term)
    if not term.strip():
        with pytest.raises(ValueError):
            search.search_substring(products, term)


def test_index_holds_each_pair_once(products):
    index = search.build_search_index(products)
    assert index.count() == index.distinct().count()
    assert ("oliva", "77") in rows(index, "token", "id")


def test_search_substring_is_literal(products):
    assert [r[0] for r in rows(search.search_substring(products, "CEIT"), "id")] == ["77", "79"]
    assert search.search_substring(products, "0%").count() == 1
    assert search.search_substring(products, "_").count() == 0


def test_page(spark):
    df = spark.range(25).selectExpr("cast(id AS string) AS id")
    first = search.page(df, 5, 0).collect()
    assert [r.id for r in first] == ["0", "1", "10", "11", "12"]
    assert all((r.total_count, r.has_more) == (25, True) for r in first)
    assert [r.has_more for r in search.page(df, 5, 20).collect()] == [False] * 5
    assert search.page(df, 5, 30).count() == 0
    for bad in ({"limit": 0}, {"limit": 101}, {"offset": -1}):
        with pytest.raises(ValueError):
            search.page(df, **bad)


def test_page_after(spark):
    df = spark.range(25).selectExpr("cast(id AS string) AS id")
    pages, last = [], None
    while got := search.page_after(df, last, 10).collect():
        pages.append([r.id for r in got])
        last = pages[-1][-1]
        assert all((r.total_count, r.has_more) == (25, len(pages) < 3) for r in got)
    assert [x for p in pages for x in p] == sorted(str(i) for i in range(25))


def test_other_scripts_are_found(spark):
    df = spark.createDataFrame([("1", "ガム"), ("2", "한국 김치"), ("3", "5 \u212b")], "id string, name string")
    index = search.build_search_index(df, "id", ["name"])
    for term, found in (("ガム", "1"), ("김치", "2"), ("å", "3")):
        assert rows(search.search_fts(index, df, term), "id") == [(found,)]


def test_product_detail(spark, products):
    details = spark.createDataFrame(
        [(D(2025, 6, 2), "77", 5.0, 5.0, 5.0, 5.0), (D(2025, 6, 1), "77", 4.0, 4.0, 4.0, 4.0), (D(2024, 6, 1), "77", 3.0, 3.0, 3.0, 3.0),
         (D(2024, 6, 1), "78", 3.0, 3.0, 3.0, 3.0)],
        "date date, id string, price double, sma7 double, sma15 double, sma30 double")
    got = search.product_detail(products, details, ["77", "78", "nope"], "2025-06-10").collect()
    assert [r.id for r in got] == ["77"] and got[0].current_price == 5.0
    assert [(d.date, d.price) for d in got[0].price_details] == [(D(2025, 6, 1), 4.0), (D(2025, 6, 2), 5.0)]
    assert search.product_detail(products, details, None, "2024-06-10").count() == 2
