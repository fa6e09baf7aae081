import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricelake.operators import quality, stats

D = dt.date


@pytest.fixture(scope="module")
def table(spark):
    data = [(1, "a", 1.0, D(2025, 1, 1)), (2, "a", -1.0, D(2025, 1, 3)), (2, None, None, D(2025, 1, 3)), (None, "z", 2.0, None)]
    return spark.createDataFrame(data, "id int, kind string, price double, day date")


def test_row_rules_in_one_pass(table):
    rules = {**quality.not_null("id", "price"), **quality.accepted("kind", ["a", "b"]), **quality.expression("positive", "price > 0"),
             **quality.expression("null_or_positive", F.col("price").isNull() | (F.col("price") > -5))}
    assert rows(quality.row_rules(table, rules)) == [
        ("accepted:kind", 1, "fail"), ("expression:null_or_positive", 0, "pass"), ("expression:positive", 1, "fail"),
        ("not_null:id", 1, "fail"), ("not_null:price", 1, "fail")]


def test_single_rules(spark, table):
    assert quality.dq_not_null(table, ["kind"]).first().failures == 1
    assert quality.dq_accepted(table, "kind", ["a", "z"]).first().status == "pass"
    assert quality.dq_expression(table, "cheap", "price < 2").first().failures == 1
    assert tuple(quality.dq_unique(table, ["id"]).first()) == ("unique:id", 1, "fail")
    assert quality.dq_unique(table, ["id", "kind"]).first().failures == 0
    parent = spark.createDataFrame([(1,)], "key int")
    assert tuple(quality.dq_relationship(table, "id", parent, "key").first()) == ("relationship:id", 2, "fail")


@pytest.mark.parametrize("as_of, status", [("2025-01-04", "pass"), ("2025-01-05", "warn"), ("2025-01-06", "error")])
def test_freshness(table, as_of, status):
    assert quality.dq_freshness(table, "day", as_of).first().status == status


def test_freshness_of_nothing(table):
    assert quality.dq_freshness(table.filter("false"), "day", "2025-01-01").first().status == "error"


def test_listing_stats(spark):
    df = spark.createDataFrame(
        [("f1", "a > b", "/1", "x"), ("f1", "a > b", "/1", "x"), ("f1", "a", None, "Y  y"), ("f2", "a > b", "/1", "x"), ("f2", None, None, None)],
        "file string, category string, product_url string, name string")
    got = {tuple(r)[:5]: (r.records, r.unique_products) for r in stats.listing_stats(df).collect()}
    assert got[("overall", "total", None, None, None)] == (5, 3)
    assert got[("overall", "category", None, "a", None)] == (4, 2)
    assert got[("overall", "subcategory", None, "a", "b")] == (3, 1)
    assert got[("file", "total", "f1", None, None)] == (3, 2)
    assert got[("file", "subcategory", "f2", "(missing)", "(missing)")] == (1, 1)
    top = stats.listing_stats(df, top=1).filter("scope = 'overall' AND level = 'category'").collect()
    assert [(r.category, r.records) for r in top] == [("a", 4)]
