import datetime as dt
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricelake.operators import refs, reports, star
from pricelake.plans import models

D = dt.date


def staging(spark, data):
    """(date, name, size, category, subcategory, image, original, discount, dedup_id)"""
    df = spark.createDataFrame(
        data, "date date, name string, size string, category string, subcategory string, image_url string, "
              "original_price double, discount_price double, dedup_id int")
    return df.withColumn("price", F.coalesce("discount_price", "original_price"))


def test_dim_date_end_is_exclusive(spark):
    got = star.dim_date(spark, "2024-12-30", "2025-01-02").collect()
    assert [r.date_key for r in got] == [20241230, 20241231, 20250101] and len(got[0]) == 22


def test_dim_category(spark):
    day = D(2025, 1, 1)
    stg = staging(spark, [
        (day, "a", "1", "Drinks", "Water", None, 1.0, None, 1), (day, "b", "1", "Drinks", "Water", None, 1.0, None, 1),
        (day, "c", "1", "Oils", None, None, 1.0, None, 1), (day, "d", "1", None, None, None, 1.0, None, 1)])
    assert rows(star.dim_category(stg), "category", "subcategory") == [("Drinks", "Water"), ("Oils", None)]


def test_dim_product_images_and_dates(spark):
    stg = staging(spark, [
        (D(2025, 1, 1), "a", "1", "c", "s", "https://e/1", 1.0, None, 1),
        (D(2025, 1, 3), "a", "1", "c", "s", "https://e/2", 1.0, None, 1),
        (D(2025, 1, 5), "a", "1", "c", "s", None, 1.0, None, 1),
        (D(2025, 1, 2), "bad", "1", "c", "s", "ftp://e/1", 1.0, None, 1),
        (D(2025, 1, 2), "nosize", None, "c", "s", None, 1.0, None, 1)])
    current = star.maintain_dim_product(stg)
    assert rows(current, "name", "image_url", "first_seen_date", "last_seen_date") == [
        ("a", "https://e/2", D(2025, 1, 1), D(2025, 1, 5)), ("bad", None, D(2025, 1, 2), D(2025, 1, 2)),
        ("nosize", None, D(2025, 1, 2), D(2025, 1, 2))]
    assert current.select("product_key").distinct().count() == 3
    # A late older row inside the window moves the first day back; a row before the window is not read.
    late = staging(spark, [
        (D(2024, 12, 20), "a", "1", "c", "s", None, 1.0, None, 1), (D(2024, 1, 1), "a", "1", "c", "s", None, 1.0, None, 1),
        (D(2025, 2, 1), "new", "1", "c", "s", None, 1.0, None, 1)])
    upserts = star.maintain_dim_product(late, current)
    assert rows(upserts, "name", "image_url", "first_seen_date", "last_seen_date") == [
        ("a", "https://e/2", D(2024, 12, 20), D(2025, 1, 5)), ("new", None, D(2025, 2, 1), D(2025, 2, 1))]
    assert star.apply_upserts(current, upserts, "product_nk").count() == 4


def test_fact_drops_rows_without_dimension(spark):
    stg = staging(spark, [
        (D(2025, 1, 1), "a", "1", "c", "s", None, 10.0, 8.0, 1), (D(2025, 1, 1), "a", "1", None, None, None, 10.0, None, 1),
        (D(2030, 1, 1), "a", "1", "c", "s", None, 10.0, None, 1), (D(2025, 1, 2), "a", "1", "c", "s", None, 0.0, None, 1),
        (D(2025, 1, 2), "a", "1", "c", "s", None, 5.0, 5.0, 2)])
    fact = models.build_star(stg, "2025-01-01", "2025-02-01")["fact_product_price_daily"]
    assert rows(fact, "date_key", "dedup_id", "price", "is_discounted", "discount_abs", "discount_pct") == [
        (20250101, 1, 8.0, True, 2.0, 0.2), (20250102, 1, 0.0, False, 0.0, None), (20250102, 2, 5.0, False, 0.0, 0.0)]


def test_moving_averages(spark):
    days = [D(2025, 1, d) for d in range(1, 8)]
    data = [(d, "flat", 10.0) for d in days] + [(d, "up", float(i + 1)) for i, d in enumerate(days)]
    data += [(D(2025, 1, 1), "gap", 2.0), (D(2025, 1, 9), "gap", 4.0)]
    got = {(r.id, r.date.day): r for r in refs.moving_averages(spark.createDataFrame(data, "date date, id string, price double")).collect()}
    assert all(got[("flat", d)].sma7 == got[("flat", d)].sma30 == 10.0 for d in range(1, 8))
    assert got[("up", 7)].sma7 == 4.0 and got[("up", 2)].sma7 == 1.5
    assert got[("gap", 9)].sma7 == 4.0 and got[("gap", 9)].sma15 == 3.0
    assert all(1.0 <= r.sma7 <= 7.0 for k, r in got.items() if k[0] == "up")


def test_incremental_averages_equal_full_ones(spark):
    data = [(D(2024, 1, 1) + dt.timedelta(days=i), "a", float(i % 17)) for i in range(0, 400, 3)]
    daily = spark.createDataFrame(data, "date date, id string, price double")
    full = refs.moving_averages(daily).filter("date >= DATE '2024-08-03'")
    assert rows(refs.moving_averages(daily, as_of="2025-02-03")) == rows(full)


def test_ref_products(spark):
    fact = spark.createDataFrame(
        [(20250101, "p1", "k1", 10.0), (20250102, "p1", "k2", 12.0), (20250103, "p2", "k2", 1.5), (20250103, "p2", "none", 9.0)],
        "date_key int, product_key string, category_key string, price double")
    dates = spark.createDataFrame([(20250101, D(2025, 1, 1)), (20250102, D(2025, 1, 2)), (20250103, D(2025, 1, 3))], "date_key int, date date")
    categories = spark.createDataFrame([("k1", "Oils", "Olive"), ("k2", "Drinks", "Water"), ("none", "Odd", None)],
                                       "category_key string, category string, subcategory string")
    products = spark.createDataFrame([("p1", "X", "1 L", "i1"), ("p2", "Y", "2 L", None)],
                                     "product_key string, name string, size string, image_url string")
    assert rows(refs.ref_products(fact, dates, categories, products)) == [
        ("p1", "X", "1 L", "Drinks | Oils", "Olive | Water", 12.0, "i1"), ("p2", "Y", "2 L", "Drinks", "Water", 1.5, None)]
    assert rows(refs.ref_products(fact, dates, categories, products, "2025-01-03", 1), "id", "categories") == [
        ("p1", "Drinks"), ("p2", "Drinks")]


def fact_rows(spark, data):
    return spark.createDataFrame(
        data, "fact_date date, product_key string, category_key string, dedup_id int, price double, original_price double")


def test_monthly_products(spark):
    fact = fact_rows(spark, [
        (D(2025, 1, 2), "p", "c", 1, 8.0, 9.0), (D(2025, 1, 30), "p", "c", 1, 6.0, 9.0), (D(2025, 1, 2), "p", "c", 2, 99.0, 99.0),
        (D(2025, 2, 1), "p", "c", 1, 0.0, None)])
    got = {r.year_month_period: r for r in reports.monthly_products(fact, None, "2025-02-10").collect()}
    january = got[D(2025, 1, 1)]
    assert (january.price_variation_abs, january.price_variation_percent) == (-2.0, -0.25)
    assert (january.earliest_price, january.latest_price, january.orig_price_variation_percent) == (8.0, 6.0, 0.0)
    assert got[D(2025, 2, 1)].price_variation_percent is None
    current = reports.monthly_products(fact, None, "2025-02-10", only_current=True)
    assert rows(current, "year_month_period", "processing_date") == [(D(2025, 2, 1), D(2025, 2, 10))]


def monthly(spark, values):
    data = [(D(2025, 1, 1), f"p{i}", "c", v, v) for i, v in enumerate(values)]
    return spark.createDataFrame(
        data, "year_month_period date, product_key string, category_key string, price_variation_percent double, "
              "orig_price_variation_percent double")


def test_category_trends(spark):
    got = reports.category_trends(monthly(spark, [None, 3.0, -3.0, 0.5])).first()
    assert got.product_count == 4 and got.avg_price_var_pct == pytest.approx(0.5 / 3)
    assert got.avg_clipped_price_var_pct == pytest.approx(0.5 / 3) and got.stdev_price_var_pct == pytest.approx(statistics.stdev([3.0, -3.0, 0.5]))
    assert reports.category_trends(monthly(spark, [1.0])).first().stdev_price_var_pct is None


def test_top_movers_keep_ties_and_nulls(spark):
    table = monthly(spark, [0.5, 0.5, 0.4, 0.1, -0.2, None, None])
    up = reports.top_movers(table, "2025-02-01", n=2)
    assert rows(up.filter("direction = 'increase'"), "product_key", "rank") == [("p0", 1), ("p1", 1), ("p2", 2)]
    assert rows(up.filter("direction = 'decrease'"), "product_key", "rank") == [("p4", 2), ("p5", 1), ("p6", 1)]
    dropped = reports.top_movers(table, "2025-02-01", n=2, drop_null=True)
    assert rows(dropped.filter("direction = 'decrease'"), "product_key", "rank") == [("p3", 2), ("p4", 1)]


def test_top_movers_against_brute_force(spark):
    import random

    rng = random.Random(3)
    values = [rng.choice([None, *[x / 10 for x in range(-9, 10)]]) for _ in range(300)] + [0.9] * 200
    got = reports.top_movers(monthly(spark, values), "2025-02-01", n=3)

    def ranked(key):
        distinct = sorted(set(values), key=key)[:3]
        return {(f"p{i}", distinct.index(v) + 1) for i, v in enumerate(values) if v in distinct}

    up = ranked(lambda v: (v is None, -(v or 0)))
    down = ranked(lambda v: (v is not None, v or 0))
    found = {(r.direction, r.product_key, r["rank"]) for r in got.collect()}
    assert found == {("increase", *x) for x in up} | {("decrease", *x) for x in down}


def test_price_report_and_top(spark):
    fact = fact_rows(spark, [
        (D(2025, 6, 20), "p", "c", 1, 12.0, 12.0), (D(2025, 6, 20), "p", "c", 2, 11.0, 12.0), (D(2025, 6, 1), "p", "c", 1, 10.0, 10.0),
        (D(2025, 1, 1), "p", "c", 1, 8.0, 8.0), (D(2025, 4, 2), "p", "c", 1, 7.0, 8.0), (D(2025, 6, 20), "q", "c", 1, 1.0, 1.0),
        (D(2025, 1, 1), "q", "c", 1, 2.0, 2.0), (D(2025, 6, 19), "r", "c", 1, 1.0, 1.0), (D(2025, 1, 1), "r", "c", 1, 9.0, 9.0),
        (D(2023, 1, 1), "old", "c", 1, 9.0, 9.0)])
    products = spark.createDataFrame([(k, k.upper(), "1") for k in ("p", "q", "r", "old")], "product_key string, name string, size string")
    report = reports.price_report(fact, products, "2025-06-20")
    got = {r.product_key: r for r in report.collect()}
    p = got["p"]
    assert set(got) == {"p", "q", "r"} and p.latest_price == 11.0
    assert (p.mtd_price, p.mtd3_price, p.mtd6_price, p.ytd_price) == (10.0, None, 8.0, 8.0)
    assert p.mtd3_start_date == D(2025, 4, 1) and p.mtd6_start_date == D(2025, 1, 1) and p.mtd3_price_var_abs is None
    assert p.ytd_price_var_pct == pytest.approx(0.375)
    current = spark.createDataFrame([(k, "C", "S") for k in ("p", "q", "r")], "id string, categories string, subcategories string")
    top = reports.top_ytd(report, current, k=5).collect()
    assert [(r.product_key, r.direction) for r in top] == [("q", "decrease"), ("p", "increase")]


def test_build_reports(spark):
    stg = staging(spark, [(D(2025, 1, d), n, "1", "c", "s", "https://e/i", 10.0 + d, None, 1) for d in (1, 5, 20) for n in ("a", "b")])
    built = models.build_reports(models.build_star(stg, "2025-01-01", "2025-02-01"), "2025-01-20")
    assert {n: df.count() for n, df in built.items()} == {
        "ref_products": 2, "ref_product_price_details": 6, "monthly_products": 2, "monthly_category_trends": 1,
        "monthly_product_top_movers": 4, "product_price_report": 2, "product_price_report_top_ytd": 2}


def test_stored_refresh_takes_up_late_rows(spark, tmp_path):
    def day(d, name, price):
        return (D(2025, 1, d), name, "1", "c", "s", "https://e/i", price, None, 1)

    root = str(tmp_path / "models")
    first = [day(1, "a", 10.0), day(10, "a", 11.0)]
    models.refresh(spark, staging(spark, first), root, "2025-01-10", start="2025-01-01", end="2025-02-01")
    late = [*first, day(5, "a", 9.0), day(20, "a", 12.0), day(20, "b", 1.0)]
    t = models.refresh(spark, staging(spark, late), root, "2025-01-20", start="2025-01-01", end="2025-02-01")
    assert rows(t["fact_product_price_daily"], "fact_date", "price") == [
        (D(2025, 1, 1), 10.0), (D(2025, 1, 5), 9.0), (D(2025, 1, 10), 11.0), (D(2025, 1, 20), 1.0), (D(2025, 1, 20), 12.0)]
    assert t["dim_product"].count() == 2 and t["dim_product"].filter("name = 'a'").first().last_seen_date == D(2025, 1, 20)
    details = {r.date.day: r for r in t["ref_product_price_details"].join(t["dim_product"].filter("name='a'").selectExpr("product_key AS id"), "id").collect()}
    assert details[10].sma7 == 10.0 and details[20].sma30 == pytest.approx(10.5)
    assert t["monthly_products"].count() == 2 and t["product_price_report"].count() == 2
    again = models.refresh(spark, staging(spark, late), root, "2025-01-20", full=True, start="2025-01-01", end="2025-02-01")
    assert again["fact_product_price_daily"].count() == 5 and again["ref_products"].count() == 2
