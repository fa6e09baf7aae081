import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators import clean
from pricelake.plans import incremental
from pricelake.sinks import ledger, tables
from pricelake.sinks import search_index as token_index
from pricelake.sources import files, listings
from pricelake.streaming import ingest

D = dt.date
HEADER = "name,original_price,discount_price,size,category,image_url,date\n"


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as handle:
        handle.write(text)


def daily_csv(folder, day, *names):
    lines = "".join(f'{n},"1,50 €",,1 L,A > B,https://e/i,{day}\n' for n in names)
    write(f"{folder}/{day}.csv", HEADER + lines)


NAMES = ["merc/2022-02-28.csv", "merc/2022-02-29.csv", "merc/2024-02-29.csv", "merc/2024-03-01.csv", "merc/nodate.csv", "merc/2024-13-01.csv"]


@pytest.mark.parametrize("watermark, kept", [
    ("2024-02-28", {"2024-02-29", "2024-03-01"}), ("2024-02-29", {"2024-03-01"}), ("2024-03-01", set()), ("2022-02-27", {"2022-02-28", "2024-02-29", "2024-03-01"})])
def test_files_after(spark, tmp_path, watermark, kept):
    for name in NAMES:
        write(f"{tmp_path}/{name}", HEADER + f"{name},,,,,,\n")
    got = files.read_raw_mixed(spark, f"{tmp_path}/merc", files.RAW_MERC, after=watermark)
    assert {r.name[5:15] for r in got.collect()} == kept


def test_mixed_formats_and_missing_columns(spark, tmp_path):
    daily_csv(str(tmp_path), "2025-01-01", "a")
    spark.createDataFrame([("b", "2025-01-02")], "name string, date string").coalesce(1).write.parquet(f"{tmp_path}/2025-01-02")
    got = files.read_raw_mixed(spark, str(tmp_path), files.RAW_MERC)
    assert rows(got, "name", "size") == [("a", "1 L"), ("b", None)]


def test_csv_with_byte_order_mark(spark, tmp_path):
    write(f"{tmp_path}/carr_1.csv", HEADER + "a,,,,,,\n", encoding="utf-8-sig")
    got = files.read_csv_with_file(spark, f"{tmp_path}/carr_*.csv", files.RAW_MERC)
    assert rows(got, "name", "file") == [("a", "carr_1.csv")]


def test_newest_files_and_inventory(spark, tmp_path):
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        daily_csv(str(tmp_path), day, f"p{day[-1]}")
    assert rows(files.newest_files(spark, str(tmp_path), files.RAW_MERC, fmt="csv"), "name") == [("p3",)]
    assert rows(files.newest_files(spark, str(tmp_path), files.RAW_MERC, 2, fmt="csv"), "name") == [("p2",), ("p3",)]
    none = files.newest_files(spark, str(tmp_path), files.RAW_MERC)
    assert none.columns == files.RAW_MERC.fieldNames() and none.count() == 0
    size = sum(os.path.getsize(f"{tmp_path}/{n}") for n in os.listdir(tmp_path) if n.endswith(".csv"))
    got = files.file_inventory(spark, str(tmp_path)).first()
    assert (got.files, got.bytes) == (3, size) and got.saved_bytes == pytest.approx(size * 0.7)


def test_scan_range_checks(spark):
    df = spark.createDataFrame([(D(2025, 1, d),) for d in (1, 2, 3)], "date date")
    assert files.scan_range(df, "2025-01-01", "2025-01-02").count() == 2
    assert files.scan_since(df, "2025-01-02").count() == 1 and files.scan_since(df, None).count() == 3
    for bad in ((None, "2025-01-01"), ("2025-01-02", "2025-01-01")):
        with pytest.raises(ValueError):
            files.scan_range(df, *bad)


# Own pages; only the class and attribute names are given by the layouts.
MERC = """<section><div class="grid" data-testid="product-cell"><span><h4 data-testid="product-cell-name">Harina &lt;fina&gt; </h4></span>
<img loading="lazy" src="https://pics.test/h.png?w=90&amp;q=7"><div class="product-format"><span>Saco </span><span>25 kg</span></div>
<p data-testid="product-price">31,40 €</p><em><p data-testid="product-price"> 28,05 €</p></em></div>
<div data-testid="product-cell"><p>agotado</p><h4 data-testid="product-cell-name">Levadura</h4></div>
<div data-testid="product-cell"><div class="product-format">bote</div><p data-testid="product-price">7,77 €</p><h4 data-testid="product-cell-name">Canela</h4></div></section>"""
CARR = """<main><div class="product-card__parent"><img class="product-card__image" src="https://pics.test/q.webp?s=3#top">
<h2 class="product-card__title"><a class="product-card__title-link" href="/ficha/q">Queso curado </a></h2>
<span class="product-card__price-per-unit">19,30 €/kg</span><span class="product-card__price--strikethrough">9,65 €</span>
<span class="product-card__price--current">8,10 €</span></div>
<div class="product-card__parent"><span class="product-card__price">4 €</span></div>
<div class="product-card__parent"><h2 class="product-card__title"><a class="product-card__title-link">Nata</a></h2><span class="product-card__price">2,35 €</span></div></main>"""


def test_extract_listings(spark):
    pages = spark.createDataFrame([(MERC, "Horno", "https://s/1"), ("", "x", "y"), ("<p>product-cell</p>", "x", "y"), (None, "x", "y")],
                                  "html string, category string, url string")
    assert rows(listings.extract_listings(pages, "merc")) == [
        ("Canela", "7,77 €", None, "bote", "Horno", None),
        ("Harina <fina>", "31,40 €", "28,05 €", "Saco 25 kg", "Horno", "https://pics.test/h.png")]
    cards = spark.createDataFrame([(CARR, "Lácteos", "https://s/2")], "html string, category string, url string")
    assert rows(listings.extract_listings(cards, "carr", base_url="https://s")) == [
        ("Nata", "2,35 €", None, None, "Lácteos", None, None, "https://s/2"),
        ("Queso curado", "9,65 €", "8,10 €", "19,30 €/kg", "Lácteos", "https://pics.test/q.webp", "https://s/ficha/q", "https://s/2")]


PRODUCT = {
    "merc": '<div class="c" data-testid="product-cell"><!-- a > b --><img src="/a&amp;b"><h4 data-testid=product-cell-name> A &amp; B </h4>'
            '<script>if (a < b) x("<p>&amp;")</script><p data-testid=\'product-price\'>1,5 &euro;</p><br/>{}</div>',
    "carr": '<!doctype html><div class="product-card__parent x"><h2 class="product-card__title"><a class="product-card__title-link" href="/p?a=1&amp;b=2" title="a > b">'
            ' N <b>x</b></a></h2>{}<span class=product-card__price>1,5</span><IMG CLASS="product-card__image" src=/x/y/></div>',
}


@pytest.mark.parametrize("layout", ["merc", "carr"])
def test_well_formed_pages_take_no_parser(layout, monkeypatch):
    page = PRODUCT[layout].format("<p>") + PRODUCT[layout].format("</p>")
    parsed = list(listings._ROWS[layout](*listings._scan_tree(layout, page)))
    monkeypatch.delattr(listings, "_Tree")
    assert listings._page_rows(layout, page) == parsed and len(parsed) == 2


@pytest.mark.parametrize("layout", ["merc", "carr"])
@pytest.mark.parametrize("odd", ["<", "</", '<a "', "<!-- a -- b -->", "<p a=x/>", "<p =a>", "</p x>", "<?x?>", "<script>", "<script>'</script x>'", '<p a="b"c="d">', "</ div>", "&#x41", "<div/>"])
def test_other_pages_give_the_rows_of_the_parser(layout, odd):
    for page in (PRODUCT[layout].format(odd), odd + PRODUCT[layout].format("") + odd, PRODUCT[layout].format(PRODUCT[layout].format(odd))):
        assert listings._page_rows(layout, page) == list(listings._ROWS[layout](*listings._scan_tree(layout, page)))


def test_upsert_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_current(spark, path) is None
    tables.upsert(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "k")
    tables.upsert(spark, path, spark.createDataFrame([(2, "B", 5), (3, "c", 6)], "k int, v string, n int"), "k")
    assert rows(tables.read_current(spark, path), "k", "v", "n") == [(1, "a", None), (2, "B", 5), (3, "c", 6)]
    # A run that died left an incomplete version; it is not read, and the next run replaces it.
    os.makedirs(f"{path}/version=000003")
    assert tables.read_current(spark, path).count() == 3
    tables.upsert(spark, path, spark.createDataFrame([(9, "z")], "k int, v string"), "k")
    assert tables.read_current(spark, path).count() == 4


def test_append_once_replaces_a_repeated_run(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(D(2025, 1, 1), 1), (D(2025, 1, 2), 2)], "date date, v int")
    tables.append_once(one, path, 1)
    tables.append_once(spark.createDataFrame([(D(2025, 1, 2), 3)], "date date, v int"), path, 2)
    tables.append_once(one, path, 1)
    assert rows(tables.read_table(spark, path), "date", "v") == [(D(2025, 1, 1), 1), (D(2025, 1, 2), 2), (D(2025, 1, 2), 3)]


def test_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(D(2025, 1, 1), "a")], "date date, v string").withColumn("empty", F.lit(None))
    got = tables.write_snapshot(df, str(tmp_path / "p"))
    assert dict(got.dtypes)["empty"] == "string" and got.count() == 1
    tables.write_snapshot(df, str(tmp_path / "c"), "csv", partition=None)
    with pytest.raises(ValueError):
        tables.write_snapshot(df.filter("false"), str(tmp_path / "none"))
    assert not os.path.exists(tmp_path / "none")


def test_migrate_csv(spark, tmp_path):
    source, target = str(tmp_path / "csv"), str(tmp_path / "parquet")
    daily_csv(source, "2025-01-01", "a", "b")
    write(f"{source}/2025-01-02.csv", HEADER + "short,row\nbad,,,,,,no day\nlong,,,,,,2025-01-02,more\n")
    dated = T.StructType([T.StructField("date", T.DateType()) if f.name == "date" else f for f in files.RAW_MERC])
    dry = tables.migrate_csv(spark, source, target, dated, dry_run=True).first()
    assert (dry.files, dry.failed_files, dry.parquet_bytes) == (2, 1, 0) and not os.path.exists(target)
    done = tables.migrate_csv(spark, source, target, dated).first()
    assert done.parquet_bytes > 0 and os.path.exists(f"{source}/2025-01-01.csv")
    assert [f.rsplit("/", 1)[1] for f in done.failed] == ["2025-01-02.csv"]
    assert rows(spark.read.parquet(target), "name", "date") == [
        ("a", D(2025, 1, 1)), ("b", D(2025, 1, 1)), ("long", D(2025, 1, 2)), ("short", None)]


def test_batches_publish_json(spark, tmp_path):
    df = spark.range(25).withColumn("v", F.lit("x"))
    assert tables.write_batches(df.coalesce(1), str(tmp_path / "b"), 10) == 25
    assert len([n for n in os.listdir(tmp_path / "b") if n.endswith(".parquet")]) == 3
    tables.publish(df, str(tmp_path / "p"), ["v"])
    tables.publish(df, str(tmp_path / "p"), ["v"], append=True)
    published = spark.read.parquet(str(tmp_path / "p"))
    assert published.columns == ["v", "id"] and published.count() == 50
    line = tables.report_json(spark.createDataFrame([(D(2025, 1, 1), None)], "day date, n int")).first().json
    assert json.loads(line) == {"day": "2025-01-01", "n": None}


@pytest.mark.parametrize("values, kind, expected", [
    ([D(2025, 1, 2), D(2025, 1, 1)], "date", ("2025-01-01", "2025-01-02")),
    ([dt.datetime(2025, 1, 2, 3)], "timestamp", ("2025-01-02", "2025-01-02")),
    (["2025-01-02", "2025-01-01"], "string", ("2025-01-01", "2025-01-02")), (["junk"], "string", (None, None))])
def test_min_max_dates(spark, values, kind, expected):
    assert tuple(tables.min_max_dates(spark.createDataFrame([(v,) for v in values], f"date {kind}")).first()) == expected


def test_min_max_without_date(spark):
    assert tuple(tables.min_max_dates(spark.range(1)).first()) == (None, None)


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.ledger_entry(spark, path, product="merc") is None
    for product, top, at in (("merc", "2025-01-02", "b"), ("merc", "2025-01-05", "a"), ("carr", "2025-02-01", "c")):
        ledger.ledger_append(spark, path, product, "src", "dst", "2025-01-01", top, occurred_at=at)
    assert ledger.ledger_entry(spark, path, product="merc", data_source="src", destination="dst").max_date == "2025-01-05"
    assert ledger.ledger_entry(spark, path, "occurred_at", product="merc").max_date == "2025-01-02"
    assert ledger.ledger_entry(spark, path, product="dia") is None


def test_incremental_runs(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("raw", "stg", "ledger"))
    os.makedirs(source)

    def run(**options):
        return incremental.run_incremental(spark, source, target, log, "merc", files.RAW_MERC, **options)

    assert run() is False and not os.path.exists(target)
    daily_csv(source, "2025-01-01", "a")
    assert run() is True
    daily_csv(source, "2025-01-02", "b", "c")
    assert run() is True and run() is False
    assert rows(tables.read_table(spark, target), "date", "name", "price") == [
        (D(2025, 1, 1), "a", 1.5), (D(2025, 1, 2), "b", 1.5), (D(2025, 1, 2), "c", 1.5)]
    assert rows(ledger.read_ledger(spark, log), "id", "min_date", "max_date") == [(1, "2025-01-01", "2025-01-01"), (2, "2025-01-02", "2025-01-02")]
    assert run(reprocess=True) is True and tables.read_table(spark, target).count() == 3
    daily_csv(source, "2025-01-03", "d")
    assert run(clean=lambda df: clean.clean_v2_merc(df).filter("false")) is False
    assert ledger.read_ledger(spark, log).count() == 3


def test_publish_runs(spark, tmp_path):
    log, path = str(tmp_path / "ledger"), str(tmp_path / "copy")
    products = spark.createDataFrame([("1", "Agua", "1 L")], "id string, name string, size string")
    whole = [incremental.PublishTask(products, "products", str(tmp_path / "products"), ["id"], searched=["name", "size"])]
    assert incremental.run_publish(spark, whole, log) == ["products"] == incremental.run_publish(spark, whole, log)
    assert rows(token_index.read_index(spark, str(tmp_path / "products_tokens")), "token") == [("1",), ("agua",), ("l",)]

    def details(*days):
        return spark.createDataFrame([(D(2025, 1, d), "1", v) for d, v in days], "date date, id string, price double")

    def publish(df, **options):
        return incremental.run_publish(spark, [incremental.PublishTask(df, "details", path, ["date", "id"], True)], log, **options)

    assert publish(details((1, 1.0), (2, 2.0))) == ["details"] and publish(details((1, 1.0), (2, 2.0))) == []
    changed = details((1, 9.0), (2, 9.0), (3, 3.0))
    assert publish(changed) == ["details"]
    assert rows(spark.read.parquet(path), "date", "price") == [(D(2025, 1, 1), 1.0), (D(2025, 1, 2), 2.0), (D(2025, 1, 3), 3.0)]
    assert publish(changed, overlap_days=2) == ["details"]
    assert rows(spark.read.parquet(path), "date", "price") == [(D(2025, 1, 1), 1.0), (D(2025, 1, 2), 9.0), (D(2025, 1, 3), 3.0)]


def test_stream_ingest_is_exactly_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("raw", "stg", "cp"))
    daily_csv(source, "2025-01-01", "a")

    def run():
        stream = ingest.read_stream(spark, source, files.RAW_MERC, "csv")
        ingest.ingest(stream, clean.clean_v2_merc, target, checkpoint, cluster=("name", "size")).awaitTermination()
        return rows(tables.read_table(spark, target), "date", "name")

    assert run() == run() == [(D(2025, 1, 1), "a")]
    write(f"{source}/2025-01-01-late.csv", HEADER + 'late,"1,50 €",,1 L,A > B,,2025-01-01\n')
    assert run() == [(D(2025, 1, 1), "a"), (D(2025, 1, 1), "late")]


def test_stream_daily_lowest(spark, tmp_path):
    data = [(dt.datetime(2025, 1, d, h), 1, float(10 * d - h)) for d in (1, 2, 9) for h in (1, 2)]
    source = str(tmp_path / "s")
    spark.createDataFrame(data, "ts timestamp, k int, v double").write.parquet(source)
    stream = ingest.read_stream(spark, source, spark.read.parquet(source).schema)
    ingest.daily_lowest(stream, str(tmp_path / "t"), str(tmp_path / "c"), "k", "ts", "v").awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "t")), "date", "price") == [(D(2025, 1, 1), 8.0), (D(2025, 1, 2), 18.0), (D(2025, 1, 9), 88.0)]
    spark.createDataFrame([(dt.datetime(2025, 1, 1, 5), 1, 0.5)], "ts timestamp, k int, v double").write.mode("append").parquet(source)
    late = ingest.read_stream(spark, source, spark.read.parquet(source).schema)
    ingest.daily_lowest(late, str(tmp_path / "t"), str(tmp_path / "c"), "k", "ts", "v").awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "t")), "date", "price")[0] == (D(2025, 1, 1), 0.5)


def test_stream_numbers_a_day_as_one(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("raw", "stg", "cp"))
    for i in range(3):
        write(f"{source}/2025-01-01-{i}.csv", HEADER + f'same,"{i},50 €",,1 L,A > B,,2025-01-01\n')
    stream = ingest.read_stream(spark, source, files.RAW_MERC, "csv", max_files=1)
    ingest.ingest(stream, clean.clean_v2_merc, target, checkpoint).awaitTermination()
    assert rows(tables.read_table(spark, target), "dedup_id", "original_price") == [(1, 0.5), (2, 1.5), (3, 2.5)]


def test_layouts_and_snapshots_are_read_by_name(spark, tmp_path):
    write(f"{tmp_path}/2025-01-01.csv", "name,original_price,discount_price,size,category,date\nold,1,,s,c,2025-01-01\n")
    write(f"{tmp_path}/2025-01-02.csv", "\ufeff" + 'date,"category",image_url,promo,name\n2025-01-02,"a, b",u,p,new\nshort\n')
    got = files.read_raw_mixed(spark, str(tmp_path), files.RAW_MERC)
    assert rows(got, "name", "category", "image_url", "date") == [
        (None, None, None, "short"), ("new", "a, b", "u", "2025-01-02"), ("old", "c", None, "2025-01-01")]
    snapshot = str(tmp_path / "snapshot")
    tables.write_snapshot(got.filter("name is not null"), snapshot)
    assert rows(files.read_raw_mixed(spark, snapshot, files.RAW_MERC), "name", "date") == [("new", "2025-01-02"), ("old", "2025-01-01")]
    assert files.newest_files(spark, snapshot, files.RAW_MERC, None).count() == 2


def test_file_identity_is_the_path(spark, tmp_path):
    for day in (1, 2):
        daily_csv(f"{tmp_path}/day={day}", "2025-01-01", "a")
    got = files.read_csv_with_file(spark, f"{tmp_path}/*/*.csv", files.RAW_MERC)
    assert rows(got, "file") == [("day=1/2025-01-01.csv",), ("day=2/2025-01-01.csv",)]


def test_an_empty_reprocess_keeps_the_table(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("raw", "stg", "log"))
    daily_csv(source, "2025-01-01", "a")
    run = lambda f, again: incremental.run_incremental(spark, source, target, log, "merc", files.RAW_MERC, f, reprocess=again)
    assert run(clean.clean_v2_merc, False)
    assert not run(lambda df: clean.clean_v2_merc(df).filter("false"), True)
    assert tables.read_table(spark, target).count() == 1
    assert run(clean.clean_v2_merc, True) and tables.read_table(spark, target).count() == 1


def test_append_daily_rejects_nothing_and_reprocess_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    day = clean.empty_staging(spark).unionByName(
        spark.createDataFrame([(D(2025, 1, 1), 1, "a", 2.0)], "date date, dedup_id int, name string, price double"), allowMissingColumns=True)
    tables.append_daily(day, path, clean.STAGING)
    tables.append_daily(day.withColumn("extra", F.lit("x")), path, clean.STAGING)
    assert rows(tables.read_table(spark, path), "name", "extra") == [("a", None), ("a", "x")]
    tables.append_daily(day.withColumn("extra", F.lit("x")), path, clean.STAGING, reprocess=True)
    assert tables.read_table(spark, path).count() == 1 and "extra" not in tables.read_table(spark, path).columns


def test_sync_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, gone string")
    target = spark.createDataFrame([], "b string, a long").schema
    assert tables.sync_columns(df, target).dtypes == [("b", "string"), ("a", "bigint")]
    assert tables.sync_columns(df, target, drop_removed=False).columns == ["b", "a", "gone"]


def test_bad_date_stops_the_run(spark, tmp_path):
    source = str(tmp_path / "raw")
    write(f"{source}/2025-01-01.csv", HEADER + "a,,,,,,01/01/2025\n")
    # Spark's own error or the gateway's, depending on what ran before in the session.
    with pytest.raises(Exception, match="01/01/2025"):
        incremental.run_incremental(spark, source, str(tmp_path / "t"), str(tmp_path / "l"), "merc", files.RAW_MERC)
