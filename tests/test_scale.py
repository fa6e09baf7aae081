"""Properties of the plans that matter on large data."""

import datetime as dt
import os
import re

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from pricelake.operators import clean, refs, reports, star
from pricelake.operators.numbering import number_duplicates
from pricelake.sources import files

SF = "/root/testdata/sf0.001"
D = dt.date


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after adaptive changes."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    text = execution.executedPlan().toString()
    return text.split("Initial Plan")[0]


@pytest.fixture()
def conf(spark):
    before = {}

    def put(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Queries that write are left out, as their last step is a read; these only sound like writers.
WRITERS = re.compile("append|reprocess|overwrite|upsert|publish|stored|refreshed|snapshot|batches|run|ledger|stream|migrate_csv")
READERS = {"migrate_report", "ledger_last"}


@pytest.mark.parametrize("name", sorted(n for n in entry_point.queries() if n in READERS or not WRITERS.search(n)))
def test_no_cross_or_nested_loop_joins(spark, name):
    text = plan(entry_point.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_moving_averages_read_three_columns(spark):
    text = plan(entry_point.queries()["moving_averages"](spark, SF))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>", text)


def test_scan_since_is_pushed_to_the_file(spark, tmp_path):
    spark.createDataFrame([(D(2025, 1, 1), "a")], "date date, v string").write.parquet(str(tmp_path / "t"))
    text = plan(files.scan_since(spark.read.parquet(str(tmp_path / "t")), "2025-01-01"))
    assert "GreaterThan(date,2025-01-01)" in text


def test_recent_reports_prune_days(spark, tmp_path):
    fact = spark.createDataFrame(
        [(D(2024, 1, 1), "p", "c", 1, 1.0, 1.0), (D(2025, 1, 1), "p", "c", 1, 1.0, 1.0)],
        "fact_date date, product_key string, category_key string, dedup_id int, price double, original_price double")
    fact.write.partitionBy("fact_date").parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    products = spark.createDataFrame([("p", "n", "s", None)], "product_key string, name string, size string, image_url string")
    categories = spark.createDataFrame([("c", "x", "y")], "category_key string, category string, subcategory string")
    for df in (
        reports.price_report(stored, products, "2025-01-02", 30),
        reports.monthly_products(stored, None, "2025-01-02", only_current=True),
        refs.price_details(stored, as_of="2025-01-02", months=1),
        refs.ref_products(stored, None, categories, products, "2025-01-02", 30),
    ):
        assert re.search(r"PartitionFilters: \[[^\]]*fact_date#\d+ >= ", plan(df))


def test_old_files_are_not_opened(spark, tmp_path):
    for day in ("2025-01-01", "2025-01-03"):
        spark.createDataFrame([(day,)], "name string").coalesce(1).write.parquet(str(tmp_path / f"day={day}"))
    broken = next(tmp_path.glob("day=2025-01-01/*.parquet"))
    broken.write_bytes(b"not parquet")
    crc = broken.with_name(f".{broken.name}.crc")
    if crc.exists():
        os.rename(crc, crc.with_suffix(".old"))
    got = files.read_raw_mixed(spark, str(tmp_path), files.RAW_MERC, after="2025-01-01")
    assert rows(got, "name") == [("2025-01-03",)]


def test_monthly_report_stays_a_hash_aggregate(spark):
    text = plan(entry_point.queries()["monthly_products"](spark, SF))
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_top_movers_limit_before_the_shuffle(spark):
    text = plan(entry_point.queries()["monthly_product_top_movers"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_global_top_k_without_single_partition_window(spark):
    text = plan(entry_point.queries()["product_price_report_top_ytd"](spark, SF))
    assert "TakeOrderedAndProject" in text and "Window" not in text


@pytest.mark.parametrize("values", ["copies", "different"])
def test_a_hot_group_is_numbered_by_several_tasks(spark, conf, values):
    """One key holds most rows: its rows come out of several tasks, numbered without gaps."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    url = F.lit("same") if values == "copies" else F.concat(F.lit("u"), "id")
    df = spark.range(30_000).select(F.lit("hot").alias("k"), F.lit(1.0).alias("price"), url.alias("url"))
    df = df.unionByName(spark.range(500).selectExpr("concat('k', id) AS k", "1.0D AS price", "'x' AS url"))
    got = number_duplicates(df, ["k"], ["price"], hot_rows=1000).withColumn("task", F.spark_partition_id())
    hot = got.filter("k = 'hot'").agg(
        F.count_distinct("dedup_id"), F.min("dedup_id"), F.max("dedup_id"), F.count_distinct("task")
    ).first()
    assert tuple(hot)[:3] == (30_000, 1, 30_000) and hot[3] > 1
    assert got.filter("k <> 'hot'").agg(F.max("dedup_id")).first()[0] == 1


def test_no_task_sees_the_whole_hot_key(spark, conf):
    """10^5 different prices in one key are numbered in slots, none of which is a large part of the key."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions=16)
    df = spark.range(100_000).select(F.lit("hot").alias("k"), F.xxhash64("id").cast("double").alias("price"))
    got = number_duplicates(df, ["k"], ["price"], hot_rows=2000, drop_copies=True)
    parts = got.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count")).first()[0]
    assert parts < 40_000
    by_price = Window.partitionBy("k").orderBy("price")
    assert got.withColumn("want", F.row_number().over(by_price)).filter("want <> dedup_id").count() == 0


def test_large_groups_are_numbered_without_an_array_of_bounds(spark, conf):
    """Several large groups of different rows with copies, cut at ranges that fall inside groups; equal to one window."""
    conf(spark__sql__shuffle__partitions=8)
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).cast("double").alias("price"))
    got = number_duplicates(df, ["k"], ["price"], hot_rows=1500)
    text = plan(got)
    assert "ArrayType" not in text and "filter(" not in text and "NestedLoop" not in text and "CartesianProduct" not in text
    by_price = Window.partitionBy("k").orderBy("price")
    want = df.withColumn("dedup_id", F.row_number().over(by_price))
    assert got.exceptAll(want).count() == 0 and got.count() == 60_000


def test_hot_products_are_split_in_joins(spark, conf, tmp_path):
    """A third of all rows is one product: the label join and the fact lookup split it instead of one task taking it."""
    day = F.date_add(F.lit("2024-10-01").cast("date"), (F.col("id") % 60).cast("int"))
    data = spark.range(200_000).select(
        day.alias("date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 5000).cast("string"))).alias("name"),
        F.lit("1 L").alias("size"), F.lit("c").alias("category"), F.lit("s").alias("subcategory"),
        F.col("id").cast("double").alias("original_price"), F.lit(None).cast("double").alias("discount_price"),
        F.lit(1).alias("dedup_id"), F.lit(None).cast("string").alias("image_url"), F.col("id").cast("double").alias("price"))
    data.write.parquet(str(tmp_path / "rows"))
    data = spark.read.parquet(str(tmp_path / "rows"))
    conf(
        spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__shuffle__partitions=16, spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB", spark__sql__adaptive__skewJoin__skewedPartitionFactor=2)
    raw = data.select("date", "name", "size", "category", "subcategory", "original_price", "discount_price")
    relabelled = clean.recategorize(raw, "2024-11-05")
    assert "skew=true" in final_plan(relabelled)
    text = raw.withColumns({c: F.col(c).cast("string") for c in ("original_price", "discount_price")}).withColumn(
        "category", F.lit("c > s")).drop("subcategory")
    assert "skew=true" in final_plan(clean.clean_v1(text, "2024-11-05"))
    products, categories = star.maintain_dim_product(data), star.dim_category(data)
    fact = star.build_fact(data, star.dim_date(spark, "2024-10-01", "2025-01-01"), products, categories)
    assert "skew=true" in final_plan(fact)
    assert fact.count() == 200_000
