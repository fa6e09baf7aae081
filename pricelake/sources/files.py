"""Batch sources: daily files, file selection, table scans, day spine."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.session import scratch_path

# The columns of the raw files.
RAW_V1 = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("name", "original_price", "discount_price", "size", "category")]
    + [T.StructField("date", T.DateType())]
)
RAW_MERC = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("name", "original_price", "discount_price", "size", "category", "image_url", "date")
    ]
)
RAW_CARR = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("name", "original_price", "discount_price", "price_per_unit", "category", "image_url",
                  "product_url", "source_page", "date")
    ]
)
# Fixed value: what a daily file is named after.
DATE_IN_NAME = r"\d{4}-\d{2}-\d{2}"


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Headered CSV of a declared schema; no inference pass over the data."""
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, schema=schema)


def read_csv_by_name(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, after: str | None = None, **options: str) -> DataFrame:
    """Headered CSV files of one or several layouts, each read by its own header, as text in the columns of `schema`.

    Columns a file lacks are null, columns beyond `schema` are left out, short rows are filled with nulls. The headers
    are found in a first pass that keeps one line per file; `_file` names the file of a row. A file without such a header is an error.
    """
    paths = path if isinstance(path, str) else list(path)
    names = schema.fieldNames()
    known = F.array(*[F.lit(n) for n in names])
    lines = files_after(spark.read.options(**options).text(paths), after)
    fields = F.transform(F.split(F.regexp_replace("value", "^\ufeff|\r$", ""), ","), lambda f: F.trim(F.regexp_replace(f, '^"|"$', "")))
    told = lines.select(F.col("_metadata.file_path").alias("_of"), fields.alias("header"))
    told = told.withColumn("fits", F.size(F.array_intersect("header", known))).filter((F.col("fits") >= 2) | (F.col("fits") == len(names)))
    headers = scratch_path(spark, "headers")
    told.groupBy("_of").agg(F.max_by("header", "fits").alias("header")).write.parquet(headers)
    headers = spark.read.schema("_of string, header array<string>").parquet(headers)
    _refuse_unknown(spark, paths, headers, after, options)
    width = headers.agg(F.max(F.size("header"))).first()[0] or len(names)
    cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    rows = files_after(spark.read.options(**options, header="false").schema(cells).csv(paths), after)
    rows = rows.select(F.col("_metadata.file_path").alias("_file"), F.array(*cells.fieldNames()).alias("cells"))
    rows = rows.join(headers, F.col("_file") == F.col("_of"))
    # An escaped byte-order mark stays in the first cell of a header row.
    first = F.regexp_replace(F.get("cells", F.lit(0)), "^\ufeff", "")
    data = rows.filter(~((first == F.get("header", F.lit(0))) & (F.coalesce(F.get("cells", F.lit(1)), F.lit("")) == F.coalesce(F.get("header", F.lit(1)), F.lit("")))))
    at = lambda n: F.array_position("header", F.lit(n)).cast("int") - 1
    value = lambda n: F.when(at(n) >= 0, F.get("cells", at(n)))
    return data.select(*[value(n).alias(n) for n in names], "_file")


def _refuse_unknown(spark: SparkSession, paths: str | list[str], headers: DataFrame, after: str | None, options: dict[str, str]) -> None:
    """An error that names files with text but without a header: their rows would be lost without a word."""
    listed = files_after(spark.read.format("binaryFile").options(**options).load(paths), after).filter("length > 3")
    lost = listed.select(F.col("_metadata.file_path").alias("_of")).join(headers, "_of", "left_anti")
    names = [r[0] for r in lost.orderBy("_of").limit(5).collect()]
    if names:
        raise ValueError(f"no header with at least two known columns in {', '.join(names)}")


def read_raw_mixed(spark: SparkSession, path: str, schema: T.StructType, after: str | None = None) -> DataFrame:
    """A folder of CSV and Parquet files stacked by column name; columns a file lacks become null.

    CSV columns are found by each file's header. A `date` that is only in a folder's name (`date=...`) is taken from there.
    `after` leaves out the files dated up to that day.
    """
    options = {"recursiveFileLookup": "true"}
    csv = read_csv_by_name(spark, path, schema, after, **options, pathGlobFilter="*.csv")
    csv = csv.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], "_file")
    parquet = spark.read.options(**options, pathGlobFilter="*.parquet").schema(schema).parquet(path)
    parquet = files_after(parquet, after).select("*", F.col("_metadata.file_path").alias("_file"))
    both = csv.unionByName(parquet, allowMissingColumns=True)
    if "date" in schema.fieldNames():
        folder = F.try_to_date(F.regexp_extract("_file", f"/date=({DATE_IN_NAME})/", 1), "yyyy-MM-dd").cast(schema["date"].dataType)
        both = both.withColumn("date", F.coalesce("date", folder))
    return both.drop("_file")


def read_csv_with_file(spark: SparkSession, glob: str, schema: T.StructType) -> DataFrame:
    """Headered UTF-8 CSV (a byte-order mark is fine), by each file's header, with the file each row came from: its path below the glob's fixed part."""
    fixed = re.split(r"[*?\[{]", glob, maxsplit=1)[0]
    root = re.escape(re.sub(r"^\w+:/+", "/", fixed.rsplit("/", 1)[0]))
    rows = read_csv_by_name(spark, glob, schema)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return rows.select(*typed, F.regexp_extract("_file", f"{root}/(.*)$", 1).alias("file"))


def file_date(name: Column | str = "_metadata.file_name", path: Column | str = "_metadata.file_path") -> Column:
    """The date in a file name, or else the last one in its path; null when there is none or it is impossible."""
    name, path = (F.col(c) if isinstance(c, str) else c for c in (name, path))
    in_name = F.regexp_extract(name, DATE_IN_NAME, 0)
    in_path = F.regexp_extract(path, f".*({DATE_IN_NAME})", 1)
    return F.try_to_date(F.when(in_name != "", in_name).otherwise(in_path), "yyyy-MM-dd")


def files_after(df: DataFrame, watermark: str | None) -> DataFrame:
    """Rows of the files dated strictly after the watermark; the other files are not opened."""
    if watermark is None:
        return df
    return df.filter(file_date() > F.lit(watermark).cast("date"))


def scan_since(df: DataFrame, watermark: str | None, column: str = "date") -> DataFrame:
    """Rows dated after the watermark of an earlier run, or all rows."""
    return df if watermark is None else df.filter(F.col(column) > F.lit(watermark).cast("date"))


def scan_range(df: DataFrame, start: str | None, end: str | None, column: str = "date") -> DataFrame:
    """Rows dated from `start` to `end`, both included."""
    if not start or not end:
        raise ValueError("both start and end are needed")
    if dt.date.fromisoformat(str(start)) > dt.date.fromisoformat(str(end)):
        raise ValueError(f"start {start} is after end {end}")
    return df.filter(F.col(column).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def dev_sample(df: DataFrame, names: Sequence[str], as_of: str, days: int = 30) -> DataFrame:
    """The named products of the last `days` up to `as_of`."""
    today = F.lit(str(as_of)).cast("date")
    return df.filter(F.col("date").between(F.date_sub(today, days), today) & F.col("name").isin(list(names)))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from `start` up to, not including, `end`."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1)
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and size of the files below `path`; contents are not read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob).load(path)
    return files.select("path", F.col("length").alias("bytes"))


def file_inventory(spark: SparkSession, path: str, glob: str = "*.csv", parquet_ratio: float = 0.3) -> DataFrame:
    """Number and bytes of the files, with the size and savings to expect as Parquet."""
    totals = list_files(spark, path, glob).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )
    expected = F.col("bytes") * parquet_ratio
    return totals.select(
        "files", "bytes", expected.alias("parquet_bytes"), (F.col("bytes") - expected).alias("saved_bytes")
    )


def newest_files(
    spark: SparkSession, path: str, schema: T.StructType, n: int | None = -1, fmt: str = "parquet"
) -> DataFrame:
    """Rows of the `n` newest files by name (-1: the newest one, None: all files), in the columns of `schema`.

    No files give an empty frame of the schema. The driver sees no file names: the rows are semi-joined with them.
    """
    files = list_files(spark, path, f"*.{fmt}")
    if files.isEmpty():
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(recursiveFileLookup="true", pathGlobFilter=f"*.{fmt}")
    if fmt == "csv":
        reader = reader.option("header", "true")
    rows = reader.format(fmt).load(path)
    if n is not None:
        newest = files.orderBy(F.col("path").desc()).limit(1 if n == -1 else n).select("path")
        rows = rows.withColumn("_path", F.col("_metadata.file_path")).join(newest, F.col("_path") == F.col("path"), "left_semi")
    return rows.select(*schema.fieldNames())
