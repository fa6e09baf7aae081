"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Inputs that are stored tables in a real run (raw rows, staging, star) are written once before the clock starts, as one file per core.
Every query writes its whole result to the `noop` sink; the value is the median after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from checks import inputs as I
from checks import queries as Q
from pricelake.operators import clean, refs, reports, search, stats
from pricelake.plans import models
from pricelake.session import build_session

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def cases(spark, sf):
    raw = Q.stored(spark, sf, "raw", lambda: I.raw(spark, sf))
    staging = Q.staging(spark, sf)
    star = Q.star_tables(spark, sf)
    fact, dates, products, categories = (
        star[n] for n in ("fact_product_price_daily", "dim_date", "dim_product", "dim_category")
    )
    monthly = Q.monthly_table(spark, sf)
    current = Q.stored(spark, sf, "ref_products", lambda: refs.ref_products(fact, dates, categories, products))
    parts = Q.products(spark, sf)
    lines = Q.stored(spark, sf, "lines", lambda: I.obs(spark, sf).selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS id", "name", "size", "category AS categories", "subcategory AS subcategories"
    ))
    listed = raw.withColumn("file", F.concat(F.lit("carr_"), "date", F.lit(".csv")))
    merc = ["name", "original_price", "discount_price", "size", "category", "image_url", "date"]

    return {
        "moving_averages": lambda: refs.moving_averages(refs.dedup_daily(I.daily(spark, sf))),
        "clean_v1": lambda: clean.clean_v1(raw.select(*merc[:5], raw["date"].cast("date").alias("date")), I.CUTOFF),
        "clean_v2_merc": lambda: clean.clean_v2_merc(raw.select(*merc), I.CUTOFF),
        "clean_v2_carr": lambda: clean.clean_v2_carr(raw.drop("size")),
        "dim_product": lambda: models.maintain_dim_product(staging),
        "fact": lambda: models.build_fact(staging, dates, products, categories),
        "price_details": lambda: refs.price_details(fact, dates),
        "ref_products": lambda: refs.ref_products(fact, dates, categories, products),
        "monthly_products": lambda: reports.monthly_products(fact, dates, I.AS_OF),
        "category_trends": lambda: reports.category_trends(monthly),
        "top_movers": lambda: reports.top_movers(monthly, I.AS_OF),
        "price_report_top_ytd": lambda: reports.top_ytd(reports.price_report(fact, products, I.AS_OF), current),
        "search_index": lambda: search.build_search_index(lines),
        "search_two_words": lambda: search.search_fts(search.build_search_index(lines), lines, "brand promo wid"),
        "search_products": lambda: search.search_fts(search.build_search_index(parts), parts, "jamon gi"),
        "listing_stats": lambda: stats.listing_stats(listed),
        "extract_listings": lambda: Q.QUERIES["extract_listings_merc"](spark, sf),
        "incremental_run": lambda: Q.QUERIES["incremental_run"](spark, sf),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    Q.FILES = int(cpus)
    only = sys.argv[1:]
    times = {}
    for name, build in cases(spark, sf).items():
        if only and name not in only:
            continue
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
