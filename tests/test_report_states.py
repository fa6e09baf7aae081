"""Report states: batches in any order equal a full build, only touched cells are written, a killed run changes nothing."""

import datetime as dt
import random

import pytest

from conftest import rows
from pricelake.operators import reports
from pricelake.plans import report_states
from pricelake.sinks import manifest

FACT = "fact_date date, product_key string, category_key string, dedup_id int, price double, original_price double"
AS_OF = "2024-06-01"


def observations(n=400):
    draw, out = random.Random(5), {}
    for _ in range(n):
        key = (dt.date(2024, draw.randrange(1, 5), draw.randrange(1, 29)), f"p{draw.randrange(30)}", f"c{draw.randrange(3)}", draw.randrange(2))
        out[key] = (*key, draw.choice([0.0, 1.0, 2.5, 4.0, None]), draw.choice([1.0, 3.0, 8.0, 9.0]))
    return list(out.values())


def close(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


def same_as_full(spark, root, data):
    fact = spark.createDataFrame(data, FACT)
    monthly = reports.monthly_products(fact, None, AS_OF)
    want = {
        "monthly_products": monthly,
        "monthly_category_trends": reports.category_trends(monthly),
        "monthly_product_top_movers": reports.top_movers(monthly, AS_OF),
    }
    got = report_states.reports(spark, root, AS_OF)
    for name, df in want.items():
        assert got[name].columns == df.columns
        assert close(got[name]) == close(df), name


def test_batches_equal_a_full_build_and_a_killed_run_changes_nothing(spark, tmp_path, monkeypatch):
    root, data = str(tmp_path / "states"), observations()
    give = lambda some, **more: report_states.apply_batch(spark, root, spark.createDataFrame(some, FACT), AS_OF, **more)
    assert report_states.reports(spark, root, AS_OF) == {} and give([]) == []
    give(data[::2], split=4)
    give(data[::2])  # again
    before = report_states.reports(spark, root, AS_OF)["monthly_products"].count()
    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            give(data[1::2])
    assert report_states.reports(spark, root, AS_OF)["monthly_products"].count() == before
    same_as_full(spark, root, data[::2])
    give(data[1::2])
    same_as_full(spark, root, data)


def test_a_batch_writes_its_own_cells_and_a_month_can_be_replaced(spark, tmp_path):
    root, data = str(tmp_path / "states"), observations()
    give = lambda some, **more: report_states.apply_batch(spark, root, spark.createDataFrame(some, FACT), AS_OF, **more)
    give(data, split=4)
    old = manifest.latest(spark, root)[1]["parts"]
    late = (dt.date(2024, 2, 29), "p3", "c1", 0, 7.0, 7.5)
    cells = give([late])
    new = manifest.latest(spark, root)[1]["parts"]
    assert len(cells) == 1 and cells[0].startswith("2024-02_") and {c for c in new if new[c] != old.get(c)} == set(cells)
    same_as_full(spark, root, [*data, late])
    kept = [r for r in data if r[0].month != 2]
    february = [(dt.date(2024, 2, 1), "p1", "c0", 0, 5.0, 5.0)]
    give(february, replace=True)
    same_as_full(spark, root, kept + february)
