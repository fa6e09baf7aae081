"""Tables and indexes kept in parts: what is rewritten, what a killed or a second writer leaves, and equality with a rebuild."""

import glob
import os
import random

import pytest

from conftest import rows
from pricelake.operators import search
from pricelake.sinks import manifest, tables
from pricelake.sinks import search_index as token_index

KV = "k long, v string"


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/version=*/*/part-*.parquet")}


def table(spark, ks, v):
    return spark.createDataFrame([(k, v) for k in ks], KV)


def test_upsert_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, table(spark, range(2000), "old"), "k", buckets=32)
    before = files(path)
    assert len(before) == 32
    _, content = manifest.latest(spark, path)
    probe = str(tmp_path / "probe")
    tables.upsert(spark, probe, table(spark, [7, 11], "new"), "k", buckets=32)
    touched = set(manifest.latest(spark, probe)[1]["parts"])
    for bucket, (folder,) in content["parts"].items():
        if bucket not in touched:  # reading one of these would fail
            for f in glob.glob(f"{path}/{folder}/part-*.parquet"):
                os.rename(f, f"{f}.away")
    tables.upsert(spark, path, table(spark, [7, 11], "new"), "k")
    for f in glob.glob(f"{path}/version=*/*/*.away"):
        os.rename(f, f.removesuffix(".away"))
    added = set(files(path)) - set(before)
    assert {f.split("_bucket=")[1].split("/")[0] for f in added} == touched and len(touched) <= 2
    got = dict(rows(tables.read_current(spark, path), "k", "v"))
    assert got == {k: "new" if k in (7, 11) else "old" for k in range(2000)}


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    path, rng, expected = str(tmp_path / "t"), random.Random(2), {}
    for step in range(6):
        batch = {rng.randrange(300): f"{step}" for _ in range(rng.choice([0, 1, 40]))}
        tables.upsert(spark, path, spark.createDataFrame(list(batch.items()), KV), "k", replace=step == 3, buckets=4 + step)
        expected = batch if step == 3 else expected | batch
        assert dict(rows(tables.read_current(spark, path), "k", "v")) == expected


def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, table(spark, range(10), "old"), "k")
    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            tables.upsert(spark, path, table(spark, range(10), "new"), "k")
    assert {v for _, v in rows(tables.read_current(spark, path))} == {"old"}
    with open(f"{path}/_manifests/000000002.json", "w") as f:
        f.write('{"parts": {"1"')  # died while it wrote the manifest
    assert {v for _, v in rows(tables.read_current(spark, path))} == {"old"}
    tables.upsert(spark, path, table(spark, range(5), "new"), "k")
    assert sorted(v for _, v in rows(tables.read_current(spark, path))) == ["new"] * 5 + ["old"] * 5


def test_of_two_writers_the_second_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, table(spark, range(4), "a"), "k")
    inner = manifest.commit

    def late(spark, root, number, content):
        monkeypatch.setattr(manifest, "commit", inner)
        tables.upsert(spark, path, table(spark, [1], "faster"), "k")
        inner(spark, root, number, content)

    monkeypatch.setattr(manifest, "commit", late)
    with pytest.raises(manifest.Conflict):
        tables.upsert(spark, path, table(spark, [1, 2], "slower"), "k")
    assert rows(tables.read_current(spark, path)) == [(0, "a"), (1, "faster"), (2, "a"), (3, "a")]


def test_old_versions_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        tables.upsert(spark, path, table(spark, range(50), str(i)), "k", buckets=4, keep=2)
    assert len(glob.glob(f"{path}/version=*")) == 2
    assert len(glob.glob(f"{path}/_manifests/*.json")) == 2
    assert tables.read_current(spark, path).count() == 50


# ---------------------------------------------------------------------------------------------------------------- search index


PRODUCTS = "id string, name string, size string, categories string, subcategories string"
WORDS = ["agua", "Jamón", "ñora", "pan", "queso", "ガム", "한국", "café", "a", "7up", "x", "éclair", "İz", "ωmega"]


def products(spark, items):
    return spark.createDataFrame([(str(i), n, "1 l", "food", None) for i, n in items.items()], PRODUCTS)


def same_as_rebuilt(spark, path, items):
    return rows(token_index.read_index(spark, path), "token", "id") == rows(search.build_search_index(products(spark, items)), "token", "id")


def test_refreshes_equal_a_rebuild(spark, tmp_path):
    path, rng = str(tmp_path / "i"), random.Random(8)
    items = {i: " ".join(rng.sample(WORDS, 3)) for i in range(60)}
    for step in range(3):
        counts = token_index.refresh_index(products(spark, items), path, merge_after=2)
        assert counts["added"] == (60 if step == 0 else 5)
        assert same_as_rebuilt(spark, path, items)
        if step == 1:
            token_index.merge_index(spark, path)
            assert same_as_rebuilt(spark, path, items)
        assert set(token_index.refresh_index(products(spark, items), path).values()) == {0}
        for term in ("jam", "ガム", "한", "q", "pan ag", "ωm") if step == 2 else ("agua ñ",):
            found = token_index.search_stored(products(spark, items), path, term)
            whole = search.search_fts(search.build_search_index(products(spark, items)), products(spark, items), term)
            assert rows(found, "id") == rows(whole, "id"), term
        for i in rng.sample(sorted(items), 5):
            del items[i]
        for i in rng.sample(sorted(items), 5):
            items[i] = " ".join(rng.sample(WORDS, 2))
        items |= {1000 * (step + 1) + i: " ".join(rng.sample(WORDS, 3)) for i in range(5)}


def test_a_removed_product_that_comes_back(spark, tmp_path):
    path = str(tmp_path / "i")
    for items in ({1: "pan", 2: "agua"}, {2: "agua"}, {1: "pan", 2: "agua"}, {1: "queso", 2: "agua"}):
        token_index.refresh_index(products(spark, items), path)
        assert same_as_rebuilt(spark, path, items)


def test_merge_rewrites_only_touched_ranges(spark, tmp_path):
    path = str(tmp_path / "i")
    items = {i: f"{WORDS[i % 5]} extra" for i in range(100)}
    token_index.refresh_index(products(spark, items), path, chars=2)
    first = manifest.latest(spark, path)[1]["parts"]
    items |= {500: "zebra", 501: "zebra quagga"}
    token_index.refresh_index(products(spark, items), path)
    merged = token_index.merge_index(spark, path)
    assert set(merged) == {"50", "qu", "1", "l", "fo"}  # id, name and the fixed fields of the new products; "ze" is new and one folder
    now = manifest.latest(spark, path)[1]["parts"]
    assert all(now[s] == first[s] for s in first if s not in merged) and len(set(first) - set(merged)) > 80
    assert same_as_rebuilt(spark, path, items)


def test_a_search_opens_the_shards_of_its_words(spark, tmp_path):
    path = str(tmp_path / "i")
    token_index.refresh_index(products(spark, {i: f"{WORDS[i % 14]} extra" for i in range(100)}), path, chars=2)
    read = token_index.read_index(spark, path, token_index.wanted(["jamon", "qu"], 2))
    assert {f.split("shard=")[1].split("/")[0] for f in read.inputFiles()} == {"ja", "qu"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "shard" in plan.split("PartitionFilters")[1].split("]")[0]


def test_index_refresh_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    token_index.refresh_index(products(spark, {1: "pan"}), path)
    with monkeypatch.context() as m:
        m.setattr(token_index, "upsert", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):  # after the manifest, before the fingerprints
            token_index.refresh_index(products(spark, {1: "agua", 2: "pan"}), path)
    assert same_as_rebuilt(spark, path, {1: "agua", 2: "pan"})
    token_index.refresh_index(products(spark, {1: "agua", 2: "pan"}), path)
    assert same_as_rebuilt(spark, path, {1: "agua", 2: "pan"})
    token_index.merge_index(spark, path)
    assert same_as_rebuilt(spark, path, {1: "agua", 2: "pan"})


def test_only_days_that_differ_are_published(spark, tmp_path, monkeypatch):
    import datetime as dt

    from pricelake.plans import incremental

    path, shape = str(tmp_path / "copy"), "date date, id long, price double"
    day = lambda n: dt.date(2024, 1, n) if n else None
    frame = lambda data: spark.createDataFrame([(day(d), i, p) for d, i, p in data], shape)
    copy = lambda: sorted(((r.date, r.id, r.price) for r in spark.read.schema(shape).parquet(path).collect()), key=str)
    same = lambda data: sorted(((day(d), i, p) for d, i, p in data), key=str)
    data = [(d, i, float(d)) for d in (1, 2, 3) for i in range(4)] + [(None, 9, None)]
    assert incremental.publish_changed(frame(data), path, ["date", "id"]) == ["", "2024-01-01", "2024-01-02", "2024-01-03"]
    assert incremental.publish_changed(frame(data[::-1]).repartition(3), path, ["date", "id"]) == [] and copy() == same(data)
    # an old day rewritten, copies of a row (their xor is nothing), a day gone and a new one
    later = [r for r in data if r[0] != 3] + [(1, 0, 7.0), (2, 5, 1.0), (2, 5, 1.0), (4, 1, 1.0)]
    with monkeypatch.context() as m:  # dies after the copy, before the record
        m.setattr(incremental, "upsert", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            incremental.publish_changed(frame(later), path, ["date", "id"])
    want = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert incremental.publish_changed(frame(later), path, ["date", "id"]) == want and copy() == same(later)
    assert incremental.publish_changed(frame(later), path, ["date", "id"]) == []
    assert incremental.publish_changed(frame(data), path, ["date", "id"]) == want and copy() == same(data)
