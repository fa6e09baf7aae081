"""Conversation repair, exact duplicates and the Merkle manifest against brute force and odd inputs."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import exact, jaccard, merkle, repair, store
from pricelake.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, leaf string, block string, path string, _part int, keep_id long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices(["Ab", "cd", "É", "x\ny"], k=rng.randint(0, 9))), rng.choice(["en", "fr", None, "É"]), rng.choice(["s", None])) for i in range(n)]
    rows += [(1000 + i, "the same hot TEXT", "en", "hot") for i in range(n // 2)]
    rows += [
        (5, rows[5][1], rows[5][2], rows[5][3]), (5, rows[5][1], rows[5][2], rows[5][3]), (None, "abc", "en", "s"), (None, "ABC", "en", "s"), (None, None, None, None),
        (2000, None, "de", "s"), (2001, "", "de", "s"), (2002, "Long " * 200_000, "de", "s"), (2003, "long " * 200_000, "de", "s"), (2004, "-", "-", "-"),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 1, "x", "y", "z", 2, 3) for r in rows], DOCS)


# ------------------------------------------------------------------------------------------------------------ exact duplicates


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_golomb_codes_read_back(n):
    gaps = np.random.default_rng(n).integers(0, 1 << 40, n, dtype=np.uint64)
    gaps[: n // 3] = 0
    assert (exact.ungolomb(exact.golomb(gaps), n) == gaps).all()
    even = np.random.default_rng(n).geometric(1e-3, n).astype(np.uint64)
    if n > 100:  # a little over the entropy of 11.4 bits
        assert len(exact.golomb(even)) * 8 / n < 12.2
    assert (exact.ungolomb(exact.golomb(even), n) == even).all()


def expected_groups(rows):
    by = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        by[lower(text)].append(doc_id)
    out = []
    for text, ids in by.items():
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        kept = False
        for x in ids:
            mine = x == keep and not kept
            kept |= mine
            out.append((x, keep, len(ids), mine, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows, owners", [(None, None), (7, 3), (1, 1)])
def test_exact_duplicates(spark, block_rows, owners):
    rows = corpus()
    got = exact.exact_duplicates(frame(spark, rows).repartition(5), block_rows, owners)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_groups(rows)


def test_exact_duplicates_of_no_rows(spark):
    got = exact.exact_duplicates(frame(spark, []))
    assert got.collect() == [] and got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_wrong_suspects_are_cleared_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact, "EXTRA_BITS", -6)  # fingerprints of a few bits: nearly every text is a suspect
    rows = corpus(120)
    got = exact.exact_duplicates(frame(spark, rows).repartition(3), 16, 2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_groups(rows)


def test_only_suspects_are_shuffled_with_their_text(spark):
    got = exact.exact_duplicates(frame(spark, corpus()))
    text = got._jdf.queryExecution().toString()
    assert "norm" not in re.findall(r"Exchange.*", text).__str__()
    assert "Bucketed: true" in text


# ------------------------------------------------------------------------------------------------------------ Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source = row
    return h(*map(field, (doc_id, source, lang, None if row[1] is None else len(row[1]), text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def expected_manifest(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = [levels([leaf(r, r[1]) for r in by[x]]) for x in langs]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            path = []
            for tree, at in ((trees[k], i), (top, k)):
                for level in tree[:-1]:
                    run = level[at - at % 8 :][:8]
                    path.append((at % 8, run[: at % 8] + run[at % 8 + 1 :]))
                    at //= 8
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            node = leaf(r, lower(r[1]) if tampered else r[1])
            for at, others in path:
                node = h(*others[:at], node, *others[at:])
            out.append((r[0], trees[k][0][i], trees[k][-1][0], top[-1][0], h(*(o for _, p in path for o in p)), node, node == top[-1][0]))
    return sorted(out, key=str)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("depth", [1, 2, 4])  # with small superblocks, many levels of them are joined
def test_manifest(spark, depth):
    rows = corpus()
    got = sorted((tuple(r) for r in merkle.manifest(frame(spark, rows).repartition(3), depth).select(MANIFEST).collect()), key=str)
    assert got == expected_manifest(rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, f"Text {i}", "en", "s") for i in range(n)]
    got = merkle.manifest(frame(spark, rows))
    assert got.columns == MANIFEST
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_manifest(rows)


def test_many_languages(spark):
    rows = [(i, f"Text {i}", f"l{i % 90}", "s") for i in range(300)]
    assert sorted((tuple(r) for r in merkle.manifest(frame(spark, rows)).collect()), key=str) == expected_manifest(rows)


# ------------------------------------------------------------------------------------------------------------ conversation repair


def solid(text):
    return text.strip(" \t\n\v\f\r")


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, fault): the first complete state in the order of cost and audit."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, list(made)
        if (i, state) in done:
            continue
        done.add((i, state))
        to, role = (3, "assistant") if state == 2 else (2, "user")
        heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*made, role + ":")))
        if i == len(rows):
            continue
        own, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, made))
        if fault in ("blank", "duplicate"):
            continue
        late = fault == "truncated"
        heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, to, (*made, f"{role}:{text}")))
        if own[:1] == ("a" if state == 2 else "u"):
            heapq.heappush(heap, (cost + late, audit + "K", i + 1, to, (*made, f"{own}:{text}")))
        if own[:1] == "s" and state == 0:
            heapq.heappush(heap, (cost + late, audit + "K", i + 1, 1, (*made, f"{own}:{text}")))
    return None


def expected_report(rows):
    """Of the rows (turn, role, text) of one damaged conversation."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, judged = set(), []
    for _, role, text in rows:
        end = solid(text)[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
    cost, audit, made = cheapest(judged)
    count = collections.Counter(f for _, _, f in judged)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()


def conversations(n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), None]:
        for _ in range(rng.choice([1, 2, 3, 5, 8, 13])):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "sam", "", None])
            text = rng.choice(["", " \t", "One.", "Two!", "Three?\n", "open", "Four.x", "Good. ", None, f"Own {rng.random()}.", f"Own {rng.random()}.", f"Own {rng.random()}"])
            rows.append((c, rng.choice([None, 0, 1, 2, 3, 4, 5, 9]), role, text))
        rows += rows[-1:] * (rng.random() < 0.2)
    return rows


def test_repair_equals_the_cheapest_path(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, cost int").repartition(7)
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in rows} | {-5}], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in repair.report(df, repair.repair(df), ids).collect()}
    by = collections.defaultdict(list)
    for c, *row in rows:
        by[c].append(row)
    assert got == {c: expected_report(x) for c, x in by.items()} | {-5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def spelt(node):
    out = ""
    while node is not None:
        out, node = node.edit + out, node.parent
    return out


def reachable(search):
    seen, todo = set(), [n for _, _, n in search.best.values()]
    while todo:
        node = todo.pop()
        if node is not None and id(node) not in seen:
            seen.add(id(node))
            todo.append(node.parent)
    return len(seen)


@pytest.mark.parametrize("seed", range(40))
def test_survivors_keep_their_order_and_free_what_is_resolved(seed):
    rng = random.Random(seed)
    roles = rng.choice([["user"], ["user", "assistant"], ["user", "assistant", "system"], ["tool", "user", "assistant"]])
    rows = [(rng.choice(roles), str(i), rng.choice([None, None, None, "truncated", "blank"])) for i in range(60)]
    search, audit, cost = repair.Viterbi(), "", 0
    for row in rows:
        for node in search.push(row, row[0], row[2]):
            audit, cost = audit + node.edit, cost + node.cost
        ends = sorted(search.best.values(), key=lambda b: b[1])
        assert [spelt(n) for _, _, n in ends] == sorted(spelt(n) for _, _, n in ends)  # the rank is the order of the whole suffixes
        assert search.live == reachable(search)  # no node but those that survivors need
    for node in search.close():
        audit, cost = audit + node.edit, cost + node.cost
    assert (cost, audit) == cheapest(rows)[:2]


def test_memory_holds_the_unresolved_rows_only():
    search, live, given = repair.Viterbi(), 0, 0
    for i in range(20_000):
        row = ("user" if i % 2 == 0 else "assistant", str(i), None if i % 50 else "truncated")
        given += sum(1 for _ in search.push(row, row[0], row[2]))
        live = max(live, search.live)
    assert live < 30 and given > 19_950


def test_one_long_conversation_and_no_rows(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"Text {i}.") for i in range(3000)]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema)
    got = repair.report(df, repair.repair(df), df).collect()
    assert [tuple(r)[1:] for r in got] == [expected_report([r[1:] for r in rows])]
    none = spark.createDataFrame([], schema)
    assert repair.report(none, repair.repair(none), none).collect() == []
    text = "very long " * 300_000 + "."
    long = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "user", text)], schema)
    assert [r["audit"] for r in repair.report(long, repair.repair(long), long).collect()] == ["KKD"]


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c? d") for c in range(40) for t in [*range(5), None]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "A b c d" if kind == 2 else text)
            expected += [row] * (2 if kind == 3 else 1)
    got = [tuple(r) for r in repair.damage(df).select("conv_id", "turn", "role", "text").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


# ------------------------------------------------------------------------------------------------------------ n-gram Jaccard join


def test_rows_that_share_an_id_keep_the_links_of_all_their_texts(spark):
    rng = random.Random(1)
    one, two = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(2))
    rows = [(1, one + " x"), (2, one), (2, two), (3, two + " y"), (4, "alone " * 3)] + [(100 + i, one) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df.repartition(4), 4, 85).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4} | {100 + i: 1 for i in range(300)}


def texts_shuffled(df):
    """The rows with a text that went through an exchange while ``df`` was collected."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            if kind == "ShuffleExchangeExec" and "text#" in plan.output().mkString(" "):
                n += plan.metrics().apply("shuffleRecordsWritten").value()
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return n


@pytest.mark.parametrize("twice", [[], [(7, "Seven"), (7, None), (8, "a b")]])
def test_keep_one_leaves_the_texts_of_other_rows_where_they_are(spark, twice):
    rng = random.Random(8)
    one = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))) for i in range(400)]
    copies = [(1000 + i, one[i][1].upper()) for i in range(0, 40)]
    rows = [*one, *copies, *twice, (None, one[3][1]), (None, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, filter_word int, filter_seen string")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        kept = jaccard.keep_one(df)
        shuffled = texts_shuffled(kept)
    finally:
        spark.conf.set(name, before)
    # by id, the least text, a null one as an empty one, of those that stay
    want = {i: t for i, t in one} | ({7: None, 8: "a b"} if twice else {})
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == df.columns and {r[2:] for r in got} == {(1, "x")}
    assert {r[0]: r[1] for r in got if r[0] is not None} == want and len(got) == len(want) + 2
    assert shuffled <= 20


def test_apart_loses_no_row(spark):
    df = spark.createDataFrame([(i, "t") for i in range(20_000)] + [(None, "t"), (5, "u")], "doc_id int, text string")
    for ids in ([], [5], range(0, 20_000, 7)):
        may, rest = (x.collect() for x in jaccard._apart(df, spark.createDataFrame([(i,) for i in ids], "doc_id long")))
        assert len(may) + len(rest) == 20_002 and not {r.doc_id for r in rest} & set(ids)
        assert len(may) <= 1.02 * (len(ids) + 1) + 200


def test_keys_of_one_block_are_shuffled_once(spark):
    """A block meets itself without a second copy of its rows; pairs across blocks are found as well."""
    bits = bytes(8)
    rows = [(k, False, h, 10, bits, h // 2, blocks, h % blocks) for k, blocks in ((1, 1), (2, 3)) for h in range(10 * k, 10 * k + 7)]
    df = spark.createDataFrame(rows, "key long, wide boolean, h1 long, n_shingles long, bits binary, component long, blocks int, block int")
    want = {(a, b) for k in (10, 20) for a in range(k, k + 7) for b in range(a + 1, k + 7) if a // 2 != b // 2}
    crossed = jaccard._crossed(df, 80, False)
    assert {tuple(r) for r in crossed.collect()} == want
    one = jaccard._crossed(df.where("blocks = 1"), 80, False)
    assert one.count() == len([x for x in want if x[0] < 20])


def test_copies_send_their_keys_once_per_task(spark):
    text = " ".join(f"w{i}" for i in range(120))
    one, many = (spark.createDataFrame([(i, text) for i in range(n)], "doc_id long, text string").coalesce(1) for n in (1, 5000))
    assert jaccard.signatures(many, 4, 85).count() == jaccard.signatures(one, 4, 85).count()


def brute_roots(links):
    root = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("held", [8, 1 << 20])
def test_components_by_rounds_and_in_one_task(spark, held):
    draw = random.Random(held)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = [(draw.randrange(90), draw.randrange(90)) for _ in range(45)] + chain + [(300, x) for x in range(301, 330)] + chain[:9]
    draw.shuffle(links)
    links = [(a, b) for a, b in links if a != b] + [(-5, 9), (2**62, -(2**62))]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(5), held=held).collect()
    assert len(got) == len({r.id for r in got}) and {r.id: r.component for r in got} == brute_roots(links)
    assert components(spark.createDataFrame([], "a long, b long"), held=held).count() == 0
    assert components(spark.createDataFrame([(4, 4), (None, 3)], "a long, b long"), held=held).count() == 0


def test_batches_for_python_are_bounded_by_bytes(spark):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 4000) AS text")
    got = store.stored(docs.mapInArrow(run, "n long, bytes long"), "sizes").collect()
    assert sum(r.n for r in got) == 3000 and max(r.bytes for r in got) < 5 << 20
    assert spark.conf.get(name) == before


# ------------------------------------------------------------------------------------------------------- passages in many documents


def shingle_set(text, width):
    words = text.split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


def with_a_passage(n=4000, pairs=30, seed=8):
    """Texts that share a passage and no other shingle, and a near copy of some of them."""
    draw = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [f"{passage} " + " ".join(f"u{i}_{j}" for j in range(draw.randint(110, 130))) for i in range(n)]
    for i in range(pairs):
        words = texts[i * 7].split()
        words[100 + i % 9] = words[150] = f"other{i}"
        texts.append(" ".join(words))
    return texts


def test_a_common_passage_makes_no_group_of_all_its_documents(spark, monkeypatch):
    """Before, all classes of the large keys of one passage were one group, whose blocks were sent once for each other block."""
    texts, seen, real = with_a_passage(), [], jaccard._crossed

    def crossed(rows, *args):
        seen.append(rows.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return real(rows, *args)

    monkeypatch.setattr(jaccard, "_crossed", crossed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df, 5, 80).collect()}
    sets = [shingle_set(t, 5) for t in texts]
    copy_of = {4000 + i: i * 7 for i in range(30)}
    assert all(near(sets[a], sets[b], 80) for a, b in copy_of.items())
    assert got == {i: copy_of.get(i, i) for i in range(len(texts))}
    assert seen and max(seen) <= 200


@pytest.mark.parametrize("percent", [50, 80, 93])
def test_sets_that_link_share_a_first_key(spark, percent):
    """Whatever shingles count as common, also where they are most of a set."""
    draw, texts = random.Random(percent), []
    for base in range(12):
        words = [f"w{draw.randrange(30) if base % 2 else (base, i)}".replace(" ", "") for i in range(draw.randint(3, 90))]
        for _ in range(9):
            changed = list(words)
            for _ in range(draw.randrange(1 + len(words) * (100 - percent) // 150)):
                changed[draw.randrange(len(words))] = f"c{draw.randrange(10**6)}"
            texts.append(" ".join(changed[draw.randrange(2) :]))
    sets = [shingle_set(t, 2) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and near(sets[i], sets[j], percent)}
    assert len(want) > 20
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    names = {i: r.h1 for i, r in enumerate(jaccard.describe(rows, 2, percent).collect())}
    bits, sizes = 20, np.arange(1 << 20)
    few = np.unique(np.random.default_rng(percent).integers(0, 1 << 20, 1 << 18)).astype(np.uint64)
    for slots in (np.zeros(0, np.uint64), few, sizes.astype(np.uint64)):
        keys = collections.defaultdict(set)
        for r in jaccard._first_keys(rows, (bits, slots, sizes[: len(slots)] % 50 + 65), 2, percent).collect():
            keys[r.h1].add(r.key)
        assert all(names[i] == names[j] or keys[names[i]] & keys[names[j]] for i, j in want)


def test_common_shingles_are_counted_over_all_tasks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 1 << 12)
    texts = with_a_passage(300, 0)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    total = sum(len(shingle_set(t, 5)) for t in texts)
    bits, slots, times = jaccard._common(df, total, 5)
    assert 1 << bits >= 8 * total and len(slots) == len(times) == 66 and (np.diff(slots.astype(np.int64)) > 0).all()
    assert times.min() >= 300 and times.max() <= 303  # a slot may hold another shingle by chance


def test_shuffle_files_go_when_a_table_is_stored(spark):
    """Before, they stayed until the driver collected its garbage, so a stage's disk grew with all its shuffles."""
    import pathlib
    import time

    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {p.name for d in dirs for p in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}
    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    kept = spark.conf.get(name, None)
    df = store.stored(spark.range(50_000).repartition(5, "id").groupBy("id").count(), "gone")
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and df.count() == 50_000 and spark.conf.get(name, None) == kept
