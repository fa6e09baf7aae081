"""The ten operators and the pipeline against brute force, round trips and odd inputs."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import chat, ctw, jaccard, mixing, packing, pseudonyms, quality, secrets, tokens, topk, urls

public_tokenizers = pytest.importorskip("public_tokenizers")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, topic string"
SYLLABLES = "ka lo mi re tu sen dor val pin ost era qui ban".split()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    rows = [[i, prose(rng, rng.randint(55, 160)), rng.choice(["en", "fr"]), "big" if i % 3 == 0 else f"s{i % 4}"] for i in range(n)]
    for i in range(0, 30, 3):  # near copies, exact copies
        w = rows[i][1].split(" ")
        w[len(w) // 2] = "Changed"
        rows[i + 1][1] = " ".join(w)
        rows[i + 2][1] = rows[i][1]
    rows += [
        [1000, None, None, None], [1001, "", "en", "big"], [1002, " \n\t ", "en", "s1"], [1003, "one", "en", "s1"],
        [None, rows[0][1], "en", "s1"], [1004, prose(rng, 30_000), "en", "big"], [0, rows[0][1], rows[0][2], rows[0][3]],
        [1005, "### *** $$$ %%% x " * 60, "en", "big"], [1006, "É ñ Ω x−y " * 30, "fr", "s2"], [1007, "the same " * 100, "en", "s1"],
    ]
    return [(*r, len(r[1]) if r[1] else 0, "no", 7, "t") for r in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_ctw(texts, train):
    """log10 probability of each text by the definition, with dictionaries."""
    n = collections.defaultdict(lambda: [0, 0])
    seq = [b" ".join(w.encode() for w in WORD.findall(lower(t))) + b"\xff" for t in texts]

    def steps(s):
        past = b"\xff" * ctw.DEPTH + s
        for i, byte in enumerate(s):
            context = past[i : i + ctw.DEPTH][::-1]
            for j in range(8):
                yield context, (1 << j) | (byte >> (8 - j)), byte >> (7 - j) & 1

    for s, use in zip(seq, train):
        for context, node, bit in steps(s) if use else ():
            for d in range(ctw.DEPTH + 1):
                n[context[:d], node][bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
    children = collections.defaultdict(list)
    for context, node in n:
        if context:
            children[context[:-1], node].append((context, node))
    weighted, own = {}, {}
    for key in sorted(n, key=lambda k: -len(k[0])):
        e = kt(*n[key])
        if len(key[0]) == ctw.DEPTH:
            weighted[key], own[key] = e, 1.0
        else:
            weighted[key] = np.logaddexp(e, sum(weighted[c] for c in children[key])) - math.log(2)
            own[key] = math.exp(e - math.log(2) - weighted[key])
    out = []
    for s in seq:
        total = 0.0
        for context, node, bit in steps(s):
            p = None
            for d in range(ctw.DEPTH, -1, -1):
                a = n.get((context[:d], node), (0, 0))
                mine = (a[bit] + 0.5) / (sum(a) + 1)
                deeper = n.get((context[: d + 1], node)) if d < ctw.DEPTH else None
                p = mine if deeper is None else own[context[:d], node] * mine + (1 - own[context[:d], node]) * p
            total += math.log10(p)
        out.append(total)
    return out


def test_context_tree(spark, none):
    rng = random.Random(3)
    rows = [(i, prose(rng, 12)) for i in range(24)] + [(50, None), (51, ""), (None, "ka lo"), (3, "A b  C\n"), (3, "A b  C\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.lit(1)).withColumn("score", F.lit("x"))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r) for r in ctw.score(df).collect())
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    want = brute_ctw([t for _, t in rows], [not h for h in held])
    count = collections.Counter()
    for (_, t), h in zip(rows, held):
        if not h:
            count.update([*WORD.findall(lower(t)), None])
    total, distinct = sum(count.values()), len(count)
    expected = []
    for (i, t), h, s in zip(rows, held, want):
        w = [*WORD.findall(lower(t)), None]
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        expected.append((-1 if i is None else i, h, len(w), sum(count[x] > 0 for x in w), total, round(base, 6), round(s, 6)))
    have = [(i, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for i, r in got]
    assert sorted(have) == sorted(expected)
    assert ctw.score(none).count() == 0


def test_permutation_is_one_to_one_and_can_be_undone():
    for size in (2, 3, 10, 1000, 1 << 12):
        images = [pseudonyms.permute(i, size, b"k", "t") for i in range(size)]
        assert sorted(images) == list(range(size))
        assert [pseudonyms.permute(x, size, b"k", "t", back=True) for x in images] == list(range(size))


def test_pseudonyms(spark, docs, none):
    text = (
        "Call +1 (543) 555-9258, mail Bo.b42@mail8.example.com, card 4433 6680 4113 3334 or 4433668041133334, from 10.200.3.4 on 2024-02-29, "
        "31/12/1999, GB82WEST12345698765432, 219-09-9999; not 4433668041133335, 2024-02-30, 300.1.1.1, 1.2.3.4.5"
    )
    new, n = pseudonyms.pseudonymize_text(text, b"key")
    assert n == 9 and len(new) == len(text) and pseudonyms.pseudonymize_text(new, b"key", back=True) == (text, 9)
    assert pseudonyms.pseudonymize_text(text, b"other")[0] != new
    for same in ("4433668041133335", "2024-02-30", "300.1.1.1", "1.2.3.4.5"):
        assert same in new
    spaced, plain = re.search(r"card ([\d ]+) or (\d+)", new).groups()
    assert spaced.replace(" ", "") == plain and pseudonyms.luhn(plain[:-1]) == int(plain[-1]) and plain != "4433668041133334"
    rows = [(1, text), (2, "x " + text), (3, None), (4, ""), (5, "no numbers here"), (5, "no numbers here"), (6, "word " * 100_000 + text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_replaced", F.lit("old"))
    out = {r.doc_id: r for r in pseudonyms.pseudonymize(df, b"key").collect()}
    assert out[1].text == new and out[2].text == "x " + new and out[3].text is None and out[5].text == "no numbers here"
    assert out[6].text.endswith(new) and [out[i].n_replaced for i in (1, 3, 4, 5)] == [9, 0, 0, 0]
    assert pseudonyms.pseudonymize(docs, b"k").columns == [*docs.columns, "n_replaced"] and pseudonyms.pseudonymize(none, b"k").count() == 0


def test_pseudonyms_before_numbers_and_capitals():
    card, spaced, iban = "4467920212765298", "4111 1111 1111 1111", "BE68 5390 0754 7034"
    want = {v: pseudonyms.pseudonymize_text(v, b"key")[0] for v in (card, spaced, iban, iban.replace(" ", ""))}
    assert all(new != v for v, new in want.items())
    for lead, value, rest in (
        ("", card, " 12 items"), ("card ", card, " 123."), ("", spaced, " 7 days"), ("", iban, " EUR 20"), ("", iban.replace(" ", ""), " PAID"), ("12 ", card, ""),
        ("", iban, " PAID " + card), ("", card, " 2024-02-30"),
    ):
        new, n = pseudonyms.pseudonymize_text(lead + value + rest, b"key")
        assert new.startswith(lead + want[value]) and value not in new and card not in new and n == 1 + rest.count(card)
        assert pseudonyms.pseudonymize_text(new, b"key", back=True) == (lead + value + rest, n)


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_rules(spark, docs, rows, none):
    extra = spark.createDataFrame([(2000, "a b\na b\nc\n \na b", "en", "s1", 0, "", 0, ""), (2001, "a b c d a b c a b", "en", "s1", 0, "", 0, "")], DOCS)
    out = quality.judge(quality.measure(docs.union(extra))).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        n, chars, symbols, dup, repeat = brute_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat), r.doc_id
        failed = n < 50 or 100 * repeat > 50 * n
        assert r.base_failed == failed and not (failed and r.kept)
    kept = {r.doc_id: r.kept for r in out}
    assert not kept[1005] and all(kept[i] for i in range(120)) and kept[1004]
    assert quality.judge(quality.measure(none)).count() == 0


def test_quantile_sketches_merge_and_bound_the_quartiles(spark):
    values = [(("a", "b")[i % 2], "s", (i * i) % 9973) for i in range(2000)]
    df = spark.createDataFrame(values, "lang string, source string, n_symbols long").withColumns(
        {c: F.lit(1).cast("long") for c in ("n_words", "word_chars", "n_dup_lines", "n_repeat_words", "n_capitals")}
    )
    fine = quality.sketch(df, ["lang", "source"])
    one = quality.quartiles(quality.merge(fine, []), []).where("measure = 'symbols'").first()
    other = quality.quartiles(quality.sketch(df.repartition(5), []), []).where("measure = 'symbols'").first()
    assert (one.q1, one.q3, one.n) == (other.q1, other.q3, other.n)
    exact = sorted(v * 1000 for _, _, v in values)
    for got, want in ((one.q1, exact[499]), (one.q3, exact[1499])):
        assert got <= want <= got * (1 + 1 / 16) + 1


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(size=40)]) for i in range(400)]
    vectors += [(900, vectors[0][1]), (901, vectors[0][1]), (500, [1.0]), (902, None), (903, [None, 1.0]), (904, [math.nan]), (905, [math.inf]), (None, [1.0]), (950, [1e12, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(4)
    good = {i: [math.floor(256 * x) for x in v] for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:5]
        want += [(q, k + 1, i, max(-(2**63), min(2**63 - 1, -s))) for k, (s, i) in enumerate(scored)]
    for candidates in (df, df.where("vec_id <> 950 OR vec_id IS NULL")):  # exact whole numbers, and the floating point way
        got = topk.top_k(candidates.where("vec_id % 50 = 0"), candidates).collect()
        ids = {950} if candidates is not df else set()
        expected = want if not ids else [
            (q, k + 1, i, s) for q in good if q % 50 == 0 and q not in ids
            for k, (s, i) in enumerate([(-t, i) for t, i in sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and i not in ids)[:5]])
        ]
        assert sorted(map(tuple, got)) == sorted(expected)
    assert topk.top_k(df.where("vec_id = 1"), df.where("false")).count() == 0


def test_repeated_query_rows_are_one_query(spark):
    rows = [(i, [float(i % 7), float(i % 11)]) for i in range(60)]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = once.where("vec_id % 50 = 0")
    other = spark.createDataFrame([(50, [-1.0, -9.0])], once.schema)
    want = sorted(map(tuple, topk.top_k(queries, once).collect()))
    assert len(want) == 10
    for repeated in (queries.union(queries), queries.union(other)):
        assert sorted(map(tuple, topk.top_k(repeated, once).collect())) == want
    twice = topk.top_k(queries, once.union(queries))  # the query's own rows are no candidates, another query's row is one twice
    assert [r["rank"] for r in twice.where("query_id = 50").orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_secret_scan(spark, none):
    rng = random.Random(9)
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows, planted = [], {}
    for i in range(200):
        text = prose(rng, 60) + " " + "".join(rng.choices(SYLLABLES, k=7)) + " "
        if i % 5 == 0:
            planted[i] = rng.choice([f"AKIA{hexa(16).upper()}", hexa(40), hexa(18)])
            lead = {20: "", 40: 'token = "', 18: "password="}[len(planted[i])]
            text += lead + planted[i] + ('"' if lead.endswith('"') else "") + " " + prose(rng, 5)
        rows.append((i, text))
    rows += [(500, None), (501, ""), (502, rows[0][1]), (502, rows[0][1]), (None, rows[5][1]), (503, "word " * 50_000 + "password=" + planted[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit(1)).withColumn("label", F.lit("x"))
    held_out = [i for i in planted if i % 10 == 5]
    found = {(r.doc_id, r.candidate) for r in secrets.scan(df).where("secret").collect()}
    assert all((i, planted[i]) in found for i in held_out) and {i for i, _ in found} <= {*planted, 502, 503, None}
    starts = {(r.doc_id, r.start, r.candidate) for r in secrets.scan(df).collect()}
    text = dict(rows)
    assert all(text[i][s : s + len(c)] == c for i, s, c in starts if i is not None)
    clean = {(r.doc_id, r.text) for r in secrets.redact(df).collect()}
    assert len(clean) == len(set(rows)) and all(planted[5] not in (t or "") for _, t in clean)
    assert all((i, t) in clean for i, t in rows if i not in (*planted, 502, 503, None))
    assert secrets.scan(none).count() == 0 and secrets.redact(none).columns == none.columns


def test_assigned_values_are_candidates(spark):
    texts = [
        ("password=hunter2hunter2", "hunter2hunter2"), ('password = "Tr0ub4dor&3" x', "Tr0ub4dor&3"), ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"),
        ('STRIPE_SECRET_KEY = "rk_test_0123456789abcdef"', "rk_test_0123456789abcdef"), ('"db_password": "p4ss,w0rd!"', "p4ss,w0rd!"), ("x AbCdEfGh0123456789ab== y", "AbCdEfGh0123456789ab=="),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = secrets.known_formats(secrets.features(secrets.candidates(df), ["the"])).collect()
    assert sorted((r.doc_id, r.candidate, r.start) for r in got) == [(i, c, t.index(c)) for i, (t, c) in enumerate(texts)]
    assert all(r.assigned == r.keyword == r.label == 1 for r in got if r.doc_id < 5)


def test_secrets_are_masked_in_their_place_only(spark):
    rng = random.Random(4)
    teach = [(100 + i, f"password={''.join(rng.choices('abcdef0123456789', k=12))} and abcdefghijklmnopqrstuvwxyz then {'qw' * 10}") for i in range(60)]
    rows = [(1, "é token=2024x7 and the year 2024x7, 2024x7-05-01, id 12024x75"), (1, "the year 2024x7 under the same id"), (None, "of 2024x7"), (None, "token=2024x7 twice token=2024x7 end")]
    df = spark.createDataFrame([(*r, "a", "b", len(r[1])) for r in rows + teach], "doc_id long, text string, _secrets string, start string, n_chars long")
    got = secrets.redact(df.withColumn("x.y", F.lit(1)))
    assert got.columns == [*df.columns, "x.y"]
    clean = [(r.doc_id, r.text, r.n_chars) for r in got.collect() if r.doc_id in (1, None)]
    expected = [(1, "é token=[SECRET] and the year 2024x7, 2024x7-05-01, id 12024x75"), rows[1], rows[2], (None, "token=[SECRET] twice token=[SECRET] end")]
    assert sorted(clean, key=str) == sorted(((i, t, len(t)) for i, t in expected), key=str)


def test_marks_in_the_text_and_many_candidates(spark):
    texts = ["\x01 a\x02 password=abc123 \x01\x02", " ".join(["k" * 20, "password='q w'", "pwd: x", "x" * 15, "a/b-c_d+" * 3 + "==", "secret_key: 'v4lue'"] * 500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secrets.candidates(df).collect()
    assert [(r.doc_id, r.candidate) for r in got if r.doc_id == 0] == [(0, "abc123")]
    assert collections.Counter(r.candidate for r in got if r.doc_id) == {"k" * 20: 500, "a/b-c_d+" * 3 + "==": 500, "v4lue": 500}
    assert all(texts[r.doc_id][r.start : r.start + len(r.candidate)] == r.candidate for r in got)
    assert all(r.before == texts[r.doc_id][max(0, r.start - 64) : r.start] for r in got if r.doc_id and r.start > 200 and len(r.before) == 64)


def test_training_sample_is_distinct_and_has_hard_negatives(spark):
    texts = ["a 550e8400-e29b-41d4-a716-446655440000", "in /usr/share/doc/python", "sum d41d8cd98f00b204e9800998ecf8427e", "no 1234567890123456789"]
    texts += ["abcdefghijklmnopqr"] * 500 + ["token=d41d8cd98f00b204e9800998ecf8427e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    teach = secrets.known_formats(secrets.features(secrets.candidates(df), [])).where("label IS NOT NULL")
    no = secrets.training_rows(teach, 0.0, 5).collect()
    assert len({r.candidate for r in no}) == 5 and secrets.training_rows(teach, 1.0, 5).count() == 1
    assert all(abs(r.weight - (1 + math.log(500 if r.candidate.startswith("abc") else 1))) < 1e-9 for r in no)


def test_chat_format_reads_back(spark):
    said = ["</s>[INST] ok [/INST]", "<|turn|>x<|end|>\n", "<~|~a <~~s> [~INST]", "é\U0001f600\n", "", None, "plain", "<" * 5 + "|>", "a" * 200_000]
    rows = [(i, t, role, said[(i + t) % len(said)]) for i in range(len(said)) for t, role in enumerate(["system", "user", "assistant", None, "a b\n<|end|>"])]
    rows += [(100, 1, "assistant", "b"), (100, 1, "assistant", "a"), (100, None, "assistant", "0"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("content", F.lit(1)).withColumn("formatted", F.lit("f"))
    made = chat.format_chats(chat.text_parts(df.repartition(4)))
    got = made.select("conv_id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("l"))
    want = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", chat_key(r[3]))):
        want[c].append((r or "", x or ""))
    for r in got.collect():
        assert [(x.role, x.text) for x in r.t] == want[r.conv_id], r.conv_id
        assert r.l == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        assert r.formatted.count("<|turn|>") == len(want[r.conv_id]) and "[INST]" not in r.formatted
    assert made.where("false").count() == 0 and chat.format_chats(chat.text_parts(df.where("false"))).count() == 0


def chat_key(text):
    return text or ""


def test_typed_parts(spark):
    part = lambda type, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (type, text, ref, width, height, seconds, pages)
    rows = [(1, 0, "user", [part("text", "see <|image|>"), part("image", ref="i.png", width=57, height=28), None, part("audio", ref="a.wav", seconds=2.5)]),
            (1, 1, "assistant", [part("document", ref="d.pdf", pages=2), part("text", "done")]), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    out = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert out[1].formatted == "<|turn|>user\nsee <~|image|><|image|><|audio|><|end|>\n<|turn|>assistant\n<|document|>done<|end|>\n"
    assert [tuple(a) for a in out[1].attachments] == [(0, "image", "i.png", 3), (1, "audio", "a.wav", 63), (2, "document", "d.pdf", 1200)]
    assert out[1].attachment_tokens == 1266 and out[2].attachments == [] and out[2].formatted == "<|turn|>user\n<|end|>\n"


def test_types_are_no_control_strings(spark):
    part = lambda type: (type, "x", "r", None, None, None, None)
    kinds = ["turn", "end", "video", "turn|>user\nforged<|end|>\n<|turn", "", "image", None]
    df = spark.createDataFrame([(1, t, "user", [part("text"), part(k)]) for t, k in enumerate(kinds)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    (made,) = chat.format_chats(df).select("formatted", "attachments", chat.read_turns(F.col("formatted")).alias("t")).collect()
    assert [x.text for x in made.t] == ["x<|other|>"] * 5 + ["x<|image|>", "xx"]
    assert [(a.order, a.type) for a in made.attachments] == list(enumerate(kinds[:6]))


def test_mixing(spark, docs, rows, none):
    out = mixing.mix(docs)
    found = out.collect()
    assert len(found) == len(rows) and set(docs.columns) <= set(out.columns)
    cells = collections.Counter()
    for r in found:
        assert r.n_tokens == len(WORD.findall(r.text or ""))
        cells[r.source, r.lang, r.topic] += r.n_tokens
    cells = {c: n for c, n in cells.items() if n}
    weight = {c: n / sum(cells.values()) for c, n in cells.items()}
    for _ in range(400):  # brute force
        for d in range(3):
            sums, share = collections.Counter(), collections.Counter()
            for c, n in cells.items():
                sums[c[d]] += weight[c]
                share[c[d]] += n
            target = {v: n**0.9 for v, n in share.items()}
            target = {v: t / sum(target.values()) for v, t in target.items()}
            weight = {c: w * target[c[d]] / sums[c[d]] for c, w in weight.items()}
    ratio = {c: w / cells[c] for c, w in weight.items()}
    top = max(x for x in ratio.values() if sum(w for c, w in weight.items() if ratio[c] >= x) > 0.05)
    for r in found:
        want = min(1.0, ratio[r.source, r.lang, r.topic] / top) if r.n_tokens else 1.0
        assert abs(r.probability - want) < 5e-3 or not r.n_tokens
        assert not r.n_tokens or abs(r.shortfall - max(0.0, 1 - top / ratio[r.source, r.lang, r.topic])) < 5e-3
    assert mixing.mix(none).count() == 0
    again = {(r.doc_id, r.text): r.kept for r in mixing.mix(docs.repartition(7)).collect()}
    assert all(again[r.doc_id, r.text] == r.kept for r in found)


def test_mixing_to_given_targets(spark):
    rows = [(s, l, "t", n) for s, l, n in (("a", "x", 900), ("a", "y", 50), ("b", "x", 30), ("b", "y", 20))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n long")
    goals = spark.createDataFrame([("source", "a", 0.5), ("lang", "x", 0.3)], "dimension string, value string, share double")
    out = mixing.fit(cells, targets=goals).collect()
    assert abs(sum(r.weight for r in out if r.source == "a") - 0.5) < 1e-3 and abs(sum(r.weight for r in out if r.lang == "x") - 0.3) < 1e-3


def test_one_rare_document_does_not_change_what_is_kept(spark):
    rng = random.Random(4)
    rows = [(i, "a b " * rng.randint(20, 400), rng.choice(["en", "fr", "de"]), rng.choice(["web", "web", "web", "code", "books"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    rare = spark.createDataFrame([(9999, "five words of its own", "xx", "rare")], df.schema)
    share = lambda d: d.agg(F.avg("probability")).first()[0]
    before, after = share(mixing.mix(df)), mixing.mix(df.unionByName(rare))
    assert abs(share(after) - before) < 0.01 * before
    assert after.where("doc_id = 9999").select("kept").first()[0] and before > 0.8


def test_contradicting_targets_are_an_error_and_tempered_ones_are_not(spark):
    rows = [("a", "x", "t", 900), ("b", "y", "t", 50), ("c", "y", "t", 30)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n long")
    goals = spark.createDataFrame([("source", "a", 0.5), ("lang", "x", 0.3)], "dimension string, value string, share double")
    with pytest.raises(ValueError, match="can't be met"):
        mixing.fit(cells, targets=goals, most=2)
    out = mixing.fit(cells, most=2).collect()  # tempered shares contradict each other here
    assert abs(sum(r.weight for r in out) - 1) < 1e-9 and out[0].fit_error > 1e-4


def test_encoder_equals_the_tokenizer():
    import pyarrow as pa

    from pricelake.llm.arrays import rounds

    texts = ["A<|endoftext|>B <|ENDOFTEXT|> x", "don't I'LL, a.b,c... É, ×, ÷.", "é, Ω.ς ΣΑΣ, x\u00a0y z\u2003… . ,a", "", "   ", "12,5 |a| b|c 3.4\u0301", None]
    texts += [r[1] for r in corpus(40)]
    coder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for lo, hi, data, offsets in rounds(pa.array(texts)):
        ids, bounds = coder.encode(data, offsets)
        for i in range(lo, hi):
            want = coder.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids
            assert ids[bounds[i - lo] : bounds[i - lo + 1]].tolist() == want, texts[i]


def test_packing(spark, docs, rows, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = tokens.Encoder(path).tokenizer
    out = packing.pack(docs, path, end_id=2, window=4096).toPandas()
    want = collections.Counter()
    for r in rows:
        want[r[0], np.array([*coder.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()] += 1
    pieces = collections.defaultdict(list)
    for p in out.itertuples():
        assert len(p.ids) == 4 * p.length and p.length > 0
        pieces[None if p.doc_id != p.doc_id else int(p.doc_id), p.doc_tokens].append(p)
    for (doc_id, ids), times in want.items():
        mine = pieces[doc_id, len(ids) // 4]
        for p in mine:
            assert ids[4 * p.start : 4 * (p.start + p.length)] == p.ids
        assert sum(p.length for p in mine) == times * len(ids) // 4
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.concatenate(([0], s["length"].cumsum()[:-1]))).all()
        total = int(s["length"].sum())
        assert total <= 4096 and total & (total - 1) == 0
    assert packing.pack(none, path).count() == 0


def test_bm25_neighbours_share_a_window():
    rng = np.random.default_rng(4)
    sets = [rng.integers(1000 * k, 1000 * k + 60, 50) for k in range(4) for _ in range(2)]  # neighbours are 2k and 2k + 1
    order = [0, 2, 4, 6, 1, 3, 5, 7]
    made = packing.fill([sets[i].astype(np.uint16) for i in order], np.ones(5000), 50.0, 100)
    assert sorted(sorted(order[i] for i, _, _ in s) for s in made if sum(n for _, _, n in s) == 100)[:3] == [[0, 1], [2, 3], [4, 5]]


def test_neighbours_among_thousands_of_documents_share_a_window(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    coder, rng = tokens.Encoder(path).tokenizer, random.Random(3)
    words = sorted(w[:-4] for w in coder.get_vocab() if re.fullmatch("[a-z]{4,}</w>", w))
    rng.shuffle(words)
    common, rare = words[:1500], words[1500:]
    rows = [[i, rng.choices(common, k=60)] for i in range(6000)]
    for k in range(200):  # documents k and 3000 + k share rare words
        topic = rare[8 * k : 8 * k + 8]
        for i in (k, 3000 + k):
            rows[i][1] = rng.sample(rows[i][1] + topic, 68)
    df = spark.createDataFrame([(i, " ".join(w), "en") for i, w in rows], "doc_id long, text string, lang string").repartition(5)
    windows = collections.defaultdict(set)
    for p in packing.pack(df, path, end_id=2, window=2 * 69).select("doc_id", "sequence_id").collect():
        windows[p.doc_id].add(p.sequence_id)
    assert len(windows) == 6000 and sum(bool(windows[k] & windows[3000 + k]) for k in range(200)) >= 190


def test_url_rules_and_hosts(spark):
    cases = {
        "http://A.net/x": ("a.net", "/x", "net/", "block"), "https://b.example.net/en/1?q": ("b.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"), "http://example.com/dead": ("example.com", "/dead", None, "allow"),
        "http://x.org/fr/a#b": ("x.org", "/fr/a", "org/fr/", "allow"), "http://knet/x": ("knet", "/x", None, "allow"), "http://net": ("net", "", None, "allow"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"), "x://É.NET/q": ("É.net", "/q", "net/", "block"),
        "": ("", "", None, "allow"), "http://h.org/" + "a/" * 5000: ("h.org", "/" + "a/" * 5000, None, "allow"),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)] + [(0, "http://A.net/x"), (None, "http://A.net/x")], "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    got = urls.judge(pages.withColumn("host", F.lit("h")).withColumn("shape", F.lit(1)), labels, rules).collect()
    assert len(got) == len(cases) + 2
    for r in got:
        want = list(cases.values())[r.page_id or 0]
        assert (r.host, r.path, r.rule, r.verdict) == want
    assert urls.judge(pages.where("false"), labels, rules).count() == 0


def test_bad_templates_are_rejected(spark):
    rows, bad = [], []
    for i in range(300):
        kind = ("news", "spam", "blog")[i % 3]
        rows.append((i, f"http://h.org/{kind}/{i}/t{chr(97 + i % 26)}{i}"))
        bad.append((i, kind == "spam" if i % 2 else None))
    pages, labels = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad boolean")
    out = urls.judge(pages, labels, []).collect()
    assert {(r.path.split("/")[1], r.verdict) for r in out} == {("news", "allow"), ("blog", "allow"), ("spam", "block")}
    assert {r.template for r in out if "spam" in r.path} == {"/spam/{n}/*"}


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_near_duplicates(spark, rows, none, width, percent):
    rng = random.Random(width)
    some = [(r[0], r[1]) for r in rows if r[0] is not None]
    base = prose(rng, 60).split(" ")
    for i in range(60):  # a group of near copies, near the border of the threshold
        w = base[:]
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(9)}"
        some.append((3000 + i, " ".join(w)))
    for i in range(60):  # short texts
        some.append((4000 + i, " ".join(rng.choices("a b c".split(), k=rng.randint(1, 9)))))
    df = spark.createDataFrame([*some, (None, some[0][1])], "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("h1", F.lit("x"))
    got = jaccard.near_duplicates(df.repartition(5), width, percent).collect()
    assert len(got) == len(some) + 1
    want = brute_components(some, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = jaccard.keep_one(df, width, percent).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for _, c in want.values()})
    assert jaccard.near_duplicates(none, width, percent).count() == 0


def test_large_keys_are_joined_and_cut_into_blocks(spark, monkeypatch):
    """The same links come out when nearly every key is large and every group has many blocks."""
    monkeypatch.setattr(jaccard, "LARGE", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "PARTS", 2)
    rng = random.Random(11)
    base = prose(rng, 40).split(" ")
    rows = []
    for i in range(90):
        w = base[:]
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, 4, 85).collect()}
    assert got == brute_components(rows, 4, 85) and len({c for _, c in got.values()}) > 3


def test_stars_across_batches():
    """Keys that run over batch ends give the same pairs and rows as in one batch."""
    import pyarrow as pa

    rng = random.Random(2)
    rows = sorted((rng.randrange(12), rng.randrange(6)) for _ in range(60))
    want_pairs, want_rows = set(), set()
    for key in {k for k, _ in rows}:
        c = sorted({x for k, x in rows if k == key})
        want_pairs |= {(c[0], x) for x in c[1:]}
        want_rows |= {(x, key) for x in c if len(c) >= 3}
    for size in (1, 2, 3, 7, 60):
        batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i : i + size]]), pa.array([x for _, x in rows[i : i + size]])], ["key", "h1"]) for i in range(0, 60, size)]
        out = [r for b in jaccard._stars(iter(batches)) for r in b.to_pylist()]
        assert {(r["a"], r["b"]) for r in out if r["key"] is None} == want_pairs
        assert {(r["a"], r["key"]) for r in out if r["key"] is not None} == want_rows


def test_pipeline(spark, docs, rows, none):
    import corpus_pipeline

    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, "").cache()
        assert now.columns == docs.columns
        ids = collections.Counter(r[0] for r in now.select("doc_id").collect())
        assert not ids - collections.Counter(r[0] for r in before.select("doc_id").collect()), name
        if name == "quality_rules":
            assert 1005 not in ids and 1000 not in ids and 0 in ids
            assert {r.n_words for r in now.collect()} == {7} and {r.kept for r in now.collect()} == {"no"}
        if name == "near_duplicates":
            assert max(v for k, v in ids.items() if k is not None) == 1 and not {i + 1 for i in range(0, 30, 3)} & set(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, "").toPandas()
    assert pieces.groupby(["doc_id"]).length.sum().gt(0).all()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0


def test_hashes_are_stable():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442") and pseudonyms.permute(5, 1000, b"k", "t") == pseudonyms.permute(5, 1000, b"k", "t")
