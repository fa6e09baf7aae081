"""Secret scan: candidates from whole texts, false positives removed by a random forest.

A candidate is a run of 16 or more letters, digits and ``+ / _ -`` that is no name before ``=`` or ``:``, or any value of four characters or more that is
assigned to a secret's name. Its features: length, changes between classes of characters, shares
of digits, capitals and hexadecimal digits, how much of it common words of the corpus cover, path characters, and the
words before it. The forest is trained on labelled findings; ``known_formats`` labels those whose format or place says what they
are, and a bounded number of distinct ones per label (``train_rows``, a parameter) is used, chosen by hash and weighted by 1 + ln(copies),
so that no hot string stands for the others. Every candidate is then judged by the forest.

The dictionary is counted over all texts: the ``DICTIONARY`` most frequent words of 2 to 6 letters (a fixed number of rows).

Defined cases: a null or empty text has no candidates; repeated rows have the same findings each; a null id stays null; without
findings of both labels nothing is called a secret; very long texts are read whole; other columns stay as they are, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from pricelake.llm.store import set_aside, stored

WORD = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|credential|(?:api|access|auth|private|secret)[_\-]?key)"
#: A secret's name and what stands between it and the value.
ASSIGNED = WORD + r"[A-Za-z0-9_\-]{0,32}[\"']?\s{0,4}[=:]\s{0,4}"
_RUN = r"[A-Za-z0-9+/_\-]"
_NAME = rf"(?:[A-Za-z+/_\-]++|{_RUN}*?" + WORD + rf"{_RUN}*+)[\"']?\s{{0,4}}[=:]\s{{0,4}}[\"']?[^\s\"'=,;)\]}}]"
#: Read forwards from the beginning of a run: a secret's name with its value (the run must end before ``=`` or ``:``, which is looked at
#: first), or a long run that is no name. Groups: 1 to 6 name and value by its quotes, 7 the run.
PATTERN = (
    rf"(?<!{_RUN})(?:(?={_RUN}++[\"']?\s{{0,4}}[=:])({_RUN}*?{ASSIGNED})"
    r"(?:(\")([^\"\s]{4,}+)(?=\")|(')([^'\s]{4,}+)(?=')|(?![\"'=:])([^\s\"',;<>]{4,}+))"
    rf"|(?={_RUN}{{16}})(?!{_NAME})({_RUN}{{16,}}+={{0,2}}))"
)
OPEN, CLOSE = "\x01", "\x02"
BEFORE = 64
DICTIONARY = 400
FEATURES = ["size", "changes", "digits", "capitals", "hex", "covered", "slashes", "dashes", "assigned", "quoted", "keyword"]


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, start, candidate, before): every candidate with its place in code points from 0 and the text before it; and the columns ``keep``.

    One pass sets marks around the candidates (marks in the text itself count as blanks), at which it is cut.
    """
    plain = F.translate("text", OPEN + CLOSE, "  ")
    marked = F.regexp_replace(plain, F.lit(PATTERN), F.lit(f"$1$2$4{OPEN}$3$5$6$7{CLOSE}"))
    rows = docs.select("doc_id", *keep, marked.alias("_marked")).where(F.contains("_marked", F.lit(OPEN)))
    rows = rows.select("doc_id", *keep, F.split("_marked", f"[{OPEN}{CLOSE}]", -1).alias("parts"))
    # candidates are the parts 1, 3, 5 ...; a part begins where those before it end
    starts = F.aggregate("parts", F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + F.length(x))))
    rows = rows.withColumn("starts", starts)
    part = lambda i: F.coalesce(F.get("parts", i), F.lit(""))
    found = F.transform(F.sequence(F.lit(1), F.size("parts") - 2, F.lit(2)), lambda i: F.struct(
        F.get("starts", i).cast("long").alias("start"), F.get("parts", i).alias("candidate"),
        F.right(F.concat(part(i - 3), part(i - 2), part(i - 1)), F.lit(BEFORE)).alias("before"),
    ))
    return rows.select("doc_id", *keep, F.explode(found).alias("f")).select("doc_id", *keep, "f.*")


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 2 to 6 letters of all texts; ties by spelling."""
    word = F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("word")
    counts = docs.select(word).where(F.length("word").between(2, 6)).groupBy("word").count()
    return [r[0] for r in counts.orderBy(F.desc("count"), "word").limit(size).collect()]


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.length(text)


def features(found: DataFrame, words: list[str]) -> DataFrame:
    c, b = F.col("candidate"), F.col("before")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "c"), "[^abc]+", "d")
    longest = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    open_part = F.regexp_replace(F.lower(c), longest, "") if words else c
    flag = lambda p: F.rlike(b, F.lit(p)).cast("double")
    return found.withColumns({
        "size": F.least(F.length(c), F.lit(256)).cast("double"),
        "changes": (F.length(classes) - 1) / F.length(c),
        "digits": _share(c, "[^0-9]"),
        "capitals": _share(c, "[^A-Z]"),
        "hex": _share(c, "[^0-9a-fA-F]"),
        "covered": 1 - F.length(open_part) / F.length(c),
        "slashes": _share(c, "[^/]"),
        "dashes": _share(c, "[^_\\-]"),
        "assigned": flag(r"[=:]\s*[\"']?$"),
        "quoted": flag(r"[\"']$"),
        "keyword": flag(r"(?i)(pass\w*|secret|token|key|auth\w*|credential\w*)\W{0,4}$"),
    })


def known_formats(found: DataFrame) -> DataFrame:
    """Labels: 1 for findings of a provider's format or in an assignment to a secret's name, 0 for plain words and, away from secrets' names, for numbers,
    UUIDs, checksums and paths of words, null for others."""
    c, b = F.col("candidate"), F.col("before")
    provider = F.rlike(c, F.lit(r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^xox[abprs]-|^sk_live_"))
    assigned = F.rlike(b, F.lit(ASSIGNED + r"[\"']?$")) & F.rlike(c, F.lit("[0-9]"))
    plain = F.rlike(c, F.lit(r"^[A-Za-z]?[a-z]+$|^[A-Z]+$|^[_\-+/]+$"))
    named = F.rlike(b, F.lit(r"(?:^|[^A-Za-z])" + WORD + r"[A-Za-z0-9_\-]{0,32}\W{0,4}$")) | F.rlike(b, F.lit(ASSIGNED + r"[\"']?$"))
    uuid = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    checksum = r"^(?:[0-9a-f]+|[0-9A-F]+)$"
    hard = F.rlike(c, F.lit(r"^[0-9_\-+/]+$|^/?[A-Za-z]+(?:[/_\-](?:[A-Za-z]+|[0-9]{1,8}))+/?$|" + uuid))
    hard = hard | (F.rlike(c, F.lit(checksum)) & F.length(c).isin(32, 40, 56, 64, 96, 128))
    return found.withColumn("label", F.when(provider | assigned, 1.0).when(plain | (hard & ~named), 0.0))


def training_rows(teach: DataFrame, label: float, most: int) -> DataFrame:
    """At most ``most`` distinct findings of a label, by hash, with ``weight``."""
    one = teach.where(F.col("label") == label).groupBy("label", "candidate", *FEATURES).agg((1 + F.log(F.count("*").cast("double"))).alias("weight"))
    return one.orderBy(F.xxhash64("candidate"), "candidate", *FEATURES).limit(most)


def scan(docs: DataFrame, labelled: DataFrame | None = None, train_rows: int = 20_000, trees: int = 20, depth: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, start, candidate, probability, secret) of every candidate of (doc_id, text), and the columns ``keep``.

    ``labelled``: own findings (candidate, before, label) to learn from; else those that ``known_formats`` labels.
    """
    words = dictionary(docs)
    found = stored(features(candidates(docs, *keep), words), "findings")
    teach = known_formats(found) if labelled is None else features(labelled, words)
    teach = teach.where("label IS NOT NULL").select("label", "candidate", *FEATURES)
    sizes = {r[0]: r[1] for r in teach.groupBy("label").count().collect()}  # two rows
    if len(sizes) < 2:
        return found.select("doc_id", *keep, "start", "candidate", F.lit(0.0).alias("probability"), F.lit(False).alias("secret"))
    some = None
    for label in sorted(sizes):
        part = training_rows(teach, label, train_rows)
        some = part if some is None else some.union(part)
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", weightCol="weight", numTrees=trees, maxDepth=depth, seed=7, subsamplingRate=0.8)
    pack = VectorAssembler(inputCols=FEATURES, outputCol="x")
    model = forest.fit(stored(pack.transform(stored(some, "labelled")).select("label", "weight", "x"), "vectors"))
    judged = model.transform(pack.transform(found))
    chance = F.element_at(vector_to_array("probability"), 2)
    return judged.select("doc_id", *keep, "start", "candidate", chance.alias("probability"), (F.col("prediction") == 1).alias("secret"))


def redact(docs: DataFrame, mark: str = "[SECRET]", **settings) -> DataFrame:
    """``docs`` with ``mark`` in every place where a secret stands; ``n_chars``, if it is there, counts again. No row is dropped.

    What is secret depends on the text alone, so places are gathered per different text (128 bits of hash), not per id: copies cost one row, and
    rows without an id or with the same one don't meet.
    """
    docs, put_back = set_aside(docs)
    keyed = docs.withColumns({"_k1": F.xxhash64("text"), "_k2": F.xxhash64(F.lit(7), "text")})
    found = scan(keyed.select("doc_id", "text", "_k1", "_k2"), keep=("_k1", "_k2"), **settings).where("secret")
    places = found.groupBy("_k1", "_k2", "start", "candidate").agg(F.lit(1).alias("_one"))
    per_text = places.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct("start", F.length("candidate").alias("size")))).alias("_secrets"))
    per_text = stored(per_text, "secrets")
    state = lambda at, out: F.struct(at.cast("long").alias("at"), out.alias("out"))
    piece = lambda at, n: F.substr(F.col("text"), (at + 1).cast("int"), n.cast("int"))
    text = F.aggregate(
        "_secrets", state(F.lit(0), F.lit("")),
        lambda s, x: state(x["start"] + x["size"], F.concat(s["out"], piece(s["at"], x["start"] - s["at"]), F.lit(mark))),
        lambda s: F.concat(s["out"], piece(s["at"], F.length("text"))),
    )
    has = F.col("_secrets").isNotNull()
    out = keyed.join(per_text, ["_k1", "_k2"], "left").withColumn("text", F.when(has, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(has, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return put_back(out)
