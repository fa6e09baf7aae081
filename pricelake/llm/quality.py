"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

Every document is measured once (``measure``). Each measure of each (language, source) goes into a quantile sketch: counts
over buckets of a fixed grid with a relative width of 1/16. Two sketches merge by adding their counts, so partial
sketches are summed before and after the shuffle and the result does not depend on the order or the number of tasks.
A threshold is the far fence of the group: a quartile plus or minus ``reach`` times the spread of the quartiles, and
never tighter than ``least`` away from it, so a group of equal documents rejects nothing. The thresholds are then joined to the
measures. A group with fewer than ``least_docs`` documents takes the thresholds of its language, or of all documents.

Defined cases: a null text has no words and is rejected (too few words); null languages and sources are groups of their own; repeated
rows count as often as they occur and get equal verdicts; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricelake.llm.arrays import mix, owners, ranges_hash, rounds, table, words

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
WINDOW = 3

#: Measure -> its value in thousandths, which side is bad, and the least distance of the fence from the quartile.
MEASURES = {
    "word_length": ("word_chars * 1000 DIV greatest(n_words, 1)", "both", 2000),
    "symbols": ("n_symbols * 1000 DIV greatest(n_words, 1)", "high", 100),
    "capitals": ("n_capitals * 1000 DIV greatest(word_chars, 1)", "high", 200),
    "repeats": ("n_repeat_words * 1000 DIV greatest(n_words, 1)", "high", 200),
}


def _measured(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    w, n = words(data, offsets), len(offsets) - 1
    inside = np.zeros(len(data) + 1, np.int64)
    started = (data & 0xC0) != 0x80
    blank = np.isin(data, np.frombuffer(b"\t\n\v\f\r ", np.uint8))
    np.cumsum(started & ~blank, out=inside[1:])
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    capitals = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))

    # lines with a word, equal to an earlier line of the same text
    breaks = np.zeros(len(data) + 1, bool)
    breaks[1:][data == 10] = True
    breaks[offsets] = True
    line_from = np.flatnonzero(breaks[:-1]) if len(data) else np.zeros(0, np.int64)
    line_to = np.append(line_from[1:], len(data))
    line_to = line_to - (data[line_to - 1] == 10) if len(line_from) else line_to[:0]
    line_from = line_from[: len(line_to)]
    has_word = inside[line_to] > inside[line_from]
    line_from, line_to = line_from[has_word], line_to[has_word]
    line_doc = np.searchsorted(offsets, line_from, side="right") - 1
    line_hash = ranges_hash(data, line_from, line_to)
    order = np.lexsort((line_hash, line_doc))
    a, b = order[1:], order[:-1]
    same = (line_hash[a] == line_hash[b]) & (line_doc[a] == line_doc[b])
    dup_lines = np.bincount(line_doc[a[same]], minlength=n)

    # words in windows of three words that occur twice or more
    doc = owners(w.bounds)
    covered = np.zeros(len(doc) + WINDOW, bool)
    if len(doc) >= WINDOW:
        at = np.flatnonzero(doc[WINDOW - 1 :] == doc[: len(doc) - WINDOW + 1])
        key = np.zeros(len(at), np.uint64)
        for j in range(WINDOW):
            key = mix(key + w.hash[at + j])
        order = np.lexsort((key, doc[at]))
        a, b = order[1:], order[:-1]
        same = (key[a] == key[b]) & (doc[at[a]] == doc[at[b]])
        twice = at[np.unique(np.concatenate((a[same], b[same])))]
        for j in range(WINDOW):
            covered[twice + j] = True
    repeats = np.bincount(doc[covered[: len(doc)]], minlength=n)
    ends = lambda sums: np.diff(sums[offsets])
    return dict(zip(COUNTS, (np.diff(w.bounds), ends(inside), ends(symbols), dup_lines, repeats, ends(capitals)), strict=True))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of each whole text. Columns of those names are replaced."""
    docs = docs.drop(*COUNTS)
    fields = "".join(f", {c} long" for c in COUNTS)
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in rounds(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                counts = [pa.array(v.astype(np.int64)) for v in _measured(data, offsets).values()]
                yield pa.RecordBatch.from_arrays([*part.columns, *counts], [*part.schema.names, *COUNTS])

    return docs.mapInArrow(run, plain + fields)


def _bucket(value: Column) -> Column:
    """Bucket of a whole number of 0 or more: its bit length and the four bits after the first."""
    bits = F.length(F.bin(value))
    return F.when(value < 32, value).otherwise(bits * 16 + F.floor(value / F.pow(F.lit(2.0), bits - 5)).cast("long") - 16)


def _bucket_value(bucket: Column) -> Column:
    """The smallest number of a bucket."""
    bits = F.floor(bucket / 16)
    return F.when(bucket < 32, bucket).otherwise(((bucket % 16) + 16) * F.pow(F.lit(2.0), bits - 5)).cast("long")


def sketch(measured: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, count): the mergeable quantile sketches."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.expr(e).alias("value")) for m, (e, _, _) in MEASURES.items())))
    return (
        measured.select(*keys, values.alias("v")).select(*keys, "v.measure", _bucket(F.col("v.value")).alias("bucket"))
        .groupBy(*keys, "measure", "bucket").agg(F.count("*").alias("count"))
    )


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("count").alias("count"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and measure: number of documents and the quartiles, each the smallest number of its bucket.

    A sketch has at most 16 buckets per power of two, so the sorted array of a group holds under 1,100 entries.
    """
    by = sketches.groupBy(*keys, "measure").agg(F.array_sort(F.collect_list(F.struct("bucket", "count"))).alias("b"), F.sum("count").alias("n"))
    running = F.expr("transform(sequence(1, size(b)), i -> aggregate(slice(b, 1, i), 0L, (s, x) -> s + x.count))")
    by = by.withColumn("r", running)
    at = lambda q: _bucket_value(F.expr(f"element_at(b, int(array_position(transform(r, x -> x >= ceil(n * {q})), true))).bucket"))
    return by.select(*keys, "measure", "n", at(0.25).alias("q1"), at(0.75).alias("q3"))


def thresholds(measured: DataFrame, reach: int = 6, least_docs: int = 50) -> DataFrame:
    """(lang, source, low_m, high_m for every measure m): one row per language and source."""
    keys = ["lang", "source"]
    fine = sketch(measured, keys)
    fences = []
    for level in (keys, ["lang"], []):
        q = quartiles(merge(fine, level), level)
        aggs = []
        for m, (_, side, least) in MEASURES.items():
            spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(0)) * reach
            gap = F.greatest(spread, F.lit(least))
            mine = F.col("measure") == m
            aggs += [
                F.max(F.when(mine, (F.col("q1") - gap) if side == "both" else F.lit(-1))).cast("long").alias(f"low_{m}"),
                F.max(F.when(mine, F.col("q3") + gap)).cast("long").alias(f"high_{m}"),
                F.max(F.when(mine, F.col("n"))).alias("n"),
            ]
        names = [f"{s}_{m}" for m in MEASURES for s in ("low", "high")]
        one = (q.groupBy(*level) if level else q.groupBy(F.lit(1).alias("every"))).agg(*aggs[:3], *[a for i, a in enumerate(aggs[3:]) if i % 3 < 2])
        fences.append(one.select(*level, "n", F.struct(*names).alias("fence")))
    groups, langs, every = fences
    langs = langs.select(F.col("lang").alias("l"), F.col("n").alias("ln"), F.col("fence").alias("lf"))
    whole = every.first()  # one row, or none
    names = [f"{s}_{m}" for m in MEASURES for s in ("low", "high")]
    rest = F.struct(*(F.lit(whole["fence"][c] if whole else None).cast("long").alias(c) for c in names))
    joined = groups.join(langs, F.col("lang").eqNullSafe(F.col("l")), "left")
    pick = F.when(F.col("n") >= least_docs, F.col("fence")).when(F.col("ln") >= least_docs, F.col("lf")).otherwise(rest)
    return joined.select("lang", "source", pick.alias("fence")).select("lang", "source", "fence.*")


def judge(measured: DataFrame, reach: int = 6, least_docs: int = 50, limits: DataFrame | None = None) -> DataFrame:
    """Add base_failed, the thresholds of the document's group and kept. ``limits``: stored ``thresholds``, whose size is then known to the join."""
    measured = measured.drop(*(f"{s}_{m}" for m in MEASURES for s in ("low", "high")), "base_failed", "kept")
    limits = thresholds(measured, reach, least_docs) if limits is None else limits
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = reduce(
        lambda a, b: a & b,
        (F.expr(e).between(F.col(f"low_{m}"), F.col(f"high_{m}")) for m, (e, _, _) in MEASURES.items()),
    )
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.drop("_lang", "_source").withColumn("base_failed", base).withColumn("kept", ~base & F.coalesce(fine, F.lit(True)))
