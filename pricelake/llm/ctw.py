"""Context-tree weighting over bytes: code length of every text under one model of the corpus.

A text is scored as its sequence of tokens: the lower-cased (A-Z) words, a blank between two of them, and a stop byte that occurs
in no UTF-8 text. A byte is eight binary decisions; each
node of that decision tree has a context tree over the last ``DEPTH`` bytes. Every node of a context tree holds the
Krichevsky-Trofimov estimate of its bits, and the depths are mixed by the weights of the method: a node's own estimate
weighs one half against the product of its children, given all training bits. On the way down the path ends at the deepest
context that was seen in training, so the probabilities of a text's continuations sum to one.

How it runs. Grams of ``DEPTH + 1`` bytes and words are counted per task and summed in one shuffle. The tree below each pair of
context bytes is worked out as one group; the top two levels are sums of those (at most 255 * 256 rows, read by the driver).
Scoring looks up the ``COMMON`` most frequent grams and words (a fixed number of rows, broadcast) inside the scan;
all rarer ones are joined by key, so nothing that grows with the corpus is broadcast and no gram is dropped.

Defined cases: a null text is an empty one; texts with a null id are held out of nothing (crc32 of a null is null: not trained on); repeated
rows count twice; without training rows every byte costs 8 bits; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricelake.llm.arrays import BLANK, LOWER, rounds, signed, table, words
from pricelake.llm.store import stored

DEPTH = 5
STOP = 255
#: Grams and words that the scan looks up itself, each.
COMMON = 1 << 18
#: Distinct keys that a task holds before it hands its counts on.
HELD = 1 << 21
GRAM, WORD = 0, 1
_LOG2 = log(2.0)
_HALF_GAMMA = lgamma(0.5)
_log_gamma = np.vectorize(lgamma, otypes=[float])


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased words of each text with one blank between two words."""
    blank = BLANK[data]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    some = offsets[1:] > offsets[:-1]
    first = offsets[:-1][some]
    keep[first] = ~blank[first]
    # a run of blanks keeps its first one, unless no word follows
    word = np.concatenate(([0], np.cumsum(~blank)))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep &= ~blank | (word[offsets[1:]][doc] > word[1:])
    out = LOWER[data]
    out[blank] = 32
    kept = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], kept[offsets]


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram at every byte and at every stop, new offsets). The newest context byte is the most significant, the byte itself the least."""
    n = len(offsets) - 1
    to = offsets + np.arange(n + 1)
    text = np.full(to[-1] + DEPTH, STOP, np.uint64)
    at = np.ones(to[-1], bool)
    at[to[1:] - 1] = False
    text[DEPTH:][at] = data
    grams = text[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        byte = text[DEPTH - back : len(text) - back].copy()
        for j in range(back):  # no context from the text before
            first = to[:-1] + j
            byte[first[first < to[1:]]] = STOP
        grams |= byte << np.uint64(8 * (DEPTH - back + 1))
    return grams, to


def _word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = words(data, offsets)
    return w.hash, w.bounds


def _summed(keys: np.ndarray, *numbers: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return (keys[at], *(np.add.reduceat(x[order], at) if len(at) else x for x in numbers))


def counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n_train, n_all) of the grams and words of (held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {GRAM: [], WORD: []}

        def counted(keys: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, ...]:
            """Counts of the training keys and of the others, each sorted apart."""
            runs = []
            for some in (keys[mine], keys[~mine]):
                some = np.sort(some)
                at = np.flatnonzero(np.concatenate(([True], some[1:] != some[:-1]))) if len(some) else np.zeros(0, np.int64)
                runs.append((some[at], np.diff(np.append(at, len(some)))))
            (a, n), (b, m) = runs
            return np.concatenate((a, b)), np.concatenate((n, np.zeros(len(b), np.int64))), np.concatenate((n, m))

        def give(kind: int) -> pa.RecordBatch:
            key, train, every = (np.concatenate(x) for x in zip(*held[kind], strict=True))
            key, train, every = _summed(key, train, every)
            held[kind] = []
            return table(kind=np.full(len(key), kind, np.int32), key=signed(key), n_train=train, n_all=every)

        for batch in batches:
            out = np.array(batch.column(0).fill_null(True).to_numpy(zero_copy_only=False), bool)
            for lo, hi, data, offsets in rounds(batch.column(1)):
                (data, offsets), train = _tokens(data, offsets), ~out[lo:hi]
                for kind, (key, bounds) in ((GRAM, _grams(data, offsets)), (WORD, _word_keys(data, offsets))):
                    held[kind].append(counted(key, np.repeat(train, np.diff(bounds))))
                    if len(held[kind]) >= 16:
                        key, a, b = (np.concatenate(x) for x in zip(*held[kind], strict=True))
                        held[kind] = [_summed(key, a, b)]
                    if sum(len(x[0]) for x in held[kind]) > HELD:
                        yield give(kind)
        for kind in held:
            if held[kind]:
                yield give(kind)

    parts = docs.select("held_out", "text").mapInArrow(run, "kind int, key long, n_train long, n_all long")
    return parts.groupBy("kind", "key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of any sequence with these counts."""
    pairs, back = np.unique(np.stack((zeros, ones)), axis=1, return_inverse=True)
    a, b = pairs.astype(float)
    value = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - 2 * _HALF_GAMMA - _log_gamma(a + b + 1)
    return value[back.ravel()]


class _Level:
    """The nodes of one context length: rows are (context, node of the decision tree)."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray):
        node = np.concatenate([(1 << j) | (byte >> (8 - j)) for j in range(8)])  # heap number, from 1
        bit = np.concatenate([(byte >> (7 - j)) & 1 for j in range(8)])
        key = np.concatenate([context] * 8).astype(np.int64) << 8 | node
        self.keys, self.of = np.unique(key, return_inverse=True)
        every = np.concatenate([n] * 8)
        self.ones = np.bincount(self.of, every * bit, len(self.keys)).astype(np.int64)
        self.zeros = np.bincount(self.of, every, len(self.keys)).astype(np.int64) - self.ones
        self.own = _log_kt(self.zeros, self.ones)
        self.seen = (self.zeros + self.ones) > 0

    def weigh(self, below: _Level | None, shift: int = 8) -> None:
        if below is None:
            self.log_weighted, self.own_weight = self.own, np.ones(len(self.keys))
            return
        parent = (below.keys >> 8 >> shift) << 8 | (below.keys & 255)
        product = np.bincount(np.searchsorted(self.keys, parent), below.log_weighted, len(self.keys))
        self.log_weighted = np.logaddexp(self.own, product) - _LOG2
        self.own_weight = np.exp(self.own - _LOG2 - self.log_weighted)


def _levels(gram: np.ndarray, n: np.ndarray, least: int) -> list[_Level]:
    byte = (gram & np.uint64(255)).astype(np.int64)
    out = [_Level((gram >> np.uint64(8 * (DEPTH - d + 1))).astype(np.int64), byte, n) for d in range(least, DEPTH + 1)]
    for level, below in zip(out[::-1], [None, *out[:0:-1]], strict=True):
        level.weigh(below)
    return out


def _bits(level: _Level, bit: np.ndarray) -> np.ndarray:
    ones = (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
    p = ones[level.of]
    return np.where(bit == 1, p, 1 - p)


def _top(tops: pd.DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    """The first two levels: depth -> (keys, probability of a one, own weight, whether seen)."""
    out = {}
    one = tops.sort_values("key")
    keys, zeros, ones = (one[c].to_numpy(np.int64) for c in ("key", "zeros", "ones"))
    product = one["product"].to_numpy(float)
    for depth in (1, 0):
        own = _log_kt(zeros, ones)
        weighted = np.logaddexp(own, product) - _LOG2
        out[depth] = (keys, (ones + 0.5) / (zeros + ones + 1.0), np.exp(own - _LOG2 - weighted), zeros + ones > 0)
        parent, back = np.unique(keys & 255, return_inverse=True)
        zeros, ones, product = (np.bincount(back, x, len(parent)) for x in (zeros, ones, weighted))
        zeros, ones, keys = zeros.astype(np.int64), ones.astype(np.int64), parent
    return out


def gram_scores(grams: DataFrame) -> DataFrame:
    """(key, score): log10 probability of the last byte of every gram (key, n_train), after its context."""
    spark = grams.sparkSession
    grams = grams.select(F.shiftrightunsigned("key", 8 * (DEPTH - 1)).alias("pair"), "key", "n_train")

    def tops(group: pd.DataFrame) -> pd.DataFrame:
        level = _levels(group["key"].to_numpy().astype(np.uint64), group["n_train"].to_numpy(), 2)[0]
        parent = (level.keys >> 16) << 8 | (level.keys & 255)
        return pd.DataFrame({"key": parent, "zeros": level.zeros, "ones": level.ones, "product": level.log_weighted})

    parts = grams.groupBy("pair").applyInPandas(tops, "key long, zeros long, ones long, product double")
    summed = parts.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "product")))
    top = spark.sparkContext.broadcast(_top(summed.toPandas()))  # at most 256 contexts * 255 nodes

    def scores(group: pd.DataFrame) -> pd.DataFrame:
        gram = group["key"].to_numpy().astype(np.uint64)
        byte = (gram & np.uint64(255)).astype(np.int64)
        bit = np.concatenate([(byte >> (7 - j)) & 1 for j in range(8)])
        p, seen = np.full(len(bit), 0.5), np.zeros(len(bit), bool)
        for level in _levels(gram, group["n_train"].to_numpy(), 2)[::-1]:
            mine, weight = _bits(level, bit), level.own_weight[level.of]
            p, seen = np.where(seen, weight * mine + (1 - weight) * p, mine), level.seen[level.of]
        node = np.concatenate([(1 << j) | (byte >> (8 - j)) for j in range(8)])
        newest = np.concatenate([(gram >> np.uint64(8 * DEPTH)).astype(np.int64)] * 8)
        for depth, key in ((1, newest << 8 | node), (0, node)):
            keys, one, own, known = top.value[depth]
            at = np.searchsorted(keys, key)
            mine = np.where(bit == 1, one[at], 1 - one[at])
            p, seen = np.where(seen, own[at] * mine + (1 - own[at]) * p, mine), known[at]
        return pd.DataFrame({"key": group["key"], "score": np.log10(p).reshape(8, -1).sum(axis=0)})

    return grams.groupBy("pair").applyInPandas(scores, "key long, score double")


def _common(values: DataFrame, spark) -> tuple[np.ndarray, np.ndarray]:
    """A hash table of the at most COMMON keys with the largest counts: all counts from some number on."""
    level = (F.floor(F.log2("n_all") * 8)).cast("int").alias("level")
    sizes = sorted(values.groupBy(level).count().collect(), reverse=True)  # at most 512 rows
    least, rows = None, 0
    for at, n in sizes:
        if rows + n > COMMON:
            break
        least, rows = at, rows + n
    if least is None:
        return _hashed(np.zeros(0, np.int64), np.zeros(0))
    found = values.where(F.floor(F.log2("n_all") * 8) >= least).select("key", "value").toPandas()
    return _hashed(found["key"].to_numpy(np.int64), found["value"].to_numpy(float))


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)


def _hashed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash table as two arrays: keys, and values (not a number: free)."""
    bits = max(4, int(4 * len(keys)).bit_length())
    its_keys, its_values = np.zeros(1 << bits, np.int64), np.full(1 << bits, np.nan)
    slot = _slots(keys, bits)
    while len(keys):
        free = np.isnan(its_values[slot])
        _, first = np.unique(np.where(free, slot, -1), return_index=True)
        first = first[free[first]]
        its_keys[slot[first]], its_values[slot[first]] = keys[first], values[first]
        left = np.ones(len(keys), bool)
        left[first] = False
        keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << bits) - 1)
    return its_keys, its_values


def _look_up(keys: np.ndarray, its_keys: np.ndarray, its_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the keys found, 0 else; which were not found)."""
    keys = np.ascontiguousarray(keys)
    last = len(its_keys) - 1
    slot = _slots(keys, last.bit_length())
    value = its_values[slot]
    open_ = np.flatnonzero((its_keys[slot] != keys) & ~np.isnan(value))
    while len(open_):
        slot[open_] = (slot[open_] + 1) & last
        at = slot[open_]
        value[open_] = its_values[at]
        open_ = open_[(its_keys[at] != keys[open_]) & ~np.isnan(its_values[at])]
    missing = np.isnan(value)
    value[missing] = 0.0
    return value, missing


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of (doc_id, text).

    ``base_score`` is the unigram score of words and one end token, add-0.1, learnt from the same rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True)))
    model = stored(counts(docs), "counts")
    word = model.where(F.col("kind") == WORD)
    ends = docs.where("NOT held_out").count()
    total, distinct = word.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))).first()
    total, distinct = total + ends, distinct + (ends > 0)
    below = 0.1 * (distinct + 1) + total
    # the value of a word: its count, from which its score and whether it is known follow
    words_ = word.select(F.lit(WORD).alias("kind"), "key", "n_all", F.col("n_train").cast("double").alias("value"))
    grams = model.where(F.col("kind") == GRAM)
    scored = stored(gram_scores(grams), "gram-scores").join(grams.select("key", "n_all"), "key")
    values = stored(words_.union(scored.select(F.lit(GRAM), "key", "n_all", "score")), "values")
    common = spark.sparkContext.broadcast({k: _common(values.where(F.col("kind") == k), spark) for k in (GRAM, WORD)})
    base = lambda count: np.log10((count + 0.1) / below)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, part = 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, offsets in rounds(batch.column(1)):
                (data, offsets), n = _tokens(data, offsets), hi - lo
                sums = {}
                rest = []
                for kind, (key, bounds) in ((GRAM, _grams(data, offsets)), (WORD, _word_keys(data, offsets))):
                    key = signed(key)
                    value, missing = _look_up(key, *common.value[kind])
                    doc = np.repeat(np.arange(n), np.diff(bounds))
                    weight = value if kind == GRAM else np.where(missing, 0.0, base(value))
                    sums[kind] = np.bincount(doc, weight, n)
                    if kind == WORD:
                        known = np.bincount(doc[~missing & (value > 0)], minlength=n)
                        tokens = np.diff(bounds) + 1
                    order = np.lexsort((key[missing], doc[missing]))
                    key, doc = key[missing][order], doc[missing][order]
                    new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))) if len(key) else order
                    rest.append((np.full(len(new), kind, np.int32), key[new], doc[new], np.diff(np.append(new, len(key)))))
                ids = part + row + np.arange(n)
                row += n
                kind, key, doc, times = (np.concatenate(x) for x in zip(*rest, strict=True))
                empty = pa.nulls(n, pa.int64())
                yield table(
                    row=ids, kind=np.full(n, -1, np.int32), key=empty, n=tokens.astype(np.int64), known=known.astype(np.int64),
                    base=sums[WORD] + base(np.float64(ends)), score=sums[GRAM], doc_id=batch.column(0).slice(lo, n), held_out=batch.column(2).slice(lo, n),
                )
                m = len(key)
                if m:
                    yield table(
                        row=ids[doc], kind=kind, key=key, n=times.astype(np.int64), known=pa.nulls(m, pa.int64()),
                        base=pa.nulls(m, pa.float64()), score=pa.nulls(m, pa.float64()), doc_id=pa.nulls(m, pa.int64()), held_out=pa.nulls(m, pa.bool_()),
                    )

    out = "row long, kind int, key long, n long, known long, base double, score double, doc_id long, held_out boolean"
    # written, so a row number that a task has given stays
    found = stored(docs.select("doc_id", "text", "held_out").mapInArrow(run, out), "scored")
    rare = found.where("kind >= 0").select("row", "kind", "key", "n").join(values.select("kind", "key", "value"), ["kind", "key"])
    is_word = F.col("kind") == WORD
    add = rare.groupBy("row").agg(
        F.sum(F.when(is_word & (F.col("value") > 0), F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.when(is_word, F.col("n") * F.log10((F.col("value") + 0.1) / below)).otherwise(0.0)).alias("base"),
        F.sum(F.when(~is_word, F.col("n") * F.col("value")).otherwise(0.0)).alias("score"),
    )
    whole = found.where("kind < 0").join(add.select("row", *(F.col(c).alias(f"more_{c}") for c in ("known", "base", "score"))), "row", "left")
    plus = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
    return whole.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (plus("known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), plus("base").alias("base_score"), plus("score").alias("score"),
    )
