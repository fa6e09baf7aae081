"""Exact n-gram Jaccard join by universe partition.

The sets are the distinct word shingles of the whole, lower-cased (A-Z) texts. Two sets link when 100 * |intersection| >=
percent * |union|.

Equal sets are one class. Sizes are cut into bands so that linked sets lie in the same or in neighbouring bands. In band k
linked sets differ in at most ``H`` elements (the smaller set lies in the band). The universe of shingles is cut by hash into
``m`` segments. ``ONE`` of them get the threshold 1, twice the share, and all their one-deletion neighbours as keys; the others
get the threshold 0 and one key. By the pigeonhole principle the segments of a linked pair that keep their threshold weigh at
least ``m + ONE - H`` (1 or 2 each). ``m`` is chosen so large that each set can leave out the segments whose keys cost
most: the ``spare`` smallest ones of threshold 0 (small segments are what unrelated sets have in common; equal segments have
equal size, so both sides leave out the same) and one nearly empty one of threshold 1. See ``plan`` for the sum.

Keys meet in sorted streams. A key with n classes gives n - 1 pairs with its first class, never all pairs. These are compared
exactly and joined to components; only keys whose classes are then still in different components are looked at again, in blocks,
across components. A pair inside a component can't change it, so no link is lost. Before sets are fetched, parity bit maps
give a lower bound of the difference and drop the pairs that can't link.

A key that a common passage gives has a share of all classes, and its pairs would be the square of that. So classes that meet in a
key of more than ``LARGE`` get other keys among themselves: of n shingles the ``n - ceil(percent * n / 100) + 1`` that come first in
one order, which puts common shingles last. Two sets that link have one of them in common in any order (see ``_rare``).

Defined cases: a null or blank text has an empty set and links with nothing; a null id is returned with a null component and
links with nothing; rows that share an id are one document; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricelake.llm.arrays import LOWER, mix, owners, rounds, shingles, signed, table, words
from pricelake.llm.components import components
from pricelake.llm.exact import golomb, ungolomb
from pricelake.llm.store import remove, scope, set_aside, shuffles_for, stored

#: Segments of threshold 1, and how many of them a set may leave out when they hold at most TINY elements.
ONE, LEFT_OUT, TINY = 2, 1, 2
#: Classes of one block when a key is looked at again.
BLOCK = 512
#: Classes of a key above which they get other keys; if one of those is as large, it is joined with others.
LARGE = 64
#: Common shingles that are put last, and shingles that a task counts.
COMMON, COUNTED = 1 << 18, 1 << 21
#: The first look takes one key of so many; it only saves work for the last look, which takes all.
PARTS = 16
#: Words of 64 bits that a filter of ids has at most; each id sets two bits of one word.
WORDS = 1 << 18
#: Sets that a task remembers as given.
REMEMBERED = 1 << 17


class Plan(NamedTuple):
    """Per band: largest size, most differing elements, segments, and segments of threshold 0 that a set leaves out."""

    top: np.ndarray
    differ: np.ndarray
    segments: np.ndarray
    spare: np.ndarray


def plan(percent: int) -> Plan:
    tops, at = [], 1
    while at < 1 << 42:
        tops.append(at * 100 // percent)
        at = tops[-1] + 1
    top = np.array(tops)
    differ = (100 - percent) * (100 * top // percent) // 100
    spare = np.ceil(differ * 0.06).astype(np.int64) + 1
    # weight kept = segments + ONE - differ; left out: spare of weight 1, and LEFT_OUT of weight 2 by each side
    segments = differ + 1 + spare + 4 * LEFT_OUT - ONE
    return Plan(top, differ, np.maximum(segments, ONE + 1 + spare), spare)


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    w = words(LOWER[data], offsets)
    return shingles(w.hash, w.bounds, width)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
    return run[bounds[1:]] - run[bounds[:-1]]


def _bitmap(elements: np.ndarray, percent: int) -> bytes:
    """Parities of the elements' numbers per bit; the length is a power of two that grows with the size."""
    differ = 2 * (100 - percent) * len(elements) // (100 + percent)
    bits = max(64, 1 << math.ceil(math.log2(16 * differ + 32)))
    return np.packbits((np.bincount(elements & np.uint64(bits - 1), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def describe(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, bits): one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in rounds(batch.column(1)):
                e, b = _sets(data, offsets, width)
                n = np.diff(b)
                e64 = mix(e + np.uint64(11))
                yield table(
                    doc_id=batch.column(0).slice(lo, hi - lo), n_shingles=n.astype(np.int64),
                    h1=signed(mix(_sums(e64, b))), h2=signed(mix(_sums(mix(e64 + np.uint64(5)), b))),
                    bits=pa.array([_bitmap(e[x:y], percent) for x, y in zip(b[:-1], b[1:], strict=True)], pa.binary()),
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bits binary")


def _keys(e: np.ndarray, b: np.ndarray, band: np.ndarray, of: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of one scheme; ``band`` is -1 for texts that take no part."""
    n = np.diff(b)
    use = (band >= 0) & (n > 0)
    use[use] &= of.differ[band[use]] > 0  # else only equal sets link
    band = np.where(use, band, 0)
    m, spare = np.where(use, of.segments[band], 0), np.where(use, of.spare[band], 0)
    base = np.concatenate(([0], np.cumsum(m)))
    doc = owners(b)
    kept = use[doc]
    e, doc = e[kept], doc[kept]
    share = (m[doc] + ONE).astype(np.uint64)
    place = ((mix(e ^ np.uint64(0x51ED270B)) >> np.uint64(32)) * share >> np.uint64(32)).astype(np.int64)
    seg = np.where(place < 2 * ONE, place // 2, place - ONE)
    at = base[doc] + seg
    value = mix(e + np.uint64(77))
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, at, value)
    size = np.bincount(at, minlength=base[-1])
    owner = owners(base)
    number = np.arange(base[-1]) - base[owner]
    salt = mix((band[owner].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64) + np.uint64(1))
    key = lambda sums, salts: mix(sums * np.uint64(3) + salts)

    zero = number >= ONE
    order = np.lexsort((number[zero], size[zero], owner[zero]))
    zero = np.flatnonzero(zero)[order]
    rank = np.arange(len(zero)) - np.concatenate(([0], np.cumsum(np.maximum(m - ONE, 0))))[owner[zero]]
    zero = zero[rank >= spare[owner[zero]]]
    docs, keys = [owner[zero]], [key(total[zero], salt[zero])]

    one = np.flatnonzero(number < ONE)
    order = np.lexsort((number[one], size[one], owner[one]))
    one = one[order]
    drop = (np.arange(len(one)) % ONE < LEFT_OUT) & (size[one] <= TINY)
    one = one[~drop]
    docs.append(owner[one])
    keys.append(key(total[one], salt[one]))
    stays = np.zeros(base[-1], bool)
    stays[one] = True
    near = stays[at]
    docs.append(doc[near])
    keys.append(key(total[at[near]] - value[near], salt[at[near]]))
    return np.concatenate(docs), np.concatenate(keys)


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, h1) of all schemes of every set; a task gives equal sets once, so a large group of copies sends its keys once per task.

    What a task remembers is bounded (``REMEMBERED``); beyond that a set may be given again, which changes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = plan(percent)
        given = np.zeros(0, np.int64)
        for batch in batches:
            for _, _, data, offsets in rounds(batch.column(0)):
                e, b = _sets(data, offsets, width)
                n = np.diff(b)
                h1 = signed(mix(_sums(mix(e + np.uint64(11)), b)))
                new = np.zeros(len(n), bool)
                new[np.unique(h1, return_index=True)[1]] = True
                new &= ~np.isin(h1, given)
                given = np.concatenate((given, h1[new])) if len(given) < REMEMBERED else h1[new]
                band = np.where(new, np.searchsorted(of.top, n), -1)
                for scheme in (band, np.where((band > 0) & (n * percent <= 100 * of.top[np.maximum(band, 1) - 1]), band - 1, -1)):
                    doc, key = _keys(e, b, scheme, of)
                    yield table(key=signed(key), h1=h1[doc])

    return docs.where("doc_id IS NOT NULL").select("text").mapInArrow(run, "key long, h1 long")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and class: pairs of a key's first class with each other one; rows of keys with three classes or more.

    (a, b, key): key is null for a pair; for a row that is kept for later, b is null.
    """
    last_key = last_class = first = None
    held: list[tuple[int, int]] = []  # the second class of the open key, until a third one comes
    count = 0
    for batch in batches:
        key, h = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (h[1:] != h[:-1])
        if last_key is not None and key[0] == last_key and h[0] == last_class:
            new[0] = False
        key, h = key[new], h[new]
        if not len(key):
            continue
        starts = np.ones(len(key), bool)
        starts[1:] = key[1:] != key[:-1]
        carried = last_key is not None and key[0] == last_key
        starts[0] = not carried
        at = np.flatnonzero(starts)
        run = np.cumsum(starts) - 1  # -1: the key carried over
        firsts = np.append(h[at], first if carried else 0)
        pairs = ~starts
        a, b = firsts[run[pairs]], h[pairs]
        begin = np.append(at, 0)[run]
        position = np.arange(len(key)) - begin + np.where(run < 0, count, 0)
        length = np.append(np.diff(np.append(at, len(key))), (at[0] if len(at) else len(key)) + count)
        later = length[run] >= 3
        later_key, later_class = key[later], h[later]
        if carried and count < 3 <= length[-1]:  # what was held back belongs to a large key after all
            later_key = np.concatenate(([k for k, _ in held], later_key)).astype(np.int64)
            later_class = np.concatenate(([c for _, c in held], later_class)).astype(np.int64)
        last_key, last_class = key[-1], h[-1]
        if run[-1] < 0:
            held = held + list(zip(key.tolist(), h.tolist(), strict=True)) if length[-1] < 3 else []
            count = int(length[-1])
        else:
            first, count = firsts[run[-1]], int(length[run[-1]])
            held = list(zip(key[begin[-1] :].tolist(), h[begin[-1] :].tolist(), strict=True)) if count < 3 else []
        del position
        nulls = lambda n: pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), nulls(len(a))], ["a", "b", "key"])
        if len(later_key):
            yield pa.RecordBatch.from_arrays([pa.array(later_class), nulls(len(later_class)), pa.array(later_key)], ["a", "b", "key"])


def _slots(e: np.ndarray, bits: int) -> np.ndarray:
    return mix(e + np.uint64(123)) >> np.uint64(64 - bits)


def _common(texts: DataFrame, total: int, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits of a slot; the slots that more than ``LARGE`` of the texts' ``total`` shingles hash to, ascending; how many do.

    There are eight slots or more for each shingle. Sorted slots are sent Golomb-coded, by range, in about two bytes a shingle. The
    ``COMMON`` most frequent ones are returned; they only set an order.
    """
    bits = min(max(total.bit_length() + 3, 16), 48)
    parts = max(-(-total // COUNTED), 1)
    lows = np.array([-(-(i << bits) // parts) for i in range(parts + 1)], np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in rounds(batch.column(0)):
                slots = np.sort(_slots(_sets(data, offsets, width)[0], bits))
                cuts = np.searchsorted(slots, lows)
                to = np.flatnonzero(np.diff(cuts))
                coded = [golomb(np.diff(slots[cuts[i] : cuts[i + 1]], prepend=lows[i])) for i in to]
                yield table(part=to.astype(np.int32), n=np.diff(cuts)[to].astype(np.int32), coded=pa.array(coded, pa.binary()))

    def count(sent: pa.Table) -> pa.Table:
        low = lows[sent.column("part")[0].as_py()]
        sizes = sent.column("n").to_pylist()
        slots = [low + np.cumsum(ungolomb(raw.as_py(), n), dtype=np.uint64) for raw, n in zip(sent.column("coded"), sizes, strict=True)]
        slot, times = np.unique(np.concatenate(slots), return_counts=True)
        return pa.table({"slot": slot[times > LARGE].astype(np.int64), "times": times[times > LARGE]})

    sent = texts.select("text").mapInArrow(send, "part int, n int, coded binary")
    counted = stored(sent.groupBy("part").applyInArrow(count, "slot long, times long"), "common")
    most = counted.orderBy(F.desc("times"), "slot").limit(COMMON).toArrow().sort_by("slot")
    return bits, most.column("slot").to_numpy().astype(np.uint64), most.column("times").to_numpy()


def _first_keys(texts: DataFrame, common: tuple[int, np.ndarray, np.ndarray], width: int, percent: int) -> DataFrame:
    """(key, h1) of the shingles of each text that come first: common ones last, the rarest of them first, else by number.

    A linked set lacks at most ``n - ceil(percent * n / 100)`` of the n shingles. If two sets link and the last of the first ones of one
    set comes before that of the other, then not all of its first ones can lack there, and what doesn't lack is one of the other's first.
    The key of a common shingle has the size band in it, for a set's own band and the one below where a linked set can lie there.
    """
    bits, slots, times = common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = plan(percent)
        for batch in batches:
            for _, _, data, offsets in rounds(batch.column(0)):
                e, b = _sets(data, offsets, width)
                n, doc = np.diff(b), owners(b)
                h1 = signed(mix(_sums(mix(e + np.uint64(11)), b)))
                slot = _slots(e, bits)
                at = np.searchsorted(slots, slot)
                at[at == len(slots)] = 0
                rank = np.where(slots[at] == slot, times[at], 0) if len(slots) else np.zeros(len(e), np.int64)
                order = np.lexsort((rank, doc))  # a text's shingles are in order already
                first = order[np.arange(len(e)) - b[doc] < (n - (percent * n + 99) // 100 + 1)[doc]]
                rare, often = first[rank[first] == 0], first[rank[first] > 0]
                yield table(key=signed(mix(e[rare] + np.uint64(177))), h1=h1[doc[rare]])
                band = np.searchsorted(of.top, n)
                for scheme in (band, np.where((band > 0) & (n * percent <= 100 * of.top[np.maximum(band, 1) - 1]), band - 1, -1)):
                    some = often[scheme[doc[often]] >= 0]
                    yield table(key=signed(mix(mix(e[some] + np.uint64(277)) + scheme[doc[some]].astype(np.uint64))), h1=h1[doc[some]])

    return texts.select("text").mapInArrow(run, "key long, h1 long")


def _unpacked(raw: list[bytes], size: int) -> np.ndarray:
    """Bit maps folded to ``size`` bytes: halves of a parity map, combined, are the map of half the length."""
    out = np.zeros((len(raw), size), np.uint8)
    for i, x in enumerate(raw):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0)
    return out


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _may_link(n: np.ndarray, k: np.ndarray, low: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes n and k and a least difference allow a link: |union| = (n + k + difference) / 2."""
    return (100 * np.minimum(n, k) >= percent * np.maximum(n, k)) & (100 * (n + k - low) >= percent * (n + k + low))


def _filtered(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, xa, xb = (batch.column(i).to_pylist() for i in range(6))
            low = []
            for x, y in zip(xa, xb, strict=True):
                size = min(len(x), len(y))
                z = _unpacked([x, y], size)
                low.append(int(_ONES[z[0] ^ z[1]].sum(dtype=np.int64)))
            ok = _may_link(np.array(na, np.int64), np.array(nb, np.int64), np.array(low, np.int64), percent)
            keep = pa.array(ok)
            yield batch.select([0, 1]).filter(keep) if len(a) else batch.select([0, 1])

    return run


def _views(column: pa.Array) -> Iterator[np.ndarray]:
    """The sets of a binary column, without a copy."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield np.frombuffer(data, np.uint64, (b - a) // 8, a) if b > a else np.zeros(0, np.uint64)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(_views(batch.column(2)), _views(batch.column(3)), strict=True):
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                out.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(out, pa.bool_()))

    return run


def _apart(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that may have one of the ``ids`` (doc_id), and those that surely have none; no text is shuffled.

    A filter of bounded size (``WORDS``) is broadcast. All rows with one of the ids may have one, and few others: about 0.4 % up to
    ``2 * WORDS`` ids, more beyond; so an exact join is needed for the first part only.
    """
    words = min(max(ids.count() // 2, 64), WORDS)
    h = "xxhash64(cast(doc_id AS long))"
    bit = lambda at: f"shiftleft(1L, cast(shiftrightunsigned({h}, {at}) & 63 AS int))"
    marks = {"filter_word": F.expr(f"pmod({h}, {words})"), "filter_bits": F.expr(f"{bit(58)} | {bit(52)}")}
    seen = ids.withColumns(marks).groupBy("filter_word").agg(F.bit_or("filter_bits").alias("filter_seen"))
    marked = docs.withColumns(marks).join(F.broadcast(seen), "filter_word", "left")
    may = F.expr("coalesce(filter_seen & filter_bits = filter_bits, false)")
    return marked.where(may).select(docs.columns), marked.where(~may).select(docs.columns)


def _set_rows(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(h1, elements) of all rows of the documents ``wanted`` (id), and of few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in rounds(batch.column(1)):
                e, b = _sets(data, offsets, width)
                raw = pa.array([e[x:y].tobytes() for x, y in zip(b[:-1], b[1:], strict=True)], pa.binary())
                yield table(h1=signed(mix(_sums(mix(e + np.uint64(11)), b))), elements=raw)

    chosen, _ = _apart(docs.select("doc_id", "text"), wanted.withColumnRenamed("id", "doc_id"))
    return chosen.mapInArrow(run, "h1 long, elements binary")


def _edges(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, of distinct pairs of classes, each named by h1."""
    side = lambda s: classes.select(F.col("h1").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("bits").alias(f"x{s}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "xa", "xb")
    made: list[str] = []
    with scope(made):
        near = stored(near.mapInArrow(_filtered(percent), "a long, b long"), "candidates")
        wanted = near.select(F.explode(F.array("a", "b")).alias("h1")).distinct()
        # a class's text stands in the row of its smallest id; other rows may share that id
        rows = _set_rows(docs, wanted.join(classes, "h1").select("id").distinct(), width)
        sets = stored(rows.join(wanted, "h1", "left_semi").dropDuplicates(["h1"]), "sets")
    side = lambda s: sets.select(F.col("h1").alias(s), F.col("elements").alias(f"e{s}"))
    met = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ea", "eb")
    out = stored(met.mapInArrow(_verified(percent), "a long, b long"), "verified")
    remove(docs.sparkSession, made)
    return out


def _across(percent: int, best: bool):
    """Pairs across components of two blocks of one key, by size and bit map.

    ``best``: of each class with each other component only the one whose bit maps differ least.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        left, right = left.to_pydict(), {c.removeprefix("r_"): v for c, v in right.to_pydict().items()}
        n, k = np.array(left["n_shingles"], np.int64), np.array(right["n_shingles"], np.int64)
        c, d = np.array(left["component"], np.int64), np.array(right["component"], np.int64)
        size = min(map(len, [*left["bits"], *right["bits"]]), default=8)
        x, y = _unpacked(left["bits"], size), _unpacked(right["bits"], size)
        i, j = [], []
        for at in range(len(n)):
            low = _ONES[x[at] ^ y].sum(axis=1, dtype=np.int64)
            hit = np.flatnonzero((c[at] != d) & _may_link(n[at], k, low, percent))
            if best:
                hit = hit[np.argsort(low[hit], kind="stable")]
                hit = hit[np.unique(d[hit], return_index=True)[1]]
            i += [left["h1"][at]] * len(hit)
            j += [right["h1"][z] for z in hit]
        return pa.table({"a": pa.array(i, pa.int64()), "b": pa.array(j, pa.int64())})

    return run


def _blocks(rows: DataFrame) -> DataFrame:
    """(key, h1, component, blocks, block) of the rows of keys with several components.

    A group of many near copies fills hundreds of large keys with much the same classes. Large keys that share a component
    become one key, in which each class is one row; small keys stay as they are.
    """
    few = rows.where(F.col("k") <= LARGE).select("key", F.lit(False).alias("wide"), "h1", "component")
    few = few.withColumns({"blocks": F.lit(1), "block": F.lit(0)})
    large = rows.where(F.col("k") > LARGE)
    if large.isEmpty():
        return few
    first = large.groupBy("key").agg(F.min("component").alias("a"))
    links = large.join(first, "key").select("a", F.col("component").alias("b")).distinct()
    groups = components(links).select(F.col("id").alias("component"), F.col("component").alias("group"))
    joined = large.select("h1", "component").distinct().join(groups, "component").select(F.col("group").alias("key"), F.lit(True).alias("wide"), "h1", "component")
    sizes = joined.groupBy(F.col("key").alias("group")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    joined = joined.join(sizes, F.col("key") == F.col("group")).drop("group")
    return joined.withColumn("block", F.pmod(F.xxhash64("h1"), F.col("blocks")).cast("int")).unionByName(few)


def _crossed(rows: DataFrame, percent: int, best: bool) -> DataFrame:
    """Distinct pairs (a, b) of classes of one key but of different components; a block meets itself, a key's blocks meet two by two."""
    across = _across(percent, best)
    wide = ["key", "wide", "block", "other"]
    take = [*wide, "h1", "n_shingles", "bits", "component"]
    own = rows.select("key", "wide", "block", "h1", "n_shingles", "bits", "component").groupBy("key", "wide", "block")
    own = own.applyInArrow(lambda block: across(block, block), "a long, b long")
    several = rows.where("blocks > 1")
    left = several.where("block < blocks - 1").withColumn("other", F.explode(F.expr("sequence(block + 1, blocks - 1)")))
    right = several.where("block > 0").withColumn("other", F.col("block")).withColumn("block", F.explode(F.expr("sequence(0, other - 1)")))
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in take))
    pair = left.select(take).groupBy(wide).cogroup(right.groupBy(*(f"r_{c}" for c in wide)))
    crossed = own.union(pair.applyInArrow(across, "a long, b long"))
    return crossed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _meet(keys: DataFrame, label: str) -> DataFrame:
    """What the classes of each of the keys (key, h1) give in their order, see ``_stars``."""
    n = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    met = keys.repartition(n, "key").sortWithinPartitions("key", "h1").mapInArrow(_stars, "a long, b long, key long")
    # equal pairs come from many keys: partial sums drop them before the shuffle
    return stored(met.groupBy("a", "b", "key").agg(F.lit(1).alias("one")).drop("one"), label)


def _pairs(met: DataFrame) -> DataFrame:
    return met.where("key IS NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _distinct_keys(met: DataFrame) -> DataFrame:
    """(key, k, h1) of the keys with k classes, three at least; of keys that hold the same classes, which tell the same, one stays."""
    rows = met.where("key IS NOT NULL").select("key", F.col("a").alias("h1"))
    same = rows.groupBy("key").agg(
        F.bit_xor(F.xxhash64("h1")).alias("f1"), F.bit_xor(F.xxhash64("h1", F.lit(7))).alias("f2"), F.count("*").alias("k")
    )
    return rows.join(same.groupBy("f1", "f2", "k").agg(F.min("key").alias("key")).select("key", "k"), "key")


def _rare(large: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """What the classes of ``large`` keys give by other keys, see ``_first_keys`` and ``_stars``; nothing if there are none."""
    spark = docs.sparkSession
    wanted = stored(classes.join(large.select("h1").distinct(), "h1").select("id", "n_shingles"), "common-classes")
    count, total = wanted.agg(F.count("*"), F.sum("n_shingles")).first()
    if not count:
        return None
    texts, _ = _apart(docs.select("doc_id", "text"), wanted.select(F.col("id").alias("doc_id")))
    common = _common(texts, total, width)
    with shuffles_for(spark, total // 4):
        return _meet(_first_keys(texts, common, width, percent), "rare")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``; component_id is the smallest id reachable by links."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    about = stored(describe(docs, width, percent), "sets-about")
    known = about.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(
        known.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n_shingles"), F.min("bits").alias("bits")),
        "classes",
    )
    met = _meet(signatures(docs, width, percent), "stars")
    with shuffles_for(spark, met.count()):
        found = _joined(met, classes, docs, width, percent)

    whole = classes.join(found, "id", "left").select("h1", "h2", F.coalesce("component", "id").alias("component"))
    placed = about.withColumns({h: F.when(F.expr("doc_id IS NOT NULL AND n_shingles > 0"), F.col(h)) for h in ("h1", "h2")})
    out = placed.join(whole, ["h1", "h2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _joined(met: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of the ids that link, given what met by keys (see ``_stars``)."""
    ids = classes.select("h1", "id")
    name = lambda s: ids.select(F.col("h1").alias(s), F.col("id").alias(f"id_{s}"))
    by_id = lambda pairs: pairs.join(name("a"), "a").join(name("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    pairs = stored(_pairs(met), "pairs")
    linked = _edges(pairs, classes, docs, width, percent)
    rows = stored(_distinct_keys(met), "keys")
    tried = pairs
    found = stored(components(by_id(linked)), "joined")

    def of_several(rows: DataFrame) -> DataFrame:
        """The rows of keys with classes of several components, with the component."""
        placed = rows.join(ids, "h1").join(found, "id", "left").withColumn("component", F.coalesce("component", "id")).drop("id")
        mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        return placed.join(mixed, "key", "left_semi")

    more = None
    rare = _rare(of_several(rows.where(F.col("k") > LARGE)), classes, docs, width, percent)
    if rare is not None:
        more = _pairs(rare)
        rows = stored(rows.where(F.col("k") <= LARGE).unionByName(_distinct_keys(rare)), "keys")
    # keys with classes of several components: the nearest pairs of some keys join most of them, then all that may link are compared
    for part, best in ((0, True), (None, False)):
        some = rows if part is None else rows.where(F.pmod(F.xxhash64("key"), F.lit(PARTS)) == part)
        placed = stored(of_several(some), "mixed")
        blocks = stored(_blocks(placed), "blocks")
        crossed = _crossed(blocks.join(classes.select("h1", "n_shingles", "bits"), "h1"), percent, best)
        if more is not None:
            crossed, more = crossed.union(more).distinct(), None
        crossed = stored(crossed.join(tried, ["a", "b"], "left_anti"), "crossed")
        if crossed.isEmpty():
            continue
        tried = tried.union(crossed)
        linked = linked.union(_edges(crossed, classes, docs, width, percent))
        found = stored(components(by_id(linked)), "joined")
    return found


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those whose component holds a smaller id; of rows that share an id, the least text stays.

    Rows without an id are kept. Columns stay as they are.
    """
    found = stored(near_duplicates(docs, width, percent), "near-duplicates")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    twice = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    docs, put_back = set_aside(docs)
    take = docs.columns
    # no text is shuffled but of repeated ids and of the few rows that a filter can't tell: first the ids that it takes for one of
    # them and that stay are found without their texts, then the rows with such an id
    may, rest = _apart(docs, gone.union(twice))
    spared = stored(may.select("doc_id").join(gone, "doc_id", "left_anti").distinct(), "spared")
    may, _ = _apart(may, spared)
    may = may.join(gone, "doc_id", "left_anti").select(take)
    if twice.isEmpty():
        return put_back(rest.unionByName(may))
    least = may.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*take), F.struct(F.coalesce("text", F.lit("")))).alias("row")
    )
    once = may.join(twice, "doc_id", "left_anti").select(take)
    return put_back(rest.unionByName(once).unionByName(least.select("row.*")))
