"""Exact duplicates by a Golomb-coded fingerprint exchange.

Texts are equal when their bytes are, after A-Z are lower-cased. The rows are written once, in blocks of at most ``BLOCK`` rows, to a
table that is bucketed by block; so what is sent back to a block later meets its rows without their texts being shuffled.

1. Each block (the sender) sorts its distinct fingerprints, the first bits of the texts' SHA-256, cuts them by range among the owners and
   sends each owner one message: the gaps between neighbours, Golomb-coded with a power of two as divisor. A fingerprint has eight bits more
   than the number of rows needs, so one text in 256 is suspected wrongly and a message takes two to four bytes a text.
2. An owner counts the fingerprints of all its messages and answers each message by a bitmap: which of its fingerprints came from
   several blocks. A block sends a fingerprint once, so a text of a third of all rows costs an owner one fingerprint per block.
3. A block marks the rows whose bit is set, and those whose fingerprint it holds twice itself. Only these suspects' texts are shuffled and
   compared byte by byte, as the key of an aggregate (copies are combined before the shuffle).

Defined cases: a null text is an empty one, and empty texts are equal; null ids count as smaller than all others (if a group has no other, ``keep_id``
is null); of repeated rows (same id, same text) exactly one stays; very long texts are hashed and compared whole; other columns are not
read, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricelake.llm.arrays import LOWER, rounds, table
from pricelake.llm.store import stored
from pricelake.session import scratch_path

#: Rows of a block at most, fingerprints of an owner, rows of a bucket, bits of a fingerprint beyond those that number the rows.
BLOCK, OWNER, BUCKET, EXTRA_BITS = 1 << 16, 1 << 22, 1 << 18, 8
RESULT = "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"


def golomb(gaps: np.ndarray) -> bytes:
    """Gaps as one byte for the divisor's exponent, all quotients in unary, then all remainders."""
    k = max(0, int(math.log2(max(float(gaps.mean()) * math.log(2), 1.0)))) if len(gaps) else 0
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    bits = (gaps[:, None] >> np.arange(k, dtype=np.uint64)).astype(np.uint8) & 1
    return bytes([k]) + np.packbits(np.concatenate((unary, bits.reshape(-1)))).tobytes()


def ungolomb(raw: bytes, n: int) -> np.ndarray:
    k, bits = raw[0], np.unpackbits(np.frombuffer(raw, np.uint8, offset=1))
    ends = np.flatnonzero(bits)[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    start = int(ends[-1]) + 1 if n else 0
    rest = bits[start : start + n * k].reshape(n, k).astype(np.uint64) << np.arange(k, dtype=np.uint64)
    return (quotient.astype(np.uint64) << np.uint64(k)) + rest.sum(axis=1, dtype=np.uint64)


def _rows(docs: DataFrame, block_rows: int) -> DataFrame:
    """(block, pos, doc_id, sha, norm): every row with its place and its lower-cased bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, at = TaskContext.get().partitionId() << 20, 0
        for batch in batches:
            for lo, hi, data, offsets in rounds(batch.column(1)):
                low = LOWER[data]
                norm = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low)])
                view = memoryview(low)
                sha = [hashlib.sha256(view[x:y]).digest() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                number = at + np.arange(hi - lo)
                yield table(
                    block=first + number // block_rows, pos=(number % block_rows).astype(np.int32),
                    doc_id=batch.column(0).slice(lo, hi - lo), sha=pa.array(sha, pa.binary()), norm=norm.cast(pa.binary()),
                )
                at += hi - lo

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "block long, pos int, doc_id long, sha binary, norm binary")


def _prints(sha: pa.ChunkedArray, bits: int) -> np.ndarray:
    flat = b"".join(x.as_py()[:8] for x in sha)
    return np.frombuffer(flat, ">u8").astype(np.uint64) >> np.uint64(64 - bits)


def _lows(bits: int, owners: int) -> np.ndarray:
    """The least fingerprint of each owner."""
    return np.array([-(-(i << bits) // owners) for i in range(owners + 1)], np.uint64)


def _send(bits: int, owners: int):
    """The messages of one block, to each owner that has any of its fingerprints."""

    def run(rows: pa.Table) -> pa.Table:
        prints, lows = np.unique(_prints(rows.column("sha"), bits)), _lows(bits, owners)
        cuts = np.searchsorted(prints, lows)
        to = np.flatnonzero(np.diff(cuts))
        coded = []
        for o in to:
            mine = prints[cuts[o] : cuts[o + 1]]
            coded.append(golomb(np.diff(mine, prepend=lows[o])))
        return pa.table({
            "owner": pa.array(to, pa.int32()), "block": pa.array([rows.column("block")[0].as_py()] * len(to), pa.int64()),
            "n": pa.array(np.diff(cuts)[to], pa.int32()), "coded": pa.array(coded, pa.binary()),
        })

    return run


def _answer(bits: int, owners: int):
    """A bitmap for each message of one owner that holds a fingerprint of several blocks."""

    def run(messages: pa.Table) -> pa.Table:
        owner = messages.column("owner")[0].as_py()
        low = _lows(bits, owners)[owner]
        sizes = messages.column("n").to_numpy()
        prints = [low + np.cumsum(ungolomb(raw.as_py(), n), dtype=np.uint64) for raw, n in zip(messages.column("coded"), sizes.tolist(), strict=True)]
        flat = np.concatenate(prints)
        order = np.argsort(flat, kind="stable")
        same = flat[order][1:] == flat[order][:-1]
        twice = np.zeros(len(flat), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        ends = np.cumsum(sizes)
        some = [i for i, (x, y) in enumerate(zip(ends - sizes, ends, strict=True)) if twice[x:y].any()]
        return pa.table({
            "block": messages.column("block").take(pa.array(some, pa.int64())), "owner": pa.array([owner] * len(some), pa.int32()),
            "bitmap": pa.array([np.packbits(twice[ends[i] - sizes[i] : ends[i]]).tobytes() for i in some], pa.binary()),
        })

    return run


def _mark(bits: int, owners: int):
    """(block, marks): for each row of one block, by place, whether it is a suspect; nothing for a block without any."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        none = pa.table({"block": pa.array([], pa.int64()), "marks": pa.array([], pa.list_(pa.bool_()))})
        if not rows.num_rows:
            return none
        prints, back, times = np.unique(_prints(rows.column("sha"), bits), return_inverse=True, return_counts=True)
        cuts = np.searchsorted(prints, _lows(bits, owners))
        suspect = times > 1
        for owner, raw in zip(answers.column("owner").to_pylist(), answers.column("bitmap"), strict=True):
            x, y = cuts[owner], cuts[owner + 1]
            suspect[x:y] |= np.unpackbits(np.frombuffer(raw.as_py(), np.uint8))[: y - x].astype(bool)
        if not suspect.any():
            return none
        pos = rows.column("pos").to_numpy()
        marks = np.zeros(int(pos.max()) + 1, bool)
        marks[pos] = suspect[back]
        return pa.table({"block": rows.column("block").slice(0, 1), "marks": pa.array([marks], pa.list_(pa.bool_()))})

    return run


def _bucketed(df: DataFrame, spark: SparkSession, buckets: int) -> DataFrame:
    """Write to the shared folder, bucketed by block (each task writes its own blocks: nothing is shuffled), and read."""
    name = f"exact_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "exact-rows")).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the catalog's entry: the table is external, and ``out`` is resolved
    return out


def exact_duplicates(docs: DataFrame, block_rows: int | None = None, owners: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``; of equal texts the largest id stays.

    The numbers of rows a block, of owners and of buckets follow the number of rows; they change no result.
    """
    spark = docs.sparkSession
    total = docs.count()  # of a Parquet scan: from the footers
    if not total:
        return spark.createDataFrame([], RESULT)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    block_rows = block_rows or max(1024, min(BLOCK, total // (8 * tasks)))
    owners = owners or max(tasks, math.ceil(total / OWNER))
    bits = min(63 - owners.bit_length(), math.ceil(math.log2(total + 1)) + EXTRA_BITS)
    rows = _bucketed(_rows(docs, block_rows), spark, min(max(tasks, total // BUCKET), 100_000))

    light = rows.select("block", "pos", "sha")
    messages = light.groupBy("block").applyInArrow(_send(bits, owners), "owner int, block long, n int, coded binary")
    answers = messages.groupBy("owner").applyInArrow(_answer(bits, owners), "block long, owner int, bitmap binary")
    marks = light.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_mark(bits, owners), "block long, marks array<boolean>")
    marks = stored(marks, "exact-marks")

    rid = F.shiftleft("block", 16) + F.col("pos")
    marked = rows.withColumn("rid", rid).join(marks.hint("shuffle_hash"), "block", "left")
    suspect = F.coalesce(F.get("marks", "pos"), F.lit(False))
    least = F.lit(-(1 << 63))
    groups = marked.where(suspect).groupBy("sha", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.max_by("rid", F.coalesce("doc_id", least)).alias("keep_rid"), F.count("*").alias("group_size"),
    )
    groups = stored(groups.where("group_size > 1").drop("norm"), "exact-groups")

    digest = F.lower(F.hex("sha")).alias("text_sha256")
    alone = marked.where(~suspect).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
    rest = marked.where(suspect).select("rid", "doc_id", "sha").join(groups, "sha", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"), digest,
    )
    return alone.unionByName(rest)
