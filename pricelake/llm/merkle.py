"""Merkle manifest of a data set: leaves, subroots per language, root, proofs, and what a changed leaf does to the root.

``H`` is the lowercase hex SHA-256 of its inputs joined, digests as hex text. A row's leaf is H of its fields, each as byte count, ``:`` and
value, or ``-`` if null. Leaves of a language ascend by id; every ``FAN`` neighbours become their H until one node remains (the subroot);
the subroots, by language, give the root in the same way.

1. One scan makes the leaves. One range sort by (language, id, leaf, row) numbers them; a language of any size spreads over many ranges,
   and a leaf's place is its place in its range plus the rows of its language in earlier ranges (a small table).
2. Upwards: ``FAN ** depth`` consecutive nodes are a superblock, which becomes one node; the superblocks' nodes are numbered alike and
   grouped again until each language has one node. Then the same over the languages.
3. Downwards: the nodes of each level are cogrouped with the outer path of their superblock (the siblings of its node and of all nodes
   above it, a few kilobytes). The last cogroup, of leaves and outer paths, reduces the superblock again, joins the inner siblings to the outer
   ones, and folds each leaf (or its tampered form) up to the root.

No task holds more than one superblock, and no proof, path or level passes through the driver.

Defined cases: null fields are ``-``, which no value can look like; a null language is a language of its own and the first; null ids come first
in their language and are never tampered with; rows with the same id go by their leaf, so repeated rows stand together and each has its own
proof; an empty text is ``0:``; very long texts are hashed whole; other columns don't count, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricelake.llm.arrays import LOWER
from pricelake.llm.store import stored

#: Children of a node; levels of a superblock, which has FAN ** DEPTH leaves.
FAN, DEPTH = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOWER = bytes(LOWER)


def digest(*parts: bytes) -> bytes:
    """H, as hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _field(value: bytes | None) -> bytes:
    return b"-" if value is None else b"%d:%s" % (len(value), value)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, row, leaf, changed): ``changed`` is the leaf after its text's A-Z are lower-cased, where 3 divides crc32 of the id; else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0).to_pylist()
            numbers = ([None if x is None else str(x).encode() for x in batch.column(i).to_pylist()] for i in (0, 3))
            texts = (batch.column(i).cast(pa.large_binary()) for i in (1, 2, 4))
            leaf, changed = [], []
            for doc_id, n_chars, source, lang, text in zip(*numbers, *texts, strict=True):
                text = text.as_py()
                head = b"".join(map(_field, (doc_id, source.as_py(), lang.as_py(), n_chars)))
                leaf.append(digest(head, _field(text)))
                tampered = doc_id is not None and zlib.crc32(doc_id) % 3 == 0
                changed.append((digest(head, _field(text.translate(_LOWER))) if text is not None else leaf[-1]) if tampered else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column(2), pa.array(range(row, row + len(ids)), pa.int64()), pa.array(leaf, pa.binary()), pa.array(changed, pa.binary())],
                ["doc_id", "lang", "row", "leaf", "changed"],
            )
            row += len(ids)

    typed = docs.select(*(F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS))
    return typed.mapInArrow(run, "doc_id long, lang string, row long, leaf binary, changed binary")


def _numbered(rows: DataFrame, by: list[str], group: str | None) -> DataFrame:
    """``rows`` with ``at`` (from 0 in the order ``by``, whose first column is ``group``, if there is one) and ``n``, the rows of the group."""
    spark = rows.sparkSession
    order = [F.col(c).asc_nulls_first() for c in by]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = stored(placed.withColumns({"_part": F.shiftright("_id", 33), "_id": F.col("_id").bitwiseAND((1 << 33) - 1)}), "numbered")
    name = F.col(group) if group else F.lit(None).cast("string")
    counts = placed.groupBy("_part", name.alias("_group")).agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    earlier = F.expr("sum(_rows) OVER (PARTITION BY _group ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    # one row per range and language
    base = counts.select("_part", "_group", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_base"), F.expr("sum(_rows) OVER (PARTITION BY _group)").alias("n"))
    base = base.withColumnRenamed("_part", "_p")
    same = (F.col("_part") == F.col("_p")) & name.eqNullSafe(F.col("_group"))
    out = placed.join(base, same).withColumn("at", F.col("_id") + F.col("_base"))
    return out.select(*rows.columns, "at", "n")


def _reduce(nodes: list[bytes], total: int, depth: int) -> list[list[bytes]]:
    """All levels of one superblock, from its nodes to its single node; ``total`` nodes of the group are on the first level."""
    levels = [nodes]
    while total > 1 and len(levels) <= depth:
        last = levels[-1]
        levels.append([digest(*last[i : i + FAN]) for i in range(0, len(last), FAN)])
        total = -(-total // FAN)
    return levels


def _siblings(levels: list[list[bytes]], i: int) -> list[tuple[int, list[bytes]]]:
    """For each level below the last: place of the path's node in its run, and the others of the run."""
    out = []
    for level in levels[:-1]:
        start = i - i % FAN
        run = level[start : start + FAN]
        out.append((i - start, run[: i - start] + run[i - start + 1 :]))
        i //= FAN
    return out


def _packed(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([place, len(others)]) + b"".join(others) for place, others in path)


def _unpacked(raw: bytes) -> list[tuple[int, list[bytes]]]:
    out, at = [], 0
    while at < len(raw):
        place, n = raw[at], raw[at + 1]
        out.append((place, [raw[at + 2 + 64 * i : at + 66 + 64 * i] for i in range(n)]))
        at += 2 + 64 * n
    return out


def fold(leaf: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for place, others in path:
        leaf = digest(*others[:place], leaf, *others[place:])
    return leaf


NODES = "grp long, at long, n long, node binary"


def _climb(nodes: DataFrame, depth: int) -> DataFrame:
    """(grp, at, n, node) of the superblocks of ``nodes``."""
    size = FAN**depth

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        total, at = rows.column("n")[0].as_py(), rows.column("at")[0].as_py() // size
        top = _reduce(rows.column("node").to_pylist(), total, depth)[-1]
        return pa.table({
            "grp": rows.column("grp").slice(0, 1), "at": pa.array([at], pa.int64()), "n": pa.array([-(-total // size)], pa.int64()),
            "node": pa.array(top, pa.binary()),
        })

    return nodes.select("grp", "at", "n", "node", F.expr(f"at div {size}").alias("super")).groupBy("grp", "super").applyInArrow(run, NODES)


def _tree(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """All levels of superblocks, from ``nodes`` to one node per group."""
    levels = [nodes]
    while True:
        levels.append(stored(_climb(levels[-1], depth), "merkle-level"))
        if levels[-1].agg(F.max("n")).first()[0] == 1:  # one number
            return levels


OUTER = "grp long, at long, path binary, subroot binary, root binary"


def _outer(nodes: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """The outer path of each node, given that of its superblock."""

    def run(mine: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("at")
        levels, top = _reduce(list(mine["node"]), int(mine["n"].iloc[0]), depth), outer.iloc[0]
        path = [_packed(_siblings(levels, i)) + top["path"] for i in range(len(mine))]
        return pd.DataFrame({"grp": mine["grp"], "at": mine["at"], "path": path, "subroot": top["subroot"], "root": top["root"]})

    return _meet(nodes, above, depth).applyInPandas(run, OUTER)


def _meet(nodes: DataFrame, above: DataFrame, depth: int):
    nodes = nodes.withColumn("super", F.expr(f"at div {FAN**depth}"))
    return nodes.groupBy("grp", "super").cogroup(above.groupBy("grp", "at"))


def _descend(levels: list[DataFrame], outer: DataFrame, depth: int) -> DataFrame:
    """Outer paths of the superblocks of the first level, given those of the last level's nodes."""
    for nodes in reversed(levels[1:-1]):
        outer = _outer(nodes, outer, depth)
    return outer


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): one row per row of ``docs``.

    ``depth``: levels of a superblock; it changes no result.
    """
    made = _numbered(leaves(docs), ["lang", "doc_id", "leaf", "row"], "lang")
    made = stored(made.select("doc_id", "lang", "leaf", "changed", "at", "n"), "leaves")
    langs = _numbered(made.where("at = 0").select("lang"), ["lang"], None).select("lang", F.col("at").alias("grp"))
    langs = stored(langs.withColumnRenamed("lang", "_lang"), "languages")
    made = made.join(langs, F.col("lang").eqNullSafe(F.col("_lang"))).select("grp", "at", "n", F.col("leaf").alias("node"), "doc_id", "changed")
    if langs.isEmpty():
        return made.select("doc_id", *(F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), F.lit(True).alias("verified"))

    levels = _tree(made.select("grp", "at", "n", "node"), depth)
    # the languages' subroots are the nodes of one more group
    n = F.lit(levels[-1].count()).cast("long")
    subroots = levels[-1].select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("at"), n.alias("n"), "node")
    tops = _tree(stored(subroots, "subroots"), depth)
    empty = F.lit(b"")
    top = tops[-1].select("grp", "at", empty.alias("path"), empty.alias("subroot"), F.col("node").alias("root"))
    upper = _outer(tops[0], _descend(tops, top, depth), depth)
    upper = upper.select(F.col("at").alias("grp"), F.lit(0).cast("long").alias("at"), "path", "root")
    upper = upper.join(levels[-1].select("grp", F.col("node").alias("subroot")), "grp").select("grp", "at", "path", "subroot", "root")
    outer = stored(_descend(levels, stored(upper, "upper"), depth), "outer")

    def finish(mine: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("at")
        nodes, top = list(mine["node"]), above.iloc[0]
        levels, rest, root = _reduce(nodes, int(mine["n"].iloc[0]), depth), _unpacked(top["path"]), top["root"]
        outer = b"".join(x for _, others in rest for x in others)
        proofs, folded = [], []
        for i, changed in enumerate(mine["changed"]):
            path = _siblings(levels, i)
            proofs.append(digest(*(x for _, others in path for x in others), outer).decode())
            folded.append(fold(fold(nodes[i] if changed is None else changed, path), rest).decode())
        return pd.DataFrame({
            "doc_id": mine["doc_id"].array, "leaf": [x.decode() for x in nodes], "subroot": top["subroot"].decode(), "root": root.decode(),
            "proof_sha256": proofs, "folded_root": folded, "verified": [x == root.decode() for x in folded],
        })

    made = made.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas would turn ids beside null into floats
    result = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _meet(made, outer, depth).applyInPandas(finish, result).withColumn("doc_id", F.col("doc_id").cast("long"))
