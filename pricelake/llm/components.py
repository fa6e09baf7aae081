"""Connected components of an edge table, as Spark jobs that meet in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricelake.llm.arrays import table
from pricelake.llm.store import stored

#: Links that a task holds at a time.
HELD = 1 << 20
LINKS = "u long, v long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, id) of every id of the links that is not the smallest of its component."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    label, (u, v) = np.arange(len(ids)), at.reshape(2, -1)
    while len(u):
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        apart = low < high
        u, v = u[apart], v[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]
    child = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[child]], ids[child]


def _contracted(held: int):
    """Links replaced by the stars of the components that a task sees; beyond ``held`` links in hand it gives them away and starts anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, rows = [], [], 0
        for batch in batches:
            a.append(batch.column(0).to_numpy())
            b.append(batch.column(1).to_numpy())
            rows += len(batch)
            if rows > held:
                u, v = forest(np.concatenate(a), np.concatenate(b))
                a, b, rows = [u], [v], len(u)
                if 2 * rows > held:
                    yield table(u=u, v=v)
                    a, b, rows = [], [], 0
        if rows:
            u, v = forest(np.concatenate(a), np.concatenate(b))
            yield table(u=u, v=v)

    return run


def components(edges: DataFrame, a: str = "a", b: str = "b", held: int = HELD) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that links with another one.

    Each round first replaces the links that a task sees by the stars of their components (``held`` links at a time). Once no more
    than ``held`` links are left, one such task gives the result. Before that, rounds alternate large stars (each id links its larger
    neighbours to its smallest one) and small stars (each id links its smaller neighbours to the smallest of them) until nothing
    changes. No star is gathered: a smallest neighbour is an aggregate that is joined back, so a hub with many links is split like any
    skewed join. Every round is written to the shared folder.
    """
    links = stored(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v"), "links")
    rows, before = links.count(), None
    while rows > held:
        links = stored(links.coalesce(-(-rows // held)).mapInArrow(_contracted(held), LINKS).distinct(), "contracted")
        both = links.union(links.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").where("m < v").select(F.col("m").alias("u"), "v").distinct()
        large = stored(large, "large")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        # links run from the smaller u to the larger v: v and its other smaller neighbours go to the smallest one
        pairs = large.join(low, "v")
        links = stored(pairs.select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u < v").distinct(), "small")
        # one row: the number of links and two hashes of the set of them
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == before:
            break
        rows, before = now[0], now
    if rows <= held:
        links = links.coalesce(1).mapInArrow(_contracted(held), LINKS)
    ids = links.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return ids.union(links.select(F.col("u").alias("id"), F.col("u").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))
