"""Exact top-k by inner product: columnar branch and bound over blocks of dimensions.

Vectors are whole numbers, floor(scale * x). Candidates and queries are dealt into blocks by id; each pair of blocks is one
group, so no task holds more than two blocks. Inside, candidates lie dimension by dimension. The scores grow block of
dimensions by block; after each, what a candidate can still gain or lose is at most the product of the remaining lengths of
both vectors (Cauchy-Schwarz), and candidates that can't reach the k-th best are taken out. Survivors are ranked exactly,
and the blocks' best k of each query meet in one ranking.

Defined cases: vectors that are null or hold a null or a non-finite component, and rows without an id take no part; a
shorter vector counts as if filled with zeros; ties go to the smaller id; rows with the query's id are its own and no candidates; a
repeated candidate row is listed as often as it occurs; query rows of one id are one query, the greatest of their vectors
(compared component by component); other columns are not read, so their names may clash; scores beyond the range of a long are set to its ends; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

CANDIDATES, QUERIES = 16_384, 4_096
DIMENSIONS = 16
AT_ONCE = 128
_SAFE = 2.0**52


def _matrix(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return np.floor(scale * out)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best candidates of each query."""
    dims = max(q.shape[1], c.shape[1], 1)
    q, c = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, c))
    if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * dims >= _SAFE:
        return _slow(q_ids, q, c_ids, c, k)
    tall = np.ascontiguousarray(c.T)
    rest = lambda x: np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])
    c_rest, q_rest = np.pad(rest(c), ((0, 0), (0, 1))), np.pad(rest(q), ((0, 0), (0, 1)))
    out: tuple[list, list, list] = ([], [], [])
    step = min(DIMENSIONS, dims)
    for at in range(0, len(q), AT_ONCE):
        first = q[at : at + AT_ONCE, :step] @ tall[:step]
        for i, score in enumerate(first, at):
            alive = np.flatnonzero(c_ids != q_ids[i])
            score, done = score[alive], step
            while True:
                if done < dims and len(alive) > k:
                    slack = q_rest[i, done] * c_rest[alive, done]
                    floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                    stay = score + slack >= floor - 1  # 1: more than the rounding of the bounds
                    alive, score = alive[stay], score[stay]
                if done >= dims:
                    break
                to = min(done + DIMENSIONS, dims)
                score = score + q[i, done:to] @ tall[done:to, alive]
                done = to
            best = _best(c_ids[alive], score, k)
            out[0].extend([q_ids[i]] * len(best))
            out[1].extend(c_ids[alive][best])
            out[2].extend(score[best].astype(np.int64))
    return out


def _slow(q_ids, q, c_ids, c, k) -> tuple[list, list, list]:
    """The same for numbers too large for exact floating point: Python's whole numbers."""
    out: tuple[list, list, list] = ([], [], [])
    whole = [[int(x) for x in row] for row in c]
    for i, row in zip(q_ids, q, strict=True):
        mine = [int(x) for x in row]
        scored = sorted((-sum(a * b for a, b in zip(mine, x, strict=True)), j) for j, x in zip(c_ids, whole, strict=True) if j != i)[:k]
        out[0].extend([i] * len(scored))
        out[1].extend(j for _, j in scored)
        out[2].extend(max(-(2**63), min(2**63 - 1, -s)) for s, _ in scored)
    return out


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, embedding) queries against all (vec_id, embedding) rows."""
    usable = (
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND "
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    take = lambda df, s: df.where(usable).select(
        F.col("vec_id").cast("long").alias(f"{s}_id"), F.col("embedding").cast("array<double>").alias(f"{s}_vector")
    )
    rows, queries = take(rows, "c"), take(queries, "q").groupBy("q_id").agg(F.max("q_vector").alias("q_vector"))
    n_blocks = max(1, -(-rows.count() // CANDIDATES))
    q_blocks = max(1, -(-queries.count() // QUERIES))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    c = rows.withColumn("c_block", F.pmod(F.xxhash64("c_id"), F.lit(n_blocks)).cast("int")).withColumn("c_with", spread(q_blocks))
    q = queries.withColumn("q_with", F.pmod(F.xxhash64("q_id"), F.lit(q_blocks)).cast("int")).withColumn("q_block", spread(n_blocks))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            ids = [t.column(n).to_numpy() for t, n in ((right, "q_id"), (left, "c_id"))]
            found = _search(ids[0], _matrix(right.column("q_vector"), scale), ids[1], _matrix(left.column("c_vector"), scale), k)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query_id", "vec_id", "score"), found, strict=True)})

    pairs = c.groupBy("c_block", "c_with").cogroup(q.groupBy("q_block", "q_with"))
    found = pairs.applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
