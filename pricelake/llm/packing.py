"""Lexical retrieval packing: windows filled with documents that share rare tokens.

Documents of a language are put in the order of their rarest tokens (``KEYS`` of them, rarest first, of those that another document
has too), and every ``SHARD`` documents in that order are a shard; so documents that share a rare token stand together at any size of the corpus,
and a token of many documents is ordered by their next ones. Each shard has its own BM25 inverted index; document
frequencies, the number of documents and their mean length are those of the whole corpus (one row per token of the
vocabulary, so their size is bounded). Inside a shard the longest unused document is the seed of a window; the index
returns its unused neighbours, best first, which fill the window; the last one is cut at the window's end and its rest
opens the next window. Whole windows of long documents are cut off before and need no shard. What is left of a shard in the end is cut into
sequences whose lengths are powers of two, which need no padding. So no token is lost and none is padded.

Defined cases: a null text is an empty one and has the end id only; repeated rows are packed as often as they occur, each with
its own pieces; null languages are one language; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricelake.llm.arrays import rounds, table
from pricelake.llm.store import stored
from pricelake.llm.tokens import encoder

SHARD = 768
KEYS = 8
K1, B = 1.2, 0.75
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """(row, doc_id, lang, n, ids): the ids of each whole text and the end id, as little-endian numbers of ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, coder = TaskContext.get().partitionId() << 28, encoder(tokenizer)
        for batch in batches:
            for lo, hi, data, offsets in rounds(batch.column(1)):
                ids, bounds = coder.encode(data, offsets)
                n = hi - lo
                out = np.insert(ids.astype(kind), bounds[1:], np.array(end_id, kind))
                bounds = bounds + np.arange(n + 1)
                raw = [out[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                part = batch.slice(lo, n)
                yield table(row=row + np.arange(n), doc_id=part.column(0), lang=part.column(2), n=np.diff(bounds), ids=pa.array(raw, pa.binary()))
                row += n

    return docs.select("doc_id", "text", "lang").mapInArrow(run, "row long, doc_id long, lang string, n long, ids binary")


def document_frequencies(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, df) over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                ids = np.unique(np.frombuffer(raw.as_py(), kind)).astype(np.int64)
                if len(ids) and ids[-1] >= len(df):
                    df = np.concatenate((df, np.zeros(int(ids[-1]) + 1, np.int64)))
                df[ids] += 1
        some = np.flatnonzero(df)
        yield table(id=some, df=df[some])

    return tokens.select("ids").mapInArrow(run, "id long, df long").groupBy("id").agg(F.sum("df").alias("df"))


def rarity(df: np.ndarray) -> np.ndarray:
    """The place of each token in the order of document frequencies, rarest first; ``len(df)`` for tokens of less than two documents.

    In the smallest type that holds it, since short numbers are sorted faster.
    """
    order = np.lexsort((np.arange(len(df)), df))
    out = np.empty(len(df), np.int64)
    out[order] = np.arange(len(df))
    out[df < 2] = len(df)
    return out.astype(np.min_scalar_type(len(df)))


def place(lang: int, row: int, ids: np.ndarray, rare: np.ndarray) -> bytes:
    """Where a document stands among all: by language, its rarest tokens and its row."""
    keys = np.full(KEYS, len(rare), ">u4")
    mine = np.sort(rare[ids])
    mine = mine[np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))[:KEYS]]
    keys[: len(mine)] = mine
    return lang.to_bytes(4, "big") + keys.tobytes() + row.to_bytes(8, "big")


def shard_starts(places: DataFrame, sizes: list[int]) -> np.ndarray:
    """The first place of each shard, given all of them and the number of documents of each language: one row per shard."""
    ordered = places.orderBy("place").select("place", F.monotonically_increasing_id().alias("at"))
    part, at = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    ordered = stored(ordered.select("place", part.alias("part"), at.alias("at")), "places")
    counts = dict(ordered.groupBy("part").count().collect())  # one row per task
    before, total = {}, 0
    for i in sorted(counts):
        before[i], total = total, total + counts[i]
    first = np.concatenate(([0], np.cumsum(sizes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = np.array([before[i] for i in batch.column(1).to_pylist()], np.int64) + batch.column(2).to_numpy()
            start = (rank - first[np.searchsorted(first, rank, side="right") - 1]) % SHARD == 0
            yield table(place=batch.column(0).filter(pa.array(start)))

    starts = [bytes(r[0]) for r in ordered.mapInArrow(run, "place binary").collect()]
    return np.sort(np.array(starts, f"S{12 + 4 * KEYS}"))


class _Index:
    """BM25 weights of one shard's documents, by token."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        size = np.array([len(x) for x in docs])
        pair = np.concatenate([np.uint64(i << 32) | x.astype(np.uint64) for i, x in enumerate(docs)])
        pair, times = np.unique(pair, return_counts=True)
        doc, token = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        weight = idf[token] * times * (K1 + 1) / (times + K1 * (1 - B + B * size[doc] / mean))
        self.tokens = token  # by document
        self.bounds = np.searchsorted(doc, np.arange(len(docs) + 1))
        order = np.argsort(token, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        names, self.first, self.times = np.unique(token[order], return_index=True, return_counts=True)
        self.place = np.zeros(int(names[-1]) + 1, np.int64)
        self.place[names] = np.arange(len(names))

    def scores(self, i: int) -> np.ndarray:
        """Scores of all documents for the tokens of document i."""
        at = self.place[self.tokens[self.bounds[i] : self.bounds[i + 1]]]
        first, times = self.first[at], self.times[at]
        to = np.cumsum(times)
        where = np.arange(to[-1]) + np.repeat(first - (to - times), times)
        return np.bincount(self.doc[where], self.weight[where], len(self.bounds) - 1)


def fill(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length)."""
    if not docs:
        return []
    index = _Index(docs, idf, mean)
    size = np.array([len(x) for x in docs])
    unused = np.ones(len(docs), bool)
    by_size = iter(np.lexsort((np.arange(len(docs)), -size)))
    out: list[list[tuple[int, int, int]]] = []
    carry: tuple[int, int] | None = None
    left = len(docs)
    while left or carry:
        if carry:
            seed, start = carry
        else:
            seed, start = next(i for i in by_size if unused[i]), 0
            unused[seed] = False
            left -= 1
        parts, room, carry = [(int(seed), start, int(size[seed]) - start)], window - (int(size[seed]) - start), None
        if room and left:
            free = np.flatnonzero(unused)
            for i in free[np.argsort(-index.scores(seed)[free], kind="stable")]:
                unused[i] = False
                left -= 1
                take = min(room, int(size[i]))
                parts.append((int(i), 0, take))
                room -= take
                if take < size[i]:
                    carry = (int(i), take)
                if not room:
                    break
        out.append(parts)
    last = out.pop()
    return out + _powers(last, window)


def _powers(parts: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """The parts cut into sequences whose lengths are powers of two, longest first; a full window stays as it is."""
    total = sum(n for _, _, n in parts)
    sizes = [total] if total == window else [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
    out, parts = [], list(reversed(parts))
    for size in sizes:
        mine = []
        while size:
            i, start, n = parts.pop()
            take = min(n, size)
            mine.append((i, start, take))
            size -= take
            if take < n:
                parts.append((i, start + take, n - take))
        out.append(mine)
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096) -> DataFrame:
    """Pieces of the documents: where they come from, their ids (little-endian 32-bit numbers), and where they lie."""
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if top <= 1 << 16 else "<u4"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    tokens = stored(tokenized(docs, tokenizer, end_id, kind), "tokens")
    count, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(tokens, kind).toPandas()  # one row per token of the vocabulary at most
    idf = np.zeros(top)
    idf[df["id"]] = np.log1p((count - df["df"] + 0.5) / (df["df"] + 0.5))
    known = tokens.sparkSession.sparkContext.broadcast((idf, total / max(count, 1)))
    width = np.dtype(kind).itemsize

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, n, raw in zip(*(batch.column(i) for i in range(4)), strict=True):
                ids = np.frombuffer(raw.as_py(), kind).astype("<u4")
                k, row = len(ids) // window, row.as_py()
                yield table(
                    doc_id=pa.array([doc_id.as_py()] * k, pa.int64()), start=np.arange(k) * window, length=np.full(k, window),
                    ids=pa.array([ids[i * window : (i + 1) * window].tobytes() for i in range(k)], pa.binary()),
                    doc_tokens=np.full(k, n.as_py()), sequence_id=-1 - ((row << 18) + np.arange(k)), offset=np.zeros(k, np.int64),
                )

    def shard(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n", "descending"), ("row", "ascending")])
        ids = [np.frombuffer(x.as_py(), kind) for x in rows.column("ids")]
        doc, n, base = (rows.column(c).to_pylist() for c in ("doc_id", "n", "start"))
        first = rows.column("shard")[0].as_py() << 24
        cols: dict[str, list] = {c.split()[0]: [] for c in PIECE.split(", ")}
        for s, parts in enumerate(fill(ids, *known.value, window)):
            at = 0
            for i, start, length in parts:
                piece = ids[i][start : start + length].astype("<u4").tobytes()
                for c, v in zip(cols, (doc[i], base[i] + start, length, piece, n[i], first + s, at), strict=True):
                    cols[c].append(v)
                at += length
        return pa.table({c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in cols.items()})

    cut = tokens.where(F.col("n") >= window).select("row", "doc_id", "n", "ids").mapInArrow(whole, PIECE)
    done = F.floor(F.col("n") / window) * window
    rest = tokens.where(F.col("n") % window > 0).select(
        "row", "doc_id", "lang", "n", done.cast("long").alias("start"),
        F.expr(f"substring(ids, int(n div {window} * {window * width}) + 1)").alias("ids"),
    )
    sizes = dict(rest.groupBy("lang").count().collect())  # one row per language
    langs = {x: i for i, x in enumerate(sorted(sizes))}
    rare = np.full(top, 0)
    rare[df["id"]] = df["df"]
    rare = tokens.sparkSession.sparkContext.broadcast(rarity(rare))

    def stand(batch: pa.RecordBatch) -> list[bytes]:
        columns = (batch.column(c).to_pylist() for c in ("lang", "row"))
        return [place(langs[x], row, np.frombuffer(raw.as_py(), kind), rare.value) for x, row, raw in zip(*columns, batch.column("ids"), strict=True)]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield table(place=pa.array(stand(batch), pa.binary()))

    places = stored(rest.select("lang", "row", "ids").mapInArrow(find, "place binary"), "unordered")
    starts = tokens.sparkSession.sparkContext.broadcast(shard_starts(places, [sizes[x] for x in langs]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(starts.value, np.array(stand(batch), starts.value.dtype), side="right") - 1
            yield table(shard=at, **{c: batch.column(c) for c in ("row", "doc_id", "n", "start", "ids")})

    dealt = rest.mapInArrow(deal, "shard long, row long, doc_id long, n long, start long, ids binary")
    packed = dealt.groupBy("shard").applyInArrow(shard, PIECE)
    return cut.unionByName(packed)
