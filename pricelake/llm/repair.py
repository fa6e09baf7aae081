"""Repair of damaged conversations by a Viterbi search whose survivors coalesce.

The roles' initials of a repaired conversation read ``(s?(ua)+)?``. States: nothing yet (0), after the system message (1), after a user's (2), after an
assistant's (3); 0 and 3 may end. Edits: Keep (K, 0), Rerole to user or assistant (R, 2), Delete (D, 3), Insert an empty message (I, 2); a row
that stays although it is truncated adds 1; blank and duplicate rows can't stay. Of the cheapest sequences of edits the one least in
ASCII is taken.

Each state has one survivor, the best way to it. Survivors are leaves of a tree of back pointers whose nodes count their references: a node
that no survivor needs is freed, and as soon as all survivors share an ancestor, the edits up to it are final, are sent on and freed. So memory
holds the unresolved rows only, not the conversation. A survivor that another one beats in whatever follows is dropped, which also
bounds the costs' differences. Ties go by the whole unresolved suffixes. Right after a row's edit no survivor's edits are a prefix of another's
(both end in an edit of the same row), so the order of two suffixes is that of their parents, or of the last letters if they share the parent: it is
kept as a rank, and no suffix is read again.

Rows meet sorted by (conversation, turn) and stream through; a conversation is judged in one pass, since its digest (a SHA-256) is one
sequence too. What a row needs to know of all earlier ones, whether its role and text were seen, is a grouped aggregate joined back by Spark.

Defined cases: null roles and texts are one space; null turns come first; rows of one turn go by role and text; a null conversation id is one
conversation; repeated rows are duplicates; a conversation without rows gives none; very long texts are compared by SHA-256; extra columns are
not read, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricelake.llm.store import stored

SOLID = r"[^\x20\x09-\x0D]"
ROLES = {"u": "user", "a": "assistant"}
#: state -> (state after an inserted message, its role's initial)
INSERT = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
#: (state, initial of a row that stays) -> state
STAY = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: OVER[p][q]: what it costs at most to end as well from state p as from state q.
OVER = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))
EDITS = "conv_id long, edit_no long, edit string, turn long, role string, text string, fault string, illegal boolean, cost long"


def damage(rows: DataFrame) -> DataFrame:
    """Damage by crc32(``conv_id:turn``) % 20 (nulls: one space): 0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    rows = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), kind.alias("kind"),
    ).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy", "kind")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault): each row's first fault, ``blank``, ``duplicate``, ``truncated`` or null, but for equal rows of one turn."""
    space = F.lit(" ")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    digest = F.sha2(F.col("text"), 256)
    place = F.coalesce("turn", F.lit(-(1 << 63)))  # null turns come first
    keyed = rows.withColumns({"_sha": digest, "_at": place})
    seen = keyed.groupBy("conv_id", "role", "_sha").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    seen = seen.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_sha").alias("_s"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_sha") == F.col("_s"))
    keyed = keyed.join(seen, same, "left")
    blank = ~F.rlike("text", F.lit(SOLID))
    open_end = ~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    fault = F.when(blank, "blank").when(F.col("_first") < F.col("_at"), "duplicate").when(open_end, "truncated")
    return keyed.select("conv_id", "turn", "role", "text", fault.alias("fault"))


class _Node:
    """An edit in the tree of back pointers: ``refs`` counts its children and the survivors that end in it."""

    __slots__ = ("parent", "edit", "row", "role", "cost", "refs")

    def __init__(self, parent, edit, row, role, cost):
        self.parent, self.edit, self.row, self.role, self.cost, self.refs = parent, edit, row, role, cost, 0
        if parent is not None:
            parent.refs += 1


class Viterbi:
    """Survivors of one conversation; ``push`` takes a row and gives the edits that are final by then, ``close`` the rest."""

    def __init__(self):
        root = _Node(None, "", None, None, 0)
        root.refs = 2  # a survivor, and being the root
        self.root = root
        self.best: dict[int, tuple[int, int, _Node]] = {0: (0, 0, root)}  # state -> (cost, rank, node)
        self.live = 1

    def _ways(self):
        """(state, cost, rank, node, inserted initials): survivors and what they become by inserted messages."""
        for state, (cost, rank, node) in self.best.items():
            initials = ""
            for _ in range(3):
                yield state, cost, rank, node, initials
                state, initial = INSERT[state]
                cost, initials = cost + 2, initials + initial

    def _choose(self, found: dict[int, tuple], state: int, cost: int, rank: int, letters: str, *made) -> None:
        """Keep the cheaper way to a state; ties: the least letters, the parent's before the own ones."""
        new = (cost, rank, letters)
        if state not in found or new < found[state][0]:
            found[state] = (new, *made)

    def push(self, row: tuple, role: str, fault: str | None) -> Iterator[_Node]:
        """``row`` is handed back with its edit."""
        found: dict[int, tuple] = {}
        late = 1 if fault == "truncated" else 0
        for state, cost, rank, node, initials in self._ways():
            letters = "I" * len(initials)
            self._choose(found, state, cost + 3, rank, letters + "D", node, initials, None, 3)
            if fault in ("blank", "duplicate"):
                continue
            to = STAY.get((state, role[:1]))
            if to is not None:
                self._choose(found, to, cost + late, rank, letters + "K", node, initials, role, late)
            to, other = (3, "a") if state == 2 else (2, "u")
            self._choose(found, to, cost + 2 + late, rank, letters + "R", node, initials, ROLES[other], 2 + late)
        beaten = {q for q, (new, *_) in found.items() if any(new[0] > c[0] + OVER[p][q] for p, (c, *_) in found.items())}
        order = sorted((q for q in found if q not in beaten), key=lambda q: found[q][0][1:])
        best = {}
        for rank, q in enumerate(order):
            (cost, _, letters), node, initials, role, own = found[q]
            for x in initials:
                node = self._node(node, "I", None, ROLES[x], 2)
            node = self._node(node, letters[-1], row, role, own)
            best[q] = (cost, rank, node)
        yield from self._replace(best)

    def _node(self, *made) -> _Node:
        self.live += 1
        return _Node(*made)

    def _replace(self, best: dict) -> Iterator[_Node]:
        for _, _, node in best.values():
            node.refs += 1
        for _, _, node in self.best.values():
            self._release(node)
        self.best = best
        yield from self._final()

    def _release(self, node: _Node) -> None:
        node.refs -= 1
        while node.refs == 0:
            self.live -= 1
            node = node.parent
            node.refs -= 1

    def _shared(self) -> bool:
        """Whether all survivors come from one child of the root, which counts itself as one reference."""
        return self.root.refs == 2 and all(node is not self.root for _, _, node in self.best.values())

    def _final(self) -> Iterator[_Node]:
        """Edits that all survivors share: their nodes become the root in turn."""
        if not self._shared():
            return
        for node in self._path(next(iter(self.best.values()))[2]):
            node.parent = None
            node.refs += 1
            self.live -= 1
            self.root = node
            yield node
            if not self._shared():
                return

    def _path(self, node: _Node) -> list[_Node]:
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]

    def close(self) -> Iterator[_Node]:
        ends = []
        for state, cost, rank, node, initials in self._ways():
            if state in (0, 3):
                ends.append((cost, rank, "I" * len(initials), state, node, initials))
        _, _, _, state, node, initials = min(ends, key=lambda e: e[:4])
        for x in initials:
            node = self._node(node, "I", None, ROLES[x], 2)
        yield from self._path(node)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of rows that come sorted by conversation and place."""
    names = [c.split()[0] for c in EDITS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64()]
    out: list[list] = [[] for _ in names]
    held = [0]

    def put(conv: int | None, number: int, nodes: Iterator[_Node]) -> int:
        for node in nodes:
            turn, text, fault, illegal = node.row or (None, "", None, None)
            for column, value in zip(out, (conv, number, node.edit, turn, node.role, text, fault, illegal, node.cost), strict=True):
                column.append(value)
            held[0] += 64 + 4 * len(text)
            number += 1
        return number

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
        for c in out:
            c.clear()
        held[0] = 0
        return batch

    conv, search, number, last = None, None, 0, None
    for batch in batches:
        for now, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if search is None or now != conv:
                if search is not None:
                    put(conv, number, search.close())
                conv, search, number, last = now, Viterbi(), 0, None
            if fault != "blank" and last == (turn, role, text):
                fault = "duplicate"
            initial = role[:1]
            illegal = last is not None and last[1][:1] + initial not in ("su", "ua", "au")
            last = (turn, role, text)
            number = put(conv, number, search.push((turn, text, fault, illegal), role, fault))
            if held[0] > 1 << 22:
                yield flush()
    if search is not None:
        put(conv, number, search.close())
    yield flush()


def repair(rows: DataFrame) -> DataFrame:
    """One row per edit: (conv_id, edit_no, edit, turn, role, text, fault, illegal, cost).

    ``role`` is that of the message after the edit, null for a deleted one; ``illegal`` says of a row whether its role may not follow that of the row
    before it. Rows are sorted by (conv_id, edit_no) inside each partition, and a conversation is in one partition.
    """
    typed = stored(faults(rows), "faults")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return typed.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_streamed, EDITS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a stream of its edits."""
    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    done: list[tuple] = []
    conv, counts, audit, sha, lines = None, None, [], None, 0

    def close() -> None:
        done.append((conv, *counts, "".join(audit), sha.hexdigest()))

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text", "fault", "illegal", "cost"))
        for now, edit, role, text, fault, illegal, cost in zip(*columns, strict=True):
            if counts is None or now != conv:
                if counts is not None:
                    close()
                conv, counts, audit, sha, lines = now, [0] * 5, [], hashlib.sha256(), 0
            if fault:
                counts[("blank", "duplicate", "truncated").index(fault)] += 1
            counts[3] += bool(illegal)
            counts[4] += cost
            audit.append(edit)
            if edit != "D":
                sha.update(("\n" if lines else "").encode() + f"{role}:{text}".encode())
                lines += 1
        if len(done) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds, strict=True)], names)
            done.clear()
    if counts is not None:
        close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds, strict=True)], names)


def turn_gaps(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps): turns that are missing between a conversation's first and last one; null turns don't count."""
    turns = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("_n")).groupBy("conv_id")
    found = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    return found.select("conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))


def report(rows: DataFrame, edits: DataFrame, all_ids: DataFrame) -> DataFrame:
    """One row per id of ``all_ids`` (conv_id): faults of ``rows``, cost, audit (the edits' letters) and SHA-256 of the repaired ``role:text`` lines."""
    found = edits.mapInArrow(_digests, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = all_ids.select("conv_id").distinct()
    out = _left(_left(ids, turn_gaps(rows)), found)
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers]
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


def _left(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnRenamed("conv_id", "_id")
    same: Column = F.col("conv_id").eqNullSafe(F.col("_id"))
    return left.join(right, same, "left").drop("_id")
