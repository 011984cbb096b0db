"""Repair of the structure of conversations by a generalised LR parse of their roles.

The rows of a conversation are read in order against the grammar

    C = "" | s P | P      P = X | P X      X = u a

of role initials. Each row may be kept, reroled or deleted, and rows may be inserted, at a cost.
All parses go on side by side in a graph-structured stack: a node is a stack top with a
link to what stands below it. Where two stacks reach the same top after the same row, only
the one of least (cost, audit) goes on, so that there is one node for each state of the
grammar at a time, whatever the length of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import small_batches

#: Costs of edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: White space: the bytes 9 to 13 and 32.
SPACES = "\t\n\x0b\x0c\r "
#: Role initials that may follow each other.
LEGAL = {"su", "ua", "au"}
#: Letters of an audit that stand in one string before they are set aside.
TAIL = 256

# The grammar's tables. States: 0 start, S after a system row, U within a pair, A at its end, P
# after pairs. A pair in A is reduced at once: X = u a goes off the stack, and P comes on
# what stood below it (on a P, P = P X, in its place).
SHIFT = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("P", "u"): "U", ("U", "a"): "A"}
ACCEPTED = ("0", "P")
NAMES = {"u": "user", "a": "assistant"}

_SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Node:
    """A stack top: its state, the node below it, and the edits that led to it. rank orders the
    audits of the nodes of a row, which are equally long."""

    __slots__ = ("state", "below", "cost", "rank", "sealed", "tail", "hasher", "any")

    def __init__(self, state, below, cost, rank, sealed, tail, hasher, any_rows):
        self.state, self.below, self.cost, self.rank = state, below, cost, rank
        self.sealed, self.tail, self.hasher, self.any = sealed, tail, hasher, any_rows

    def audit(self) -> str:
        parts, sealed = [self.tail], self.sealed
        while sealed:
            sealed, part = sealed
            parts.append(part)
        return "".join(reversed(parts))


def _shifted(node: Node, initial: str) -> tuple[str, Node | None] | None:
    """State and node below after an initial is shifted and what can be is reduced."""
    state = SHIFT.get((node.state, initial))
    if state == "A":
        base = node.below
        return "P", base.below if base.state == "P" else base
    return state and (state, node)


class Parse:
    """The graph-structured stack of one conversation."""

    def __init__(self):
        self.tops = {"0": Node("0", None, 0, 0, None, "", hashlib.sha256(), False)}
        self._inserts()

    def _settle(self, moves: list[tuple]) -> None:
        """moves: (cost, rank, letter, state, below, from, written). One node for each state."""
        best: dict[str, tuple] = {}
        for move in moves:
            held = best.get(move[3])
            if held is None or move[:3] < held[:3]:
                best[move[3]] = move
        ranks = {k: i for i, k in enumerate(sorted({m[1:3] for m in best.values()}))}
        self.tops = {s: self._grown(m, ranks[m[1:3]]) for s, m in best.items()}
        self._inserts()

    @staticmethod
    def _grown(move: tuple, rank: int) -> Node:
        cost, _, letter, state, below, node, written = move
        sealed, tail = node.sealed, node.tail + letter
        if len(tail) >= TAIL:
            sealed, tail = (sealed, tail), ""
        hasher = node.hasher
        if written is not None:
            hasher = hasher.copy()
            hasher.update((b"\n" if node.any else b"") + written)
        return Node(state, below, cost, rank, sealed, tail, hasher, node.any or written is not None)

    def _inserts(self) -> None:
        """Inserted rows reach states that no other edits reach as cheaply. At these costs none
        is in a cheapest repair: to delete the row that it would complete is cheaper."""
        while True:
            for node in sorted(self.tops.values(), key=lambda n: (n.cost, n.rank)):
                found = [(i, *to) for i in NAMES if (to := _shifted(node, i))]
                found = [(i, s, b) for i, s, b in found if s not in self.tops or self.tops[s].cost > node.cost + INSERT]
                if found:
                    i, s, b = found[0]
                    self.tops[s] = self._grown((node.cost + INSERT, 0, "I", s, b, node, f"{NAMES[i]}:".encode()), node.rank)
                    break
            else:
                return

    def delete(self, n: int = 1) -> None:
        for _ in range(n):
            self._settle([(t.cost + DELETE, t.rank, "D", s, t.below, t, None) for s, t in self.tops.items()])

    def read(self, role: str, text: str, truncated: bool) -> None:
        more, moves = TRUNCATED * truncated, []
        written = {i: f"{name}:{text}".encode() for i, name in NAMES.items()}
        own = f"{role}:{text}".encode()
        for state, top in self.tops.items():
            moves.append((top.cost + DELETE, top.rank, "D", state, top.below, top, None))
            if to := _shifted(top, role[:1]):
                moves.append((top.cost + KEEP + more, top.rank, "K", *to, top, own))
            for i, line in written.items():
                if to := _shifted(top, i):
                    moves.append((top.cost + REROLE + more, top.rank, "R", *to, top, line))
        self._settle(moves)

    def best(self) -> Node:
        return min((self.tops[s] for s in ACCEPTED if s in self.tops), key=lambda n: (n.cost, n.rank))


class Conversation:
    """A conversation's parse and counts."""

    def __init__(self, conv_id):
        self.conv_id, self.parse, self.last = conv_id, Parse(), None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.least, self.most = 0, None, None

    def add(self, turn, role: str, text: str, n: int, seen: bool, blank: bool, truncated: bool) -> None:
        """n equal rows, which the order of rows puts together."""
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        if self.last is not None:
            self.illegal += self.last + role[:1] not in LEGAL
        self.illegal += n - 1
        self.last = role[:1]
        if blank:
            self.blank += n
            self.parse.delete(n)
            return
        self.duplicate += n - 1 + seen
        if seen:
            self.parse.delete(n)
            return
        self.truncated += truncated
        self.parse.read(role, text, truncated)
        self.parse.delete(n - 1)

    def row(self) -> tuple:
        best = self.parse.best()
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost, best.audit(), best.hasher.hexdigest()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation -> a row for each conversation."""
    names = [c.split()[0] for c in _SUMMARY.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    now: Conversation | None = None
    for batch in batches:
        done = []
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now:
                    done.append(now.row())
                now = Conversation(conv_id)
            if row[3]:
                now.add(*row)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(now.row(), kinds, strict=True)], names=names)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: each row of a table of conversations, with the fault
    that the crc32 of `conv_id:turn` gives it. A dropped row has 0 copies, a repeated one 2.
    Nulls stand as one space, but a null turn stays null."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row for each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 (of the repaired rows as `role:text`, one a line).

    rows: conv_id long, turn long, role string, text string, and perhaps copies (how many times
    the row stands there; 0 keeps its conv_id alone); other columns are left out. A
    conversation's rows go by turn, nulls first, and those of one turn by role and text. Null
    roles and texts count as one space; null conv_ids are one conversation. An empty table
    gives an empty result. A conversation without rows has zeros, an empty audit and the hash
    of nothing.

    Copies of a row are counted before any shuffle. A conversation is read by one task, row by
    row, as its hash is a sequence; the task holds a node for each state of the grammar and the
    audit, but no rows.
    """
    small_batches(rows.sparkSession)
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), copies.cast("long").alias("copies"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("conv_id", "role", "text").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    end = F.rtrim("text", F.lit(SPACES))
    placed = counted.repartition("conv_id").withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)) > 0)
    placed = placed.select("conv_id", "turn", "role", "text", "n", "seen", (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"))
    return placed.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_parsed, _SUMMARY)
