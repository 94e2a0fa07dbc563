"""Repair of the turn structure of conversations by a Viterbi search that emits edits early.

A conversation's rows in order of turn (nulls first; ties by role, then text) are edited until the first
letters of their roles read ``(s?(ua)+)?``. Keep costs 0, Rerole to user or assistant 1, Delete 2,
Insert of an empty user or assistant turn 5; a truncated row that stays costs 5 more. Blank rows and
repeats of a role and text seen earlier must go. Of the cheapest edits the ASCII-least string of
initials is taken; it tells all edits, as the number of turns that stay says each one's role.

The search has four states: nothing yet, after the system turn, after a user, after an assistant. What
leads to the best way into each (its survivor) is a tree of backpointers whose nodes hold a run of
initials and count what refers to them. A node that nothing refers to goes, one that a single node refers to
is merged with it, and what all survivors share stands in the root and is emitted. So memory holds
the unresolved suffixes only, one byte for an edit; equally cheap ways are compared by their
whole unresolved suffixes. A survivor that another one beats whatever comes is dropped, or the way
that deletes all would keep everything unresolved. Texts are not held: every survivor carries the digest of
its repaired turns; only ``repaired_turns``, which returns texts, holds those of unresolved rows.

Spark brings a conversation's rows to one task, finds repeats by a sorted window and sorts by turn;
both spill. The task reads them as a stream. A digest of a conversation can only be computed
in order, so a conversation of very many rows is one stream, whose memory does not grow with it.

Null roles and texts are one space; roles that are empty or begin with another letter can't be kept as they
are. Rows without conv_id are one conversation. A conversation all of whose rows are marked as gone has
no faults and no edits. Repeated rows are duplicates. An empty table gives an empty one. Further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lines import BLANKS

NONE, SYSTEM, USER, ASSISTANT = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
INFINITE = float("inf")
#: State after a kept row, by state and initial.
KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: State after a user or assistant turn that is rerolled or inserted.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}


class Node:
    """A run of initials; ``kids`` are the nodes that refer to it."""

    __slots__ = ("up", "letters", "kids")

    def __init__(self, up: Node | None, letters: bytes = b""):
        self.up, self.letters, self.kids = up, bytearray(letters), []


class Search:
    """The edits of one conversation, row by row. ``emit`` gets initials as soon as all survivors share them."""

    def __init__(self, emit):
        self.emit = emit
        self.root = Node(None)
        self.cost = [0, INFINITE, INFINITE, INFINITE]
        self.leaf: list[Node | None] = [self.root, None, None, None]
        self.digest = [hashlib.sha256(), None, None, None]
        self._advance([(0, NONE, b""), None, None, None], "", "")

    def row(self, role: str, text: str | None, fault: int) -> None:
        """``text`` may be None where the row must go."""
        new: list[tuple | None] = [None] * 4
        first = role[:1]
        more = CUT if fault == TRUNCATED else 0
        for q in range(4):
            cost = self.cost[q]
            if cost == INFINITE:
                continue
            self._offer(new, q, cost + DELETE, q, b"D")
            if fault == BLANK or fault == DUPLICATE:
                continue
            to = KEPT.get((q, first))
            if to is not None:
                self._offer(new, to, cost + more, q, b"K")
            self._offer(new, NEXT[q], cost + more + REROLE, q, b"R")
        self._advance(new, role, text)

    def _offer(self, new: list, to: int, cost: float, q: int, letters: bytes) -> bool:
        old = new[to]
        if old is None or cost < old[0] or (cost == old[0] and self._less(q, letters, old[1], old[2])):
            new[to] = (cost, q, letters)
            return True
        return False

    def _less(self, p: int, x: bytes, q: int, y: bytes) -> bool:
        """Whether the suffix of survivor p with x behind it comes before that of q with y."""
        if p == q:
            return x < y
        a, b = self._path(self.leaf[p]), self._path(self.leaf[q])
        k = next(i for i in range(min(len(a), len(b))) if a[i] is not b[i])
        one, other = a[k].letters, b[k].letters
        if one.startswith(other) or other.startswith(one):
            one = b"".join([*(n.letters for n in a[k:]), x])
            other = b"".join([*(n.letters for n in b[k:]), y])
        return one < other

    @staticmethod
    def _path(node: Node) -> list[Node]:
        out = []
        while node is not None:
            out.append(node)
            node = node.up
        return out[::-1]

    def _advance(self, new: list, role: str, text: str | None) -> None:
        for _ in range(2):  # two turns in a row may be inserted; three never pay
            for q in range(4):
                if new[q] is not None:
                    self._offer(new, NEXT[q], new[q][0] + INSERT, new[q][1], new[q][2] + b"I")
        # whoever stands behind an assistant's turn can go on like one behind the system's, or, deleting its row, like one at the start
        best = new[ASSISTANT][0] if new[ASSISTANT] else INFINITE
        for q, more in ((SYSTEM, 0), (NONE, DELETE)):
            if new[q] is not None and best + more < new[q][0]:
                new[q] = None
        self._digests(new, role, text)
        ways: list[list[tuple[int, bytes]]] = [[] for _ in range(4)]
        for to, one in enumerate(new):
            if one is not None:
                ways[one[1]].append((to, one[2]))
        for p in range(4):
            if self.leaf[p] is not None and not ways[p]:
                self._release(p)
        leaf: list[Node | None] = [None] * 4
        for p in range(4):
            node = self.leaf[p]
            if len(ways[p]) == 1:
                node.letters += ways[p][0][1]
                leaf[ways[p][0][0]] = node
            else:
                for to, letters in ways[p]:
                    leaf[to] = Node(node, letters)
                    node.kids.append(leaf[to])
        self.leaf = leaf
        self.cost = [INFINITE if one is None else one[0] for one in new]
        if self.root.letters:
            self.emit(bytes(self.root.letters))
            self.root.letters.clear()

    def _release(self, p: int) -> None:
        node, self.leaf[p] = self.leaf[p], None
        up = node.up
        if up is None:
            return
        up.kids.remove(node)
        if len(up.kids) == 1:  # one reference: both become one node
            kid = up.kids[0]
            up.letters += kid.letters
            up.kids = kid.kids
            for k in kid.kids:
                k.up = up
            for q in range(4):
                if self.leaf[q] is kid:
                    self.leaf[q] = up

    def _digests(self, new: list, role: str, text: str | None) -> None:
        digest = [None] * 4
        for to, one in enumerate(new):
            if one is None:
                continue
            state, out = one[1], []
            for letter in one[2]:
                if letter == 68:  # D
                    continue
                before = state
                state = KEPT[state, role[:1]] if letter == 75 else NEXT[state]
                turn = f"{role}:{text}" if letter == 75 else f"{ROLE[state]}:{text if letter == 82 else ''}"
                out.append(turn if before == NONE else "\n" + turn)
            digest[to] = self.digest[one[1]].copy()
            if out:
                digest[to].update("".join(out).encode())
        self.digest = digest

    def end(self) -> tuple[int, str]:
        """(cost, digest of the repaired turns); emits the rest."""
        last = [q for q in (NONE, ASSISTANT) if self.leaf[q] is not None]
        q = last[0]
        if len(last) == 2 and (self.cost[last[1]] < self.cost[q] or (self.cost[last[1]] == self.cost[q] and self._less(last[1], b"", q, b""))):
            q = last[1]
        self.emit(b"".join(n.letters for n in self._path(self.leaf[q])))
        return int(self.cost[q]), self.digest[q].hexdigest()


class Conversation:
    """Figures of one conversation from its rows in order."""

    def __init__(self, turns: list | None = None):
        self.audit = bytearray()
        self.search = Search(self._emitted)
        self.faults = [0, 0, 0, 0]
        self.illegal = self.different = 0
        self.low = self.high = self.before = None
        #: unresolved rows, and repaired turns: (edit, role, text)
        self.rows: deque | None = None if turns is None else deque()
        self.turns, self.state = turns, NONE

    def row(self, turn: int | None, role: str, text: str | None, fault: int) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.different += 1
                self.high = turn
        first = role[:1]
        if self.before is not None and self.before + first not in LEGAL:
            self.illegal += 1
        self.before = first
        self.faults[fault] += 1
        if self.rows is not None:
            self.rows.append((role, text))
        self.search.row(role, text, fault)

    def _emitted(self, letters: bytes) -> None:
        if self.rows is None:
            self.audit += letters
            return
        for letter in letters.decode():
            role, text = self.rows.popleft() if letter != "I" else ("", "")
            if letter != "D":
                self.state = KEPT[self.state, role[:1]] if letter == "K" else NEXT[self.state]
                self.turns.append((letter, role if letter == "K" else ROLE[self.state], text))

    def end(self) -> dict:
        cost, digest = self.search.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.different
        return {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED], "illegal": self.illegal,
                "cost": cost, "audit": self.audit.decode(), "repaired_sha256": digest}


def ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, fault, gone; a conversation's rows are in one partition, in order. ``gone`` (boolean), where there is one, marks rows that only name their conversation."""
    gone = F.coalesce("gone", F.lit(False)) if "gone" in rows.columns else F.lit(False)
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), gone.alias("gone"))
    rows = rows.repartition("conv_id").withColumn("hash", F.xxhash64("text"))
    same = Window.partitionBy("conv_id", "gone", "role", "hash", "text").orderBy(F.col("turn").asc_nulls_first())
    ends = F.btrim("text", F.lit(BLANKS))
    fault = (
        F.when(ends == "", BLANK).when(F.row_number().over(same) > 1, DUPLICATE).when(~F.right(ends, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    )
    rows = rows.withColumn("fault", fault)
    return rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", "turn", "role", "text", "fault", "gone")


def _conversations(batches, texts: bool):
    """(conv_id, Conversation, whether it ended) from sorted rows; with ``texts``, also whenever a batch ends."""
    now, at = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "gone")]
        for conv, turn, role, text, fault, gone in zip(*columns):
            if now is None or conv != at:
                if now is not None:
                    yield at, now, True
                now, at = Conversation([] if texts else None), conv
            if not gone:
                now.row(turn, role, text, fault)
        if texts and now is not None:
            yield at, now, False
    if now is not None:
        yield at, now, True


FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, its faults, the cost, the edits (``audit``) and the SHA-256 of the repaired ``role:text`` lines."""
    rows = ordered(rows)
    names = [x.split()[0] for x in FIGURES.split(", ")]

    def run(batches):
        convs, figures = [], []

        def flush():
            texts = {"audit", "repaired_sha256"}
            return pa.RecordBatch.from_arrays([pa.array(convs, kind), *(pa.array([f[n] for f in figures], pa.string() if n in texts else pa.int64()) for n in names)], names=["conv_id", *names])

        kind = None

        def watched():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        for conv, one, _ in _conversations(watched(), False):
            convs.append(conv), figures.append(one.end())
            if len(convs) == 4000:
                yield flush()
                convs, figures = [], []
        if convs:
            yield flush()

    lean = rows.withColumn("text", F.when(~F.col("fault").isin(BLANK, DUPLICATE), F.col("text")))
    return lean.mapInArrow(run, f"conv_id {dict(rows.dtypes)['conv_id']}, {FIGURES}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role, text of every turn after the repair."""
    rows = ordered(rows)

    def run(batches):
        kind = None

        def watched():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        place = 0
        for conv, one, over in _conversations(watched(), True):
            if over:
                one.end()
            n = len(one.turns)
            if n:
                edits, roles, texts = zip(*one.turns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * n, kind), pa.array(range(place, place + n), pa.int64()), pa.array(edits), pa.array(roles), pa.array(texts)], names=["conv_id", "place", "edit", "role", "text"]
                )
                one.turns.clear()
            place = 0 if over else place + n

    return rows.mapInArrow(run, f"conv_id {dict(rows.dtypes)['conv_id']}, place long, edit string, role string, text string")


def damaged(rows: DataFrame) -> DataFrame:
    """The damage on which the repair is tried: by crc32 of ``conv_id:turn`` modulo 20, 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
