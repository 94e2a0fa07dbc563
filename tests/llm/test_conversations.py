"""Repair of conversations against a search of all edits, through damage and Spark, and its edge cases."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import conversations, queries
from tillwatch.llm.conversations import Conversation

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows: list[tuple[str, str, int]]) -> tuple:
    """(cost, edits, turns) by Dijkstra over all edit strings; rows are (role, text, fault)."""
    best, heap = None, [(0, "", 0, ())]
    while heap:
        cost, audit, k, out = heapq.heappop(heap)
        if best and cost > best[0]:
            return best
        initials = "".join(role[:1] for role, _ in out)
        if not re.fullmatch("s?(ua)*u?", initials) or len(out) > len(rows) + 3:
            continue
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, out
        if k < len(rows):
            role, text, fault = rows[k]
            heapq.heappush(heap, (cost + 2, audit + "D", k + 1, out))
            if fault in (0, 3):
                more = 5 if fault == 3 else 0
                if role:
                    heapq.heappush(heap, (cost + more, audit + "K", k + 1, (*out, (role, text))))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 1, audit + "R", k + 1, (*out, (r, text))))
        for r in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", k, (*out, (r, ""))))
    return best


def digest(turns) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def brute(rows: list[tuple]) -> dict:
    """All figures of every conversation of damaged (conv_id, turn, role, text, gone)."""
    groups = defaultdict(list)
    for conv, turn, role, text, gone in rows:
        own = groups[conv]
        if not gone:
            own.append((turn is not None, turn or 0, role, text))
    out = {}
    for conv, own in groups.items():
        own.sort()
        seen, marked = set(), []
        for _, _, role, text in own:
            body = text.strip(BLANKS)
            marked.append((role, text, 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0))
            seen.add((role, text))
        turns = [t for known, t, _, _ in own if known]
        faults = [sum(f == k for _, _, f in marked) for k in (1, 2, 3)]
        initials = [r[:1] for r, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest(marked)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults, illegal, cost, audit, digest(kept))
    return out


def figures(df) -> dict:
    return {r[0]: tuple(r[1:]) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


@pytest.mark.parametrize("seed", range(12))
def test_search(seed):
    spread = random.Random(seed)
    for _ in range(60):
        roles = ["user"] * 4 + ["assistant"] if seed % 3 == 0 else ["user", "assistant", "system", "tool", "user", "assistant", "", "sage", " "]
        rows = [(spread.choice(roles), f"text {i}", spread.choice([0, 0, 0, 1, 2, 3] if seed % 2 else [0])) for i in range(spread.randint(0, 6))]
        one, turns = Conversation(), []
        other = Conversation(turns)
        for i, row in enumerate(rows):
            one.row(i, row[0], None if row[2] in (1, 2) else row[1], row[2])
            other.row(i, *row)
        got, want = one.end(), cheapest(rows)
        other.end()
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == (*want[:2], digest(want[2]))
        assert tuple((r, t) for _, r, t in turns) == want[2]


def test_given_conversations(spark):
    rows = []
    for conv, turn, role, text in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(conv, turn, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    got = figures(queries.op11_conversations(spark, SF))
    assert got == brute(rows) and len({r[6] for r in got.values()}) > 3


def test_edges(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, 1, "user", "Why?"), (1, 3, "user", "One."), (1, 3, "user", "One."), (1, 3, "assistant", "Two"), (1, None, "system", "Be kind."), (1, 9, "assistant", "\t\x0b"),
            (2, 1, "tool", "Called."), (2, 2, "", "Empty role."), (2, 3, "usher", "Sits. \r\n"), (2, 4, "assistant", "É\x1f"), (3, 5, "assistant", "x" * 300_000 + "!"), (4, 1, "user", ""), (5, None, "user", "A."), (5, None, "assistant", "B.")]
    schema = "conv_id long, turn long, role string, text string"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit(0) for c in ("hash", "fault", "kind", "copy", "id", "audit")})
    plain = [(c, t, " " if r is None else r, " " if x is None else x, False) for c, t, r, x in rows]
    want = brute(plain)
    assert figures(conversations.repair(docs)) == want
    turns = conversations.repaired_turns(docs).collect()
    for conv, row in want.items():
        mine = sorted((r["place"], r["role"], r["text"]) for r in turns if r["conv_id"] == conv)
        assert [p for p, _, _ in mine] == list(range(len(mine))) and digest((r, t) for _, r, t in mine) == row[-1]
    # every original conversation comes back, also where all rows are dropped
    every = spark.range(400).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("A.").alias("text"))
    got = figures(conversations.repair(conversations.damaged(every)))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    gone = {i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0}
    assert len(got) == 400 and {i for i, r in got.items() if r == nothing} == gone
    assert conversations.damaged(docs).where("conv_id IS NULL").count() >= 1
    assert figures(conversations.repair(docs.limit(0))) == {} and conversations.repaired_turns(docs.limit(0)).collect() == []
    named = spark.createDataFrame([("b", 1, "user", "A."), ("a", 1, "assistant", "B.")], "conv_id string, turn int, role string, text string")
    assert set(figures(conversations.repair(named))) == {"a", "b"}


def test_memory_holds_unresolved_edits_only():
    legal = Conversation()
    for i in range(5000):
        legal.row(i, ("user", "assistant")[i % 2], "A.", 0)
        assert sum(len(n.letters) for n in legal.search.leaf if n) <= 12
    assert legal.end()["cost"] == 0 and len(legal.audit) == 5000
    # only the end tells which of two ways is right: one byte for each row and way
    users = Conversation()
    for i in range(5000):
        users.row(i, "user", "A.", 0)
    assert sum(len(n.letters) for n in users.search.leaf if n) <= 4 * 5000
    assert users.end()["cost"] == 2500 and users.audit.decode() == "KR" * 2500


def test_hot_conversation(spark):
    """A third of all rows are one conversation's; batches end within it."""
    spread = random.Random(5)
    rows = [(7, i, spread.choice(["user", "assistant"]), f"Text {spread.randint(0, 3000)}.") for i in range(3000)] + [(i % 900 + 10, i, ("user", "assistant")[i // 900 % 2], f"Text {i}.") for i in range(6000)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = figures(conversations.repair(docs))
        turns = [(r["role"], r["text"]) for r in conversations.repaired_turns(docs).where("conv_id = 7").orderBy("place").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    one, seen = Conversation(), set()
    for _, turn, role, text in rows[:3000]:
        one.row(turn, role, text, 2 if (role, text) in seen else 0)
        seen.add((role, text))
    assert got[7] == tuple(one.end().values()) and digest(turns) == got[7][-1] and len(got) == 901
