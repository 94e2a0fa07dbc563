"""Shared lines against brute force: whole rows, ranges cut anywhere, and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwatch.llm import lines, queries

SF = "/root/testdata/sf0.001"


def python_key(line: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, hash) of every (doc_id, text)."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(python_key(line)) >= 20:
                holders[python_key(line)].add(i)
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        keep = [x for x in every if not (len(h := holders.get(python_key(x), ())) >= 3 and i != max(h, key=lambda d: -1 if d is None else d))]
        out.append((str(i), len(every), len(every) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def run(docs):
    rows = lines.keep_bitmaps(docs)
    got = rows.select("doc_id", "n_lines", "n_dropped", F.sha2(lines.kept_text(F.col("text"), F.col("keep")), 256).alias("kept_sha256")).collect()
    return sorted((str(r[0]), *r[1:]) for r in got)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((str(r[0]), *r[1:]) for r in queries.op13_lines(spark, SF).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    assert got == brute(rows) and any(r[2] for r in got)


def test_edges(spark):
    long = "A line that many documents share, said twice"
    rows = [(None, None), (None, long), (1, ""), (1, ""), (2, f"  {long.upper()}\r\nown words of the second one\n"), (2, f"  {long.upper()}\r\nown words of the second one\n"), (3, f"{long}\n\n{long}"), (3, "another text of the same id"),
            (4, "short\nshort"), (5, "short"), (6, "short\n" + "É" * 20), (7, "É" * 20 + "\x0b"), (8, "é" * 20 + "\n" + "É" * 20), (9, "x" * 500_000 + "\n" + long + "\x1f"), (10, "\n" * 3000 + long), (11, "É" * 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("h1", "h2", "key", "line", "version", "position", "keep", "dropped", "state", "of", "as", "keeper")})
    assert run(docs) == brute(rows)
    assert run(docs.limit(0)) == []
    named = spark.createDataFrame([("b", long), ("a", long), ("c", long)], "doc_id string, text string")
    assert [(r[0], r[2]) for r in run(named)] == [("a", 1), ("b", 1), ("c", 0)]


def test_hot_line_over_many_ranges(spark):
    """A line that a third of all rows are: it lies in several ranges, and the outcome is that of brute force."""
    spread = random.Random(3)
    hot = "one very common line of all documents"
    rows = [(i, "\n".join([hot] * spread.randint(1, 3) + [f"line number {spread.randint(0, 400)} of some documents"] * spread.randint(0, 2))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert run(docs) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("seed", range(30))
def test_stream_cut_anywhere(seed):
    """What tasks say, put together, doesn't depend on where ranges and batches end."""
    spread = random.Random(seed)
    rows = {(spread.randint(0, 4), 0, spread.randint(0, 6) if spread.random() < 0.9 else -1, 0, p) for p in range(spread.randint(1, 120))}
    rows = sorted(rows, key=lambda r: (r[0], r[1], -r[2], r[3], r[4]))
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("position", pa.int32())])

    def batch(part):
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, (*r[:2], None if r[2] < 0 else r[2], *r[3:]))) for r in part], schema=schema)

    goes, waits, holds = set(), set(), defaultdict(set)
    cuts = sorted(spread.sample(range(len(rows) + 1), min(len(rows), spread.randint(0, 6))))
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        inner = sorted(spread.sample(range(a, b + 1), min(b - a, spread.randint(0, 8))))
        said = [r for out in lines._stream(3)(iter([batch(rows[x:y]) for x, y in zip([a, *inner], [*inner, b])])) for r in out.to_pylist()]
        assert len(said) <= (b - a) + 6
        for r in said:
            row = (r["h1"], r["h2"], -1 if r["doc_id"] is None else r["doc_id"], r["version"], r["position"])
            if r["state"] == lines.GOES:
                assert row not in goes
                goes.add(row)
            else:
                holds[row[0]].add(row[2])
                if r["state"] == lines.WAITS:
                    waits.add(row)
    goes |= {r for r in waits if len(holds[r[0]]) >= 3 and r[2] != max(holds[r[0]])}
    docs = defaultdict(set)
    for r in rows:
        docs[r[0]].add(r[2])
    assert goes == {r for r in rows if len(docs[r[0]]) >= 3 and r[2] != max(docs[r[0]])}
