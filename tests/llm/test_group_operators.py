"""Operators that compare rows with each other, archives and the pipeline, against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tillwatch.llm import components, embeddings, queries, secrets, simhash, toxicity, warc

SF = "/root/testdata/sf0.001"


def union(n: int, pairs) -> list[int]:
    """Smallest member of each one's group."""
    of = list(range(n))

    def top(x):
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        of[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(1)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(200)]
    loose = [tuple(p) for p in (2000 + rng.integers(0, 300, (160, 2))).tolist()]
    pairs = chain + star + loose + chain[:5] + [(5, 5)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    of = union(2300, pairs)
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    assert sorted(got) == nodes
    assert len({(of[x], got[x]) for x in nodes}) == len({of[x] for x in nodes}) == len({got[x] for x in nodes})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def python_fingerprint(text: str) -> int:
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    parts = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (900_001, ""), (900_002, " \n"), (900_002, " \n"), (900_003, "É One two"), (900_004, "é one two Ä")], "doc_id long, text string")
    docs = docs.unionByName(odd).withColumns({"fp": F.lit(1), "fingerprint": F.lit(2), "label": F.lit(3), "component_id": F.lit(4)})
    rows = docs.collect()
    fps = [python_fingerprint(r["text"] or "") for r in rows]
    of = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = {}
    for r, g in zip(rows, of):
        least[g] = min(least.get(g, math.inf), math.inf if r["doc_id"] is None else r["doc_id"])
    expected = sorted((str(r["doc_id"]), f, least[g]) for r, f, g in zip(rows, fps, of))
    got = simhash.groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"] % (1 << 64), r["component_id"]) for r in got) == expected
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == sorted(least.values())
    assert simhash.one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [4096, 100])
def test_simhash_large_bucket(spark, chunk):
    rng = np.random.default_rng(1)
    center = 0x123456789ABCDEF0
    near = {center ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(700)}
    fps = np.array(sorted(near | {int(x) for x in rng.integers(0, 2**63, 300)}), dtype=np.uint64)
    far = np.bitwise_count(fps[:, None] ^ fps[None, :])
    of = union(len(fps), zip(*np.nonzero(far <= 3)))
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r["node"]: r["label"] for r in components.components(simhash.links(rows, chunk)).collect()}
    labels = [got.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert len(set(zip(of, labels))) == len(set(of)) == len(set(labels))


@pytest.mark.parametrize("chunk", [2048, 40])
def test_embeddings(spark, chunk):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((120, 24))
    v = [*base, *(base[:60] + 0.12 * rng.standard_normal((60, 24))), *(base[0] + 0.1 * rng.standard_normal((150, 24))), *base[:10], *(3.5 * base[:10])]
    rows = [(i, [float(np.float32(x)) for x in e], i % 3) for i, e in enumerate(v)]
    odd = [(901, None, 1), (902, [0.0] * 24, 1), (903, [float("nan")] * 24, 1), (904, [1.0, None], 1), (905, [], 1), (906, [float("inf"), 1.0], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (None, [5.0, 5.0], 1), (909, [1e-40, 0.0], 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, node int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near(table, chunk=chunk, bits=6, bands=40).collect()}
    x = np.array([e for _, e, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.95
    of = union(len(x), zip(*np.nonzero(linked)))
    assert [got[i] for i in range(len(x))] == [(int(linked[i].sum()) - 1, of[i]) for i in range(len(x))]
    assert {i: got[i] for i in (901, 902, 903, 904, 905, 906)} == {i: (0, i) for i in (901, 902, 903, 904, 905, 906)}
    assert got[907] == (1, 907) == (got[908][0], got[908][1]) and got[None] == (0, None)
    assert embeddings.near(table.limit(0)).count() == 0


def test_embedding_estimates():
    """The estimate is unbiased and its bound holds; recall at the threshold is as stated."""
    rng = np.random.default_rng(3)
    x = embeddings.unit(rng.standard_normal((400, 64)))
    x = np.concatenate([x, embeddings.unit(x + 0.04 * rng.standard_normal(x.shape))])
    z = x @ embeddings.rotation(64)
    factor = np.abs(z).sum(axis=1) / 8
    estimate = z @ np.where(z > 0, 1, -1).T / 8 / factor[None, :]
    error = estimate - x @ x.T
    assert abs(error.mean()) < 0.01
    bound = embeddings.CONFIDENCE * np.sqrt((1 - factor**2) / factor**2 / 63)
    assert (np.abs(error) <= bound[None, :]).mean() > 0.999
    assert embeddings.recall() > 0.98


def test_warc(spark, tmp_path):
    html = [(1, "http://a/é", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b\r\nX: y", None), (4, "http://c", ""), (5, "http://d", "WARC/1.1\r\n\r\nx\r\n\r\n"), (7, "http://e", "y" * 200_000), (None, "http://f", "<p>é</p>"), (6, "http://g", "same"), (6, "http://g", "same")]
    pages = spark.createDataFrame(html, "page_id long, url string, html string").withColumns({"digest": F.lit(0), "last": F.lit(1), "payload": F.lit(2)})
    path = str(tmp_path / "archive")
    warc.write(pages, path)
    archive = warc.read(spark, path)
    got = sorted((tuple(r) for r in warc.pages(archive).collect()), key=str)
    last = {}
    for i, _, h in html:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    digest = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    expected = [(i, len((h or "").encode()), digest(h or ""), "response" if i == last[h or ""] else "revisit", None if i == last[h or ""] else last[h or ""]) for i, _, h in html]
    assert got == sorted(expected, key=str)
    wanted = archive.where("record_type = 'response' AND target_uri LIKE 'http://c%'")
    assert [bytes(r["payload"]) for r in wanted.collect()] == [b""]
    assert not re.search(r"\bFilter\b", str(wanted._jdf.queryExecution().executedPlan()))  # all of it is pushed down
    assert archive.where(F.col("record_type").isin("revisit")).where("payload IS NOT NULL").count() == 0
    assert warc.read(spark, path, payload=False).where("payload IS NOT NULL").count() == 0
    small = str(tmp_path / "none")
    warc.write(pages.limit(0), small)
    assert warc.read(spark, small).count() == 0


def test_large_payloads_only(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "a"), least_bytes=3)
    assert {r["page_id"]: r["refers_to"] for r in warc.pages(warc.read(spark, str(tmp_path / "a"))).collect()} == {1: None, 2: None, 3: 4, 4: None}


def test_pipeline_stages(spark):
    """Each stage does to its own input what brute force says, and keeps the rest."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_id", F.lit("x"))
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near-duplicates", "decontamination", "secrets", "packing"]

    model = toxicity.fit(docs, queries.table(spark, SF, "labels"), learn=~queries.held_out())
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    calm = stages["toxicity"](spark, docs, SF)
    assert calm.columns == columns and {r["doc_id"] for r in calm.collect()} == {i for i, s in scores.items() if s < 0.5}

    rows = docs.collect()
    fps = [python_fingerprint(r["text"]) for r in rows]
    of = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    single = stages["near-duplicates"](spark, docs, SF)
    least = {}
    for r, g in zip(rows, of):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(least.values())

    items = [r["text"] for r in queries.table(spark, SF, "benchmark").collect()]
    clean = stages["decontamination"](spark, docs, SF)
    left = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and not left & {r["doc_id"] for r in rows if any(i in r["text"] for i in items)} and len(left) > 0.9 * len(rows)

    masked = stages["secrets"](spark, docs, SF)
    assert masked.columns == columns and masked.count() == len(rows) and secrets.scan(masked)[0].count() == 0
    before = {r["doc_id"]: r["text"] for r in rows}
    for r in masked.collect():
        assert r["text"] == before[r["doc_id"]] or "[SECRET]" in r["text"]

    packed = stages["packing"](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(before)


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
