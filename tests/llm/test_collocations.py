"""Quotient filters and phrases against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwatch.llm import collocations, quotient
from tillwatch.llm.collocations import Sizes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least: int, top: int = 2000, cover: int = 100, longest: int = 5) -> list[tuple]:
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, *w[i : i + m]) for i in range(len(w) - m + 1))
    often = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = []
    for g, a in often.items():
        lang, words = g[0], g[1:]
        if any(h[0] == lang and len(h) > len(g) and 100 * b >= cover * a and any(h[1 + i : 1 + i + len(words)] == words for i in range(len(h) - len(words))) for h, b in often.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang], score))
    ranked = []
    for lang in sorted({r[0] for r in out}):
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(own, 1)]
    return sorted(ranked)


def run(docs, least: int, **more) -> list[tuple]:
    return sorted(tuple(r) for r in collocations.collocations(docs, least, **more).collect())


def test_permutation_and_filters():
    rng = np.random.default_rng(1)
    for bits in range(1, 65):
        keys = np.unique(rng.integers(0, 1 << min(bits, 62), 300, dtype=np.uint64))
        if bits == 64:
            keys = np.append(keys, np.array([2**63, 2**64 - 1], dtype=np.uint64))
        values = quotient.permuted(keys, bits)
        assert len(np.unique(values)) == len(keys) and (quotient.restored(values, bits) == keys).all()
        if bits <= 8:
            assert sorted(quotient.permuted(np.arange(1 << bits, dtype=np.uint64), bits).tolist()) == list(range(1 << bits))
        values = np.sort(values)
        counts = rng.integers(1, 700, len(values))
        assert [x.tolist() for x in quotient.unpacked(quotient.packed(values, counts, bits))[:2]] == [values.tolist(), counts.tolist()]
    values, counts, bits = quotient.unpacked(quotient.packed(np.zeros(0, np.uint64), np.zeros(0, np.int64), 40))
    assert not len(values) and not len(counts) and bits == 40
    dense = np.sort(rng.choice(1 << 40, 4096, replace=False).astype(np.uint64))
    assert len(quotient.packed(dense, np.ones(4096, np.int64), 40)) < 4.0 * 4096


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), max_size=80), max_size=5))
def test_merge(lists):
    parts = [quotient.counted(quotient.permuted(np.array(x, dtype=np.uint64), 6)) for x in lists]
    values, counts = quotient.merged([quotient.unpacked(quotient.packed(v, c, 6))[:2] for v, c in parts])
    assert dict(zip(quotient.restored(values, 6).tolist(), counts.tolist())) == Counter(x for part in lists for x in part)
    assert values.tolist() == sorted(values.tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1) | st.integers(0, 300)))
def test_short_numbers(values):
    assert collocations.long_numbers(collocations.short_numbers(np.array(values, dtype=np.uint64))).tolist() == values


@pytest.mark.parametrize("sizes", [Sizes(), Sizes(shard=20_000, part=50, row=16, block=3000)])
def test_given_documents(spark, sizes):
    """Many small shards, rows and blocks give what one large one does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    want = brute(rows, 12, top=150)
    assert run(docs, 12, top=150, sizes=sizes) == want and len({r[0] for r in want}) >= 2 and max(r[1] for r in want) == 150


def test_edges(spark):
    odd = [(None, None, None), (1, "", "en"), (2, "New York, new YORK new\tyork. a b", None), (2, "New York, new YORK new\tyork. a b", None), (3, "É é É é É é", "fr"), (4, "x " * 30_000, "en"), (5, "one two three four five six " * 4, "en"),
           (6, "one two three four five six\none  two three four five six", "en"), (7, "york new york new york", "und"), (8, "    \x1f \x1f   \x1f", "en"), (9, "." * 1000 + "w" * 100_000, "en")]
    docs = spark.createDataFrame(odd, SCHEMA).withColumns({c: F.lit(0) for c in ("kind", "shard", "part", "seq", "word", "local", "n", "rank", "a", "key", "id")})
    want = brute([(t, g) for _, t, g in odd], 2)
    assert run(docs, 2) == want and any(r[2] == "one two three four five" for r in want)
    assert run(docs, 2, cover=40) == brute([(t, g) for _, t, g in odd], 2, cover=40)
    assert run(docs, 2, longest=3) == brute([(t, g) for _, t, g in odd], 2, longest=3)
    assert run(docs, 10**6) == [] and run(docs.limit(0), 1) == [] and run(docs.where("doc_id = 1"), 1) == []


def test_hot_language_and_phrase(spark):
    """One language and one phrase hold most of all words; counts pass what a byte of a filter holds."""
    spread = random.Random(2)
    rows = [(i, " ".join(spread.choice(["very common words", f"w{spread.randint(0, 9)}"]) for _ in range(60)) + spread.choice([".", "!", ""]), "en" if i % 10 else "de") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert run(docs, 100, sizes=Sizes(shard=3000, part=40, row=8, block=500)) == brute([(t, g) for _, t, g in rows], 100)
