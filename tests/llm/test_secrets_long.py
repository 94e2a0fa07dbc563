"""Secrets in very long texts, the form of private keys, and the ledger as a table."""

from __future__ import annotations

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import queries, secrets

SF = "/root/testdata/sf0.001"
KEY = re.compile("-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
N = 1_000_000
LONG = [
    "-----BEGIN " + "AB " * (N // 3) + "PRIVATE KEY-----",
    "-----BEGIN " + "A" * N + " PRIVATE KEY-----",
    "-----BEGIN " + " " * N + "PRIVATE KEY-----",
    "-----BEGIN " + "PRIVATE KEY " * (N // 12) + "x",
    "-----BEGIN " * (N // 11),
    "password" + " " * N + "= abcdefgh",
    "password=" + "a" * N,
    "token:" * (N // 6),
    "AKIA" + "A" * N,
    "AKIA" * (N // 4),
    "0123456789abcdef" * (N // 16),
    "ghp_" + "x" * N,
    "ghp_" * (N // 4),
]


def kinds(found, docs):
    return {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.paths(docs, found).collect()}


def test_texts_of_a_million_letters(spark):
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string").repartition(4)
    got = kinds(secrets.scan(docs)[0], docs)
    assert [s[3] for s in got[0]] == ["private"] and got[0][0][::2] == (0, len(LONG[0]))
    assert [s[3] for s in got[1]] == ["private"] and not got[2] and not got[3] and not got[4]
    assert [s[3] for s in got[5]] == ["assign"] and got[6][0][::2] == (0, len(LONG[6]))
    assert [s[3] for s in got[8]] == ["access"] and got[8][0][2] == N + 4 and [s[3] for s in got[9]] == ["access"]
    assert [s[3] for s in got[10]] == ["hex"] and [s[3] for s in got[11]] == ["github"] and not got[12]
    cleaned = {r["doc_id"]: r["text"] for r in secrets.redact(docs, secrets.scan(docs)[0]).collect()}
    assert cleaned[0] == cleaned[6] == "[SECRET]" and cleaned[2] == LONG[2]


def test_many_secrets_in_a_text(spark):
    text = " ".join(f"AKIA{i:016d} deadbeef{i:024d}" for i in range(5000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = kinds(secrets.scan(docs)[0], docs)[1]
    assert len(got) == 10_000 and got == sorted(got) and text[got[-1][0] : got[-1][2]] == f"deadbeef{4999:024d}"


def test_private_keys_without_recursion(spark):
    spread = random.Random(4)
    parts = ["-----BEGIN ", "PRIVATE KEY-----", "RSA ", "EC", " ", "PRIVATE ", "KEY", "-----", "x", "PRIVATE KEY"]
    texts = ["".join(spread.choice(parts) for _ in range(spread.randint(1, 12))) for _ in range(3000)] + ["-----BEGIN PRIVATE KEY-----BEGIN RSA PRIVATE KEY-----"]
    texts += ["-----BEGIN " + x + "PRIVATE KEY-----" for x in ("", " ", "A ", "A  ", "A B ", "A", " A ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rule = [r for r in secrets.RULES if r.kind == "private"]
    got = kinds(secrets.scan(docs, rules=tuple(rule))[0], docs)
    assert {i: [s[::2] for s in spans] for i, spans in got.items()} == {i: [m.span() for m in KEY.finditer(t)] for i, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 20


@pytest.mark.parametrize("rules", [secrets.RULES, secrets.RULES[:2]])
def test_ledger_in_a_folder(spark, tmp_path, rules):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    once = kinds(secrets.scan(docs, rules=rules)[0], docs)
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    secrets.update(docs.where("doc_id % 3 = 0"), folder, rules[:1])
    secrets.update(docs.where("doc_id % 3 < 2"), folder, rules)
    assert kinds(secrets.update(docs, folder, rules), docs) == once
    ledger = spark.read.parquet(folder)
    pairs = ledger.select("blob", F.explode("rules").alias("rule"))
    assert pairs.count() == pairs.distinct().count() == docs.select("text").distinct().count() * len(rules)
    before = ledger.count()
    assert kinds(secrets.update(docs, folder, rules), docs) == once and spark.read.parquet(folder).count() == before
    assert secrets.update(docs.limit(0), f"{tmp_path}/{uuid.uuid4().hex}", rules).count() == 0


def test_query_goes_on_from_its_ledger(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = kinds(secrets.scan(docs)[0], docs)
    got = {r["doc_id"]: r["spans"] for r in queries.op2_secrets(spark, SF).collect()}
    assert got == {i: ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans) for i, spans in found.items()}
