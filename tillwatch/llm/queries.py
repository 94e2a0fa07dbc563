"""The registered queries of this subpackage, and DuckDB SQL (``ORACLES``) where SQL can express one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, conversations, decontam, embeddings, html, licenses, lines, packing, secrets, simhash, suffix, toxicity, warc
from .common import shared_folder
from .oracle import ORACLES


__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """Rows whose label may not be learned from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=~held_out())
    scored = toxicity.score(docs, model, "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    # two runs: half of the documents, then all of them, of which the ledger has half
    secrets.update(docs.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0), ledger)
    rows = secrets.paths(docs, secrets.update(docs, ledger))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return rows.select("doc_id", *(n(kind) for kind in secrets.BASE), F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.pages(warc.read(spark, folder))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embeddings.near(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.concat(*(F.col("places")[label] for label in licenses.PHRASES))
    base = F.array_sort(F.array_compact(F.array(*(F.when(F.size(F.col("places")[label]) > 0, F.lit(label)) for label in licenses.PHRASES))))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, "labels"))), ",").alias("labels"),
        F.greatest("share", (F.size(starts) > 0).cast("double")).alias("score"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.figures(table(spark, sf_dir, "documents").select("doc_id", "text"))


def tokenizer() -> str:
    """The vocabulary of the packing query; other callers of the operator name their own."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.keep_bitmaps(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(lines.kept_text(F.col("text"), F.col("keep")), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_embeddings": op5_embeddings,
    "op6_licenses": op6_licenses,
    "op7_html": op7_html,
    "op8_suffix": op8_suffix,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_conversations": op11_conversations,
    "op12_collocations": op12_collocations,
    "op13_lines": op13_lines,
}