"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
as the next one's documents. Nulls, empty tables, repeated rows and further columns are handled as
the operators say; all stages but the last return the columns they got.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import decontam, packing, queries, secrets, simhash, toxicity
from tillwatch.llm.common import shared_folder, unused


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    model = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"), learn=~queries.held_out())
    mark = unused("toxicity", docs.columns)
    return toxicity.score(docs, model, mark).where(f"{mark} < 0.5").drop(mark)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text (and n_chars follows it); every document stays."""
    found, _ = secrets.scan(docs)
    masked = secrets.redact(docs, found)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised texts with their sequence and place."""
    return packing.packed(docs, queries.tokenizer())


STAGES = [
    ("toxicity", _toxicity),
    ("near-duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("secrets", _secrets),
    ("packing", _packing),
]

#: Learned models and packing have no SQL form; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
