"""Secrets in texts, found with an incremental ledger of blobs; DataFrame functions only.

Every text is a version at a path (the document) and has a content address, the SHA-256 of its
UTF-8 bytes. The ledger says which pairs of blob and rule version have been scanned, and what
was found. A run computes all addresses, scans one copy of each blob with the rules that the
ledger lacks for it, adds rows to the ledger, and joins findings back to all paths. ``update``
keeps the ledger as a table in a folder: later runs over more documents, or with other rules, go on from there.

Spans count code points, end exclusive. A rule finds leftmost non-overlapping matches; those
whose value is too short are dropped after they were matched. Null and empty texts have no
spans. Documents with null or repeated ids are rows like others: each gets the findings of its
text. An empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, unused


@dataclass(frozen=True)
class Rule:
    """``pattern``: Java syntax; ``group`` must have ``least`` characters; ``probe``: pattern that every text with a match matches, or plain words of which it holds one."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    probe: str = ""
    words: tuple[str, ...] = ()

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: In the order in which kinds are listed.
RULES = (
    Rule("assign", 1, ASSIGN, group=2, least=6, probe=r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", words=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", probe=r"[0-9a-f]{24}"),
    # words of capitals with one blank behind each; without a repeated group, which Java matches by recursion
    Rule("private", 1, r"-----BEGIN (?! )(?![A-Z ]*  )[A-Z ]*(?<= )PRIVATE KEY-----", words=("PRIVATE KEY-----",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", words=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
BASE = ("assign", "access", "hex")

SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def address(text: Column) -> Column:
    """Content address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """All matches of one rule: the pieces between matches and the matches themselves give the positions."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("piece"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(acc, x):
        begin = acc["at"] + F.char_length(x["piece"])
        end = begin + F.char_length(x["match"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        good = x["match"].isNotNull() & (F.char_length(x["value"]) >= rule.least)
        return F.struct(F.coalesce(end, begin).alias("at"), F.when(good, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(parts, start, step, lambda acc: acc["found"])
    if rule.words:
        holds = F.lit(False)
        for word in rule.words:
            holds = holds | F.contains(text, F.lit(word))
    else:
        holds = text.rlike(rule.probe)
    return F.when(holds, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings per blob that has any: blob, spans; the ledger's new rows: blob, rules, spans).

    ``ledger`` holds the new rows of earlier runs. Spans are sorted by start, then by the order of rules.
    """
    blobs = docs.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    ids = F.array(*(F.lit(r.id) for r in rules))
    if ledger is None:
        unseen = blobs.withColumn("rules", ids)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn("rules", F.array_except(ids, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("rules") > 0)
    nothing = F.array().cast(f"array<{SPAN}>")
    parts = [F.when(F.array_contains("rules", r.id), rule_spans(F.col("text"), r, i)).otherwise(nothing) for i, r in enumerate(rules)]
    new = kept(unseen.select("blob", "rules", F.array_sort(F.concat(*parts)).alias("spans")), "secret-ledger")
    found = new.where(F.size("spans") > 0).select("blob", "spans")
    if ledger is not None:
        # spans of rule versions that are no longer asked for stay in the ledger, but are not reported
        asked = lambda rules, kind: F.exists(rules, lambda id: F.array_contains(ids, id) & (F.substring_index(id, "@", 1) == kind))
        current = ledger.where(F.size("spans") > 0).select("blob", F.filter("spans", lambda s: asked(F.col("rules"), s["kind"])).alias("spans")).where(F.size("spans") > 0)
        found = kept(found.unionByName(current).groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")), "secret-findings")
    return found, new


LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


def update(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger in the folder lacks, add it there, and return the findings per blob of the documents and the ledger."""
    spark = docs.sparkSession
    try:
        spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        before = None
    else:
        before = spark.read.schema(LEDGER).parquet(folder)
    found, new = scan(docs, before, rules)
    new.write.mode("append").parquet(folder)
    return found


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def paths(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans (empty where there are none)."""
    rows = docs.select("doc_id", address(F.col("text")).alias("blob"))
    return rows.join(found, "blob", "left").select("doc_id", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns; spans in ``text`` (overlapping ones together) become ``mark``."""
    names = docs.columns
    blob, spans = unused("blob", names), unused("spans", names)
    rows = docs.withColumn(blob, address(F.col("text"))).join(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), blob, "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        apart = s["start"] >= acc["at"]
        out = F.when(apart, F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    cleaned = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))))
    return rows.withColumn("text", F.when(F.col(spans).isNotNull(), cleaned).otherwise(F.col("text"))).select(*names)
