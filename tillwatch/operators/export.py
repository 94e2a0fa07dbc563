"""Stage 4: nested weekly documents with the evidence of flagged cashiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.calendar import iso_week, iso_year
from tillwatch.functions.columns import kpi_id_of
from tillwatch.sinks.documents import NamedDocuments


def evidence(details: DataFrame) -> DataFrame:
    """Receipts in export form: ISO year and week, occurrence time, KPI id and renamed ids.

    Details that carry a KPI name instead of an id are understood as well.
    """
    kpi = F.col("kpi_id") if "kpi_id" in details.columns else kpi_id_of(F.col("kpi_name"))
    when = F.concat(F.col("receipt_date").cast("string"), F.lit(" "), F.col("receipt_time"))
    return details.select(
        iso_year("receipt_date").alias("year"),
        F.weekofyear("receipt_date").alias("weeknumber"),
        iso_week("receipt_date").alias("iso_week"),
        "store_nr",
        kpi.alias("kpi_id"),
        when.alias("OccurrenceDateTime"),
        F.col("register_id").alias("TillNr"),
        F.col("cashier_id").alias("ServicerID"),
        F.col("receipt_id").cast("string").alias("ReceiptNr"),
    )


def flagged_evidence(flags: DataFrame, proof: DataFrame) -> DataFrame:
    """Evidence of the flagged cashiers, for the week, store and KPI they are flagged in."""
    flagged = flags.select("iso_week", "store_nr", "kpi_id", F.col("cashier_id").alias("ServicerID"))
    return proof.join(flagged, ["iso_week", "store_nr", "kpi_id", "ServicerID"], "leftsemi")


#: What a document holds, and by which columns documents are told apart besides the week. The finer ones part receipts; flags, which
#: belong to no day or register, have a document of their own.
GRAINS = {
    "week": [],
    "store": ["store_nr"],
    "kpi": ["store_nr", "kpi_id"],
    "day": ["store_nr", "kpi_id", "day"],
    "register": ["store_nr", "kpi_id", "register"],
}
FIELDS = ["OccurrenceDateTime", "TillNr", "ServicerID", "ReceiptNr"]


def weekly_documents(flags: DataFrame, details: DataFrame, grain: str = "store") -> DataFrame:
    """``{year, weeknumber, evaluation: [{StoreID, KPI: [{KPITypeID, Anomalies, Receipts}]}]}``.

    The caller says what makes a document: a ``store`` of a week, a ``kpi`` of such a store, the receipts of a ``day`` or
    ``register`` in it, or the whole ``week``. The form is the same for each, and no sizes change it: what is gathered in one
    document are the entries of its grain. Stores are in order of their number, all arrays sorted.
    """
    own = GRAINS[grain]
    flag_items = flags.filter(F.col("iso_week").isNotNull()).select(
        "iso_week",
        "store_nr",
        "kpi_id",
        F.struct(F.col("cashier_id").alias("ServicerID"), F.col("flag").alias("AnomalyGrade")).alias("anomaly"),
    )
    proof = flagged_evidence(flags, evidence(details))
    receipt_items = proof.select(
        "iso_week", "store_nr", "kpi_id", F.struct(*FIELDS).alias("receipt"),
        F.substring("OccurrenceDateTime", 1, 10).alias("day"), F.col("TillNr").alias("register"),
    )
    group = ["iso_week", "store_nr", "kpi_id"]
    items = flag_items.unionByName(receipt_items, allowMissingColumns=True).dropna(subset=group)
    finer = [c for c in own if c not in group]

    per_kpi = items.groupBy(*group, *finer).agg(
        F.sort_array(F.collect_list("anomaly")).alias("Anomalies"),
        F.sort_array(F.collect_list("receipt")).alias("Receipts"),
    )
    kpi = F.struct(F.col("kpi_id").alias("KPITypeID"), "Anomalies", "Receipts")
    level = ["iso_week", "store_nr", *(["kpi_id"] if "kpi_id" in own else []), *finer]
    per_store = per_kpi.groupBy(*level).agg(F.sort_array(F.collect_list(kpi)).alias("KPI"))
    numbered = F.sort_array(F.collect_list(F.struct("store_nr", "KPI")))
    evaluation = F.transform(numbered, lambda s: F.struct(s["store_nr"].cast("string").alias("StoreID"), s["KPI"].alias("KPI")))
    return (
        per_store.groupBy("iso_week", *own)
        .agg(evaluation.alias("evaluation"))
        .select(
            F.split_part("iso_week", F.lit("-"), F.lit(1)).cast("int").alias("year"),
            F.split_part("iso_week", F.lit("-"), F.lit(2)).cast("int").alias("weeknumber"),
            "evaluation",
        )
    )


def document_entries(flags: DataFrame, details: DataFrame) -> DataFrame:
    """What the documents of the weeks hold, one row for each flag (kind 0) and receipt (kind 1), with its JSON text."""
    week = [F.split_part("iso_week", F.lit("-"), F.lit(i)).cast("int").alias(c) for i, c in ((1, "year"), (2, "weeknumber"))]
    flag = F.struct(F.col("cashier_id").alias("ServicerID"), F.col("flag").alias("AnomalyGrade"))
    proof = flagged_evidence(flags, evidence(details))
    parts = [(flags, 0, flag, ["cashier_id", "flag"]), (proof, 1, F.struct(*FIELDS), FIELDS)]
    rows = [
        df.dropna(subset=["iso_week", "store_nr", "kpi_id"]).select(
            *week, "store_nr", "kpi_id", F.lit(kind).alias("kind"), F.to_json(entry, {"ignoreNullFields": "true"}).alias("entry"), F.struct(*[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)]).alias(f"order_{kind}")
        )
        for df, kind, entry, by in parts
    ]
    return rows[0].unionByName(rows[1], allowMissingColumns=True)


def write_named_documents(flags: DataFrame, details: DataFrame, path: str, indent: int | None = None) -> None:
    """One file ``dbp_<year>_<week>.json`` for each week, in which a store and KPI stand once; other weeks' files stay.

    A file is one text and so is written by one task, which gets the week's entries sorted and writes
    each as it comes: sorting spills, and memory does not grow with a store or a week.
    """
    rows = document_entries(flags, details)
    spark = rows.sparkSession
    spark.dataSource.register(NamedDocuments)
    rows = rows.repartition("year", "weeknumber").sortWithinPartitions("year", "weeknumber", "store_nr", "kpi_id", "kind", "order_0", "order_1")
    options = {} if indent is None else {"indent": str(indent)}
    rows.drop("order_0", "order_1").write.format("weekly_documents").options(**options).mode("append").save(path)


def document_json(docs: DataFrame, pretty: bool = False) -> DataFrame:
    """Documents as JSON text in ``value``."""
    options = {"pretty": str(pretty).lower(), "ignoreNullFields": "true"}
    return docs.select("year", "weeknumber", F.to_json(F.struct("year", "weeknumber", "evaluation"), options).alias("value"))


def write_documents(docs: DataFrame, path: str, pretty: bool = False) -> None:
    """One folder ``document=dbp_<year>_<week>.json`` per week, each of its documents a text record in it.

    Only the weeks written are replaced. The name's form is a fixed value. Written pretty, a record spans several lines.
    """
    name = F.format_string("dbp_%d_%d.json", "year", "weeknumber")
    (
        document_json(docs, pretty)
        .select(name.alias("document"), "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("document")
        .text(path)
    )
