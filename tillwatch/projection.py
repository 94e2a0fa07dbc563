"""The benchmark tables ``orders`` and ``lineitem`` seen as two weeks of cash-register data.

Every order becomes a receipt and every line item a receipt line, so the size of
all tables follows the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch import model

FIRST_DAY = "2025-01-06"
DAYS = 14
ORIGINAL_OFFSET = 1_000_000
EAN_COUNT = 7


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _receipts(orders: DataFrame) -> DataFrame:
    """Per order, everything that follows from the order row alone."""
    oid, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (oid % DAYS).cast("int"))
    kind = F.when(oid % 10 == 0, model.RETURN).when(oid % 10 == 1, model.CANCELLED).otherwise(model.SALE)
    seconds = F.lit(25_200) + (oid * 37) % 54_000
    total = F.when(oid % 10 == 0, -(1 + F.col("o_totalprice") % 20)).otherwise(F.col("o_totalprice"))
    return orders.select(
        oid.alias("receipt_id"),
        (100 + F.floor(cust / 75)).alias("store_nr"),
        (9000 + F.floor(cust / 75)).alias("loc_sid"),
        F.lit(4).alias("client_id"),
        day.alias("receipt_date"),
        _at(day, seconds).alias("receipt_ts"),
        F.when(oid % 11 == 0, 80 + oid % 3).otherwise(1 + oid % 5).alias("register_id"),
        (1 + cust % 3).alias("cashier_id"),
        kind.alias("transaction_type_cd"),
        F.when(oid % 10 == 1, 0).otherwise(1).alias("turnover_relevant_fg"),
        F.round(total, 2).alias("total_gross_val"),
    )


def _at(day: Column, seconds: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _articles(lineitem: DataFrame) -> DataFrame:
    # named first: the join with the receipts then takes the rows as the numbering has dealt them out
    lineitem = lineitem.withColumnRenamed("l_orderkey", "receipt_id")
    in_order = Window.partitionBy("receipt_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    k = (F.col("l_partkey") + F.col("l_suppkey")) % 10
    kind = F.when(k < 5, 101).when(k == 5, 102).when(k < 8, 170).otherwise(171)
    return lineitem.select(
        "receipt_id",
        (2 * F.row_number().over(in_order)).alias("receiptline_nr"),
        kind.alias("line_type"),
        (F.col("l_partkey") % EAN_COUNT).alias("item_sid"),
        F.col("l_quantity").alias("sales_piece_qty"),
    )


def _lines(receipts: DataFrame, lineitem: DataFrame) -> DataFrame:
    returned = F.col("transaction_type_cd") == model.RETURN
    kind = F.when(returned, model.RETURN).otherwise(F.col("line_type"))
    referenced = returned & (F.col("receipt_id") % 3 != 0)
    sold = F.when(referenced, F.date_sub("receipt_date", (F.col("receipt_id") % 120).cast("int")))
    lines = (
        receipts.drop("total_gross_val", "cashier_id")
        .join(_articles(lineitem), "receipt_id")
        .withColumns(
            {
                "transaction_type_cd": kind,
                "return_fg": returned.cast("int"),
                "receiptline_voided_by": F.when(kind == 170, F.col("receiptline_nr") + 1),
                "ean_barcode": F.concat(F.lit("E"), F.col("item_sid").cast("string")),
                "sales_weight_qty": F.lit(1),
                "orig_receipt_store_id": F.when(referenced, F.col("store_nr")),
                "orig_receipt_register_id": F.when(referenced, F.col("register_id")),
                "orig_receipt_dt": sold,
                "orig_receipt_id": F.when(referenced, F.col("receipt_id") + ORIGINAL_OFFSET),
            }
        )
    )
    clock = F.col("receipt_ts") - F.col("receipt_date").cast("timestamp_ntz")
    nothing = F.lit(None)
    sale = {
        "receipt_ts": F.col("orig_receipt_dt").cast("timestamp_ntz") + clock,
        "receipt_date": F.col("orig_receipt_dt"),
        "receipt_id": F.col("orig_receipt_id"),
        "transaction_type_cd": F.lit(101),
        "return_fg": F.lit(0),
        "orig_receipt_store_id": nothing,
        "orig_receipt_register_id": nothing,
        "orig_receipt_dt": nothing,
        "orig_receipt_id": nothing,
    }
    # a returned line that names its original stands for two, so numbering and join are done once
    twice = F.when(F.col("orig_receipt_id").isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = lines.withColumn("is_original", F.explode(twice))
    both = both.withColumns({name: F.when(F.col("is_original"), column).otherwise(F.col(name)) for name, column in sale.items()})
    return _typed(both, model.RECEIPT_LINE)


def _headers(receipts: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Line counts need no join with the numbered lines: they follow from the line items."""
    k = (F.col("l_partkey") + F.col("l_suppkey")) % 10
    counts = lineitem.groupBy(F.col("l_orderkey").alias("receipt_id")).agg(
        F.count_if(k < 8).alias("sales"), F.count_if((k == 6) | (k == 7)).alias("voids")
    )
    no_return = F.col("transaction_type_cd") != model.RETURN
    headers = receipts.join(counts, "receipt_id", "left").withColumns(
        {
            "cnt_receiptlines_sales": F.coalesce(F.when(no_return, F.col("sales")), F.lit(0)),
            "cnt_receiptlines_voids": F.coalesce(F.when(no_return, F.col("voids")), F.lit(0)),
        }
    )
    return _typed(headers, model.RECEIPT_HEADER)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven raw tables, lazily."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    receipts = _receipts(orders)
    staffed = receipts.filter(F.col("register_id") < model.SELF_CHECKOUT_FROM)
    stores = receipts.select("store_nr", "loc_sid").distinct()

    # neither array takes a lambda, which Spark would run row by row outside the compiled stage
    places = F.sequence(F.lit(1).cast("long"), 2 * (F.col("receipt_id") % 3) + 1, F.lit(2).cast("long"))
    first = F.when(F.col("receipt_id") % 4 == 0, 12).otherwise(model.CASH)
    payments = F.when(F.col("receipt_id") % 9 == 0, F.array(first, F.lit(12))).otherwise(F.array(first))
    s, d = F.col("store_nr") - 100, F.col("day")
    closed = d.isin(6, 13) & (s % 2 == 0)
    clockless = closed | ((s + d) % 17 == 0)
    days = F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1)))
    return {
        "receipt_header": _headers(receipts, lineitem),
        "receipt_line": _lines(receipts, lineitem),
        "subtotal_line": _typed(receipts.withColumn("receiptline_nr", F.explode(places)), model.SUBTOTAL_LINE),
        "payment": _typed(staffed.withColumn("payment_type", F.explode(payments)), model.PAYMENT),
        "location": _typed(stores, model.LOCATION),
        "store_hours": _typed(
            stores.withColumn("day", days).select(
                F.lit(4).alias("client_id"),
                "store_nr",
                F.date_add(F.lit(FIRST_DAY).cast("date"), d).alias("receipt_date"),
                (~closed).cast("int").alias("is_open"),
                F.when(~clockless, F.lit("08:00:00")).alias("open_time"),
                F.when(~clockless, F.lit("20:00:00")).alias("close_time"),
            ),
            model.STORE_HOURS,
        ),
        "org_structure": _typed(
            stores.select(
                F.lit(4).alias("client_id"),
                F.lit(2).alias("aspect_id"),
                F.lit(None).alias("dat_closing"),
                (5 + s % 2).alias("wh_id"),
                F.col("store_nr").alias("orig_store_nr"),
                F.concat(F.lit("Store "), F.col("store_nr").cast("string")).alias("store_desc"),
                F.concat(F.lit("VL_"), (s % 2).cast("string")).alias("account_manager"),
                F.concat(F.lit("RL_"), (s % 4).cast("string")).alias("sales_manager"),
            ),
            model.ORG_STRUCTURE,
        ),
    }
