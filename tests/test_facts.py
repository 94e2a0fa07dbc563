"""The rules of a week from the facts of each receipt, against the metrics one by one, on odd rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillwatch import model
from tillwatch.functions import keys
from tillwatch.operators import flagging, rules, scale
from tillwatch.params import Params
from tillwatch.plans.week import extract_week, prepare_week, week_anomalies, week_metrics
from tillwatch.projection import raw_tables
from tillwatch.sources import extracts

P = Params(client_id=4, start_date="2025-01-06", end_date="2025-01-19", store_min=0, store_max=1000)


@pytest.fixture(scope="module")
def raw(spark):
    """Receipts that share number, second or place, lines that share a number, and NULLs, at a few registers of two stores."""
    rng = random.Random(5)
    make = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(2)
    receipts = []
    for i in range(900):
        day = date(2025, 1, 6) + timedelta(days=rng.randrange(3))
        at = datetime(day.year, day.month, day.day, 9, 0, rng.randrange(40), rng.choice([0, 0, 250_000]))
        loc = rng.choice([1, 1, 10, 100, 2])  # 1, 10 and 100 are one store
        receipts.append((loc, 4, rng.choice([1, 2, 81]), day, rng.choice([at] * 30 + [None]), rng.choice([i, i % 70, i % 70, None if i % 97 == 0 else i])))
    kinds = [*model.SALE_LINES, *model.VOID_LINES, 101, 101, 170, 171, 150, None]
    headers, lines, subtotals, payments = [], [], [], []
    for r in receipts:
        kind = rng.choice([model.SALE, model.SALE, model.SALE, model.RETURN, model.CANCELLED, 999])
        sales = rng.randrange(1, 4)
        for _ in range(rng.choice([1, 1, 1, 1, 2])):
            headers.append((*r, kind, sales, rng.choice([sales - 1, 0]), rng.choice([1, 1, 1, 0]), 7, rng.choice([-8, -20, 5])))
        for _ in range(rng.randrange(7)):
            back = kind == model.RETURN or rng.random() < 0.05
            named = (r[0], r[2], r[3] - timedelta(days=rng.choice([0, 0, 100])), rng.choice([r[5], r[5], 5000, None])) if back else (None,) * 4
            code, item = rng.choice(kinds), rng.choice([1, 1, 2, 3, None])
            voided = rng.choice([0, 3, 3]) if code in (170, 172) else rng.choice([None, None, None, 9])
            lines.append((*r, rng.choice([1, 2, 3, 4, 5, 6, None]), code, int(back), rng.choice([1, 1, 1, 0]), voided, rng.choice(["E1", "E2", None]), item, 1, 1, *named))
        subtotals += [(*r, rng.choice([1, 2, 3, 4]), 7) for _ in range(rng.randrange(4))]
        payments += [(*r, rng.choice([11, 11, 11, 12, None])) for _ in range(rng.randrange(1, 3))]
    location = [(1, 100), (10, 100), (100, 100), (2, 101)]
    hours = [(4, s, date(2025, 1, 6) + timedelta(days=d), int(d != 1), "08:00:00", rng.choice(["09:00:00", "08:30:00", None])) for s in (100, 101) for d in range(3)]
    money = lambda df, schema: df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def table(rows, schema):
        text = ", ".join(f"{f.name} {'double' if isinstance(f.dataType, type(model._MONEY)) else f.dataType.simpleString()}" for f in schema.fields)
        floats = [i for i, f in enumerate(schema.fields) if isinstance(f.dataType, type(model._MONEY))]
        rows = [tuple(float(v) if i in floats and v is not None else v for i, v in enumerate(r)) for r in rows]
        return scale.staged(money(make(rows, text), schema), "odd")

    return {
        "receipt_header": table(headers, model.RECEIPT_HEADER),
        "receipt_line": table(lines, model.RECEIPT_LINE),
        "subtotal_line": table(subtotals, model.SUBTOTAL_LINE),
        "payment": table(payments, model.PAYMENT),
        "location": table(location, model.LOCATION),
        "store_hours": table(hours, model.STORE_HOURS),
        "org_structure": table([], model.ORG_STRUCTURE),
    }


@pytest.mark.parametrize("changes", [{}, {"cash_only": False, "nth_last_subtotal": 1, "min_distinct_voided": 1}])
def test_facts_give_what_the_metrics_give(raw, changes):
    p = P.with_(**changes)
    x = extract_week(raw, p)
    x |= prepare_week(x, p)
    wanted = values(scale.staged(flagging.merge_anomalies(week_metrics(x, p)), "wanted"))
    assert values(week_anomalies(raw, x, p, keep=scale.staged)) == wanted
    assert {row[-1] for row in wanted} == set(model.KPI_IDS)


def test_number_keys_are_equal_where_text_keys_are(raw):
    line, location = raw["receipt_line"], raw["location"]
    rows = extracts.receipt_lines(line, location, P, lambda: keys.text_key() + keys.number_key()).select("transaction_id", *keys.KEY).distinct()
    complete = rows.filter("transaction_id IS NOT NULL")
    assert rows.filter("transaction_id IS NULL AND key_receipt IS NOT NULL AND key_till IS NOT NULL AND key_second IS NOT NULL").isEmpty()
    assert complete.count() == complete.select("transaction_id").distinct().count() == complete.select(*keys.KEY).distinct().count() > 300


def test_lines_are_numbered_and_joined_once(spark):
    """A line and the original it names come from one pass, and the join takes the rows as the numbering has dealt them out."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = raw_tables(spark, "/root/testdata/sf0.01")["receipt_line"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Window [") == 1


def test_a_week_with_kept_facts_shuffles_no_lines_but_for_the_facts(raw):
    """Each step after the facts tests lines against a filter where they are read."""
    kept = {}

    def keep(df, name):
        kept[name] = df._jdf.queryExecution().executedPlan().toString()
        return scale.staged(df, name)

    x = extract_week(raw, P)
    week_anomalies(raw, x, P, keep=keep)
    assert set(kept) == {"named_returns", "receipt_facts", "after_subtotal", "next_receipts"}
    assert "filter_word" in kept["after_subtotal"] and "filter_word" in kept["next_receipts"]


def test_flags_by_step_read_counts_and_levels_that_are_written_once(spark):
    """Neither goes back to the anomalies; the counts stand for three steps, the levels for each of the two rankings."""
    from workload.queries import QUERIES, Week

    folder = "/root/testdata/sf0.001"
    for name in ("e11_rank_flags", "e12_final_flags"):
        read = {file.split("/")[-2].rsplit("-", 1)[0] for file in QUERIES[name](spark, folder).inputFiles()}
        assert read <= {"levels", "ranges"}
    read = {file.split("/")[-2].rsplit("-", 1)[0] for file in Week.lazy(spark, folder).base.inputFiles()}
    assert read == {"cashier_kpis"}


@pytest.mark.parametrize("changes", [{"store_max": 100}, {"stores": (101,)}])
def test_facts_keep_to_the_stores_of_the_run(raw, changes):
    p = P.with_(**changes)
    x = extract_week(raw, p)
    x |= prepare_week(x, p)
    wanted = values(flagging.merge_anomalies(week_metrics(x, p)))
    assert values(week_anomalies(raw, x, p, keep=scale.staged)) == wanted
    assert {row[0] for row in wanted} == {changes.get("store_max") or changes["stores"][0]}


def test_lines_are_not_dealt_out_by_location(spark, raw):
    """With more locations than Spark sends to every task, lines and payments are still shuffled by receipt only."""
    kept = {}

    def keep(df, name):
        kept[name] = df._jdf.queryExecution().executedPlan().toString()
        return scale.staged(df, name)

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        week_anomalies(raw, extract_week(raw, P), P, keep=keep)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(key_receipt" in kept["receipt_facts"]
    assert not any("hashpartitioning(loc_sid" in kept[name] for name in ("receipt_facts", "named_returns"))


def test_a_receipt_that_moves_along_has_its_number_once(spark, raw):
    """Next receipts are put in order with one copy of what tells them apart."""
    headers = extracts.priced_headers(raw["receipt_header"], raw["location"], P, keys.number_key)
    following = rules.next_keys(headers)
    ranged = spark.read.parquet(*{file.rsplit("/", 1)[0] for file in following.inputFiles()})
    assert "key_receipt" not in ranged.columns
    assert following.filter("NOT (key_receipt <=> receipt_id)").isEmpty() and not following.filter("next_key_receipt IS NOT NULL").isEmpty()
