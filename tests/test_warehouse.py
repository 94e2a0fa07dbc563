"""The data source of tables: commit, abort, pushed filters and planned splits."""

from __future__ import annotations

import json
import re
from datetime import date
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillwatch.sinks import tables, warehouse
from tillwatch.sources import readers


@pytest.fixture(autouse=True)
def registered(spark):
    warehouse.register(spark)


@pytest.fixture
def rows(spark):
    return spark.range(1000).select(
        "id", (F.col("id") % 7).cast("int").alias("kind"), F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") / 100).cast("int")).alias("day"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("é"), F.col("id").cast("string"))).alias("name"), (F.col("id") / 8).cast("decimal(18,2)").alias("price"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 3).alias("rate"), F.array("id").alias("list"),
    )


def load(spark, path, **options):
    return spark.read.format("warehouse").options(path=str(path), dbtable="t", **options).load()


def names(path):
    return {f["name"] for f in json.loads((path / "t" / "manifest.json").read_text())["files"]}


def test_round_trip_overwrite_and_append(spark, rows, tmp_path):
    tables.write_external(rows.limit(3), "warehouse", {"path": str(tmp_path)}, "t")
    tables.write_external(rows, "warehouse", {"path": str(tmp_path), "groupRows": "50", "fileRows": "120"}, "t")
    back = load(spark, tmp_path)
    assert back.schema == rows.schema and values(back.drop("rate", "list")) == values(rows.drop("rate", "list"))
    assert back.where("isnan(rate)").count() == 334 and back.agg(F.sum(F.col("list")[0])).first()[0] == sum(range(1000))
    old = names(tmp_path)
    rows.limit(10).write.format("warehouse").options(path=str(tmp_path), dbtable="t").mode("append").save()
    assert load(spark, tmp_path).count() == 1010 and names(tmp_path) > old
    assert warehouse.sweep(str(tmp_path), "t") > 0 and load(spark, tmp_path).count() == 1010
    tables.write_external(rows.limit(0), "warehouse", {"path": str(tmp_path)}, "t")
    assert load(spark, tmp_path).count() == 0 and load(spark, tmp_path).schema == rows.schema
    assert load(spark, tmp_path, columns="kind,id").columns == ["kind", "id"]


def test_a_failed_task_leaves_the_old_table(spark, rows, tmp_path):
    tables.write_external(rows, "warehouse", {"path": str(tmp_path)}, "t")
    before, files = (tmp_path / "t" / "manifest.json").read_text(), sorted(p for p in (tmp_path / "t").rglob("*.parquet"))
    broken = rows.withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="broken"):
            broken.repartition(4).write.format("warehouse").options(path=str(tmp_path), dbtable="t").mode(mode).save()
        assert (tmp_path / "t" / "manifest.json").read_text() == before and load(spark, tmp_path).count() == 1000
    assert sorted(p for p in (tmp_path / "t").rglob("*.parquet")) == files


@pytest.mark.parametrize(
    "condition",
    ["id = 77", "id > 950", "id >= 950 AND kind <= 3", "id < 3 OR id > 990", "day = DATE'2025-01-04'", "day < DATE'2025-01-02'", "name = 'é501'", "name IS NULL AND id < 100", "name IS NOT NULL", "kind IN (1, 5, 9)",
     "price > 99.5", "price = 12.50", "rate > 300", "id = 5000", "kind = 2 AND day IN (DATE'2025-01-01', DATE'2025-01-09')", "name LIKE 'é9%'", "NOT (id > 5)", "name <=> NULL", "id IS NULL"],
)
def test_filters_give_what_spark_gives(spark, rows, tmp_path_factory, condition):
    path = tmp_path_factory.getbasetemp() / "filters"
    if not path.exists():
        rows.repartitionByRange(4, "id").write.format("warehouse").options(path=str(path), dbtable="t", groupRows="40").mode("overwrite").save()
    got = load(spark, path).where(condition)
    assert values(got.drop("rate", "list")) == values(rows.where(condition).drop("rate", "list"))


def test_groups_outside_the_bounds_are_not_read(spark, rows, tmp_path):
    rows.coalesce(1).write.format("warehouse").options(path=str(tmp_path), dbtable="t", groupRows="100", fileRows="300").mode("overwrite").save()
    found = warehouse.manifest_of(str(tmp_path), "t")
    assert [len(f["groups"]) for f in found["files"]] == [3, 3, 3, 1]

    def planned(*filters):
        scan = warehouse.Scan(str(tmp_path), "t", rows.schema, found, 1)
        assert list(scan.pushFilters(list(filters))) == []
        return [(p.file, p.numbers) for p in scan.partitions() if p.file]

    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, LessThanOrEqual

    assert len(planned()) == 10 and len(planned(EqualTo(("id",), 250))) == 1 and len(planned(GreaterThan(("id",), 799))) == 2
    assert len(planned(In(("day",), (date(2025, 1, 3), date(2025, 1, 5))))) == 2 and planned(IsNull(("id",))) == []
    assert len(planned(LessThanOrEqual(("price",), Decimal("12.50")))) == 2 and planned(EqualTo(("id",), -1)) == []
    assert load(spark, tmp_path, splitBytes="1").rdd.getNumPartitions() == 10
    assert load(spark, tmp_path).rdd.getNumPartitions() == 4


def test_query_text_over_scans(spark, rows, tmp_path):
    rows.write.format("warehouse").options(path=str(tmp_path), dbtable="t", groupRows="50").mode("overwrite").save()
    text = "SELECT kind AS KIND, count(*) AS N FROM {t} WHERE id >= 500 AND day < DATE'2025-01-08' GROUP BY kind"
    got = readers.read_query(spark, "warehouse", {"path": str(tmp_path), "splitBytes": "2000"}, text, tables=["t"])
    assert got.columns == ["kind", "n"] and sum(n for _, n in values(got)) == 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Filter .*id", plan), plan  # the source has taken all filters


def test_missing_table(spark, tmp_path):
    with pytest.raises(Exception, match="nothing"):
        spark.read.format("warehouse").options(path=str(tmp_path), dbtable="nothing").load()
