"""Operators in Python workers that have done nothing before, as on a cluster with more cores than earlier tasks."""

from __future__ import annotations

import os
import subprocess
import sys
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyarrow import ipc

REPO = str(Path(__file__).resolve().parents[2])


def in_new_python(code: str, given: bytes = b"", args: Sequence[str] = ()) -> str:
    env = os.environ | {"PYTHONPATH": REPO}
    done = subprocess.run([sys.executable, "-c", code, *args], input=given, capture_output=True, cwd=REPO, env=env, timeout=300)
    assert done.returncode == 0, done.stderr.decode()[-3000:]
    return done.stdout.decode()


CONTINUATIONS = """
import sys
import numpy as np
from pyarrow import ipc

batch = next(iter(ipc.open_stream(sys.stdin.buffer.read())))  # as Spark hands it over: nothing else of Arrow is loaded
assert "pyarrow.compute" not in sys.modules
from tillwatch.llm import toxicity

rows = [r for b in toxicity._distinct(toxicity._continuations([np.zeros(0, np.uint64)] * 4)([batch])) for r in b.to_pylist()]
print(len(rows), {r["stem0"] for r in rows})
"""


def test_words_of_texts_in_a_new_worker():
    batch = pa.record_batch({"text": ["one two three", None, "", "two Three four"]})
    sink = pa.BufferOutputStream()
    with ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    assert in_new_python(CONTINUATIONS, sink.getvalue().to_pybytes()).split("\n")[0] == "4 {-1}"


QUERY = """
import sys
from pyspark.sql import SparkSession

conf = {"spark.ui.enabled": "false", "spark.python.worker.reuse": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": sys.argv[1], "spark.sql.warehouse.dir": sys.argv[1]}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from tillwatch.llm import queries

sf = "/root/testdata/sf0.001"
print("rows", queries.op1_toxicity(spark, sf).where("score BETWEEN 0 AND 1").count(), queries.table(spark, sf, "documents").count())
spark.stop()
"""


def test_op1_with_a_new_worker_for_each_task(tmp_path):
    said = in_new_python(QUERY, args=[str(tmp_path)]).split()
    at = said.index("rows")
    assert int(said[at + 1]) == int(said[at + 2]) > 0
