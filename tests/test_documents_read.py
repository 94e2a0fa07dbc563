"""The query of document files takes no file as one value."""

from __future__ import annotations

import hashlib

from tillwatch.sinks.files import digests
from workload.queries import QUERIES


def test_files_are_read_in_blocks(spark, tmp_path):
    import pyarrow as pa

    content = bytes(range(256)) * 40_000  # more than two blocks
    (tmp_path / "a.json").write_bytes(content)
    rows = [r for b in digests(str(tmp_path), iter([pa.RecordBatch.from_pydict({"document": ["a.json"]})])) for r in b.to_pylist()]
    assert rows == [{"document": "a.json", "n_bytes": len(content), "sha256": hashlib.sha256(content).hexdigest()}]
    files = QUERIES["h04_document_files"](spark, "/root/testdata/sf0.001")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "content" not in plan
    assert files.count() == 2
