"""Tables in a folder behind a data source: written with commit and abort, scanned with pushed-down filters.

A table is a folder of Parquet files and a list of those that count (``manifest.json``), with the rows, row groups and
bounds of columns of each. Tasks write files of their own; the driver then replaces the list, by one rename. So a
failed write leaves the old table, and readers see one version or the other. Files of earlier versions stay until
``sweep``, as readers may still be at them.

A scan is planned from the list: files and row groups whose bounds exclude a filter are left out, and the others
become splits of about ``splitBytes`` each, without being asked for a number of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)

from tillwatch.sinks.files import Written, at, exists, replace

MANIFEST = "manifest.json"
#: Options: bytes of row groups in a split, and rows of a written row group and file.
SPLIT_BYTES, GROUP_ROWS, FILE_ROWS = 64 << 20, 100_000, 1_000_000
#: Bounds and filters are compared for these types only; floating point has NaN, on which engines differ.
ORDERED = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DateType, T.StringType, T.DecimalType, T.BooleanType)


def manifest_of(path: str, table: str) -> dict | None:
    system, folder = at(path)
    name = f"{folder}/{table}/{MANIFEST}"
    if not exists(system, name):
        return None
    with system.open_input_stream(name) as f:
        return json.loads(f.read())


class TableNotWritten(LookupError):
    """The folder has no table of that name."""


class Warehouse(DataSource):
    """``format("warehouse").option("path", folder).option("dbtable", name)``; ``columns`` (comma-separated) reads some only."""

    @classmethod
    def name(cls) -> str:
        return "warehouse"

    def _known(self) -> dict:
        found = manifest_of(self.options["path"], self.options["dbtable"])
        if found is None:
            raise TableNotWritten(self.options["dbtable"])
        return found

    def schema(self) -> T.StructType:
        whole = T.StructType.fromJson(self._known()["schema"])
        wanted = self.options.get("columns")
        return T.StructType([whole[c.strip()] for c in wanted.split(",")]) if wanted else whole

    def reader(self, schema: T.StructType) -> Scan:
        return Scan(self.options["path"], self.options["dbtable"], schema, self._known(), int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        rows = int(self.options.get("groupRows", GROUP_ROWS)), int(self.options.get("fileRows", FILE_ROWS))
        return Writer(self.options["path"], self.options["dbtable"], schema, overwrite, *rows)


@dataclass
class Groups(InputPartition):
    """Row groups of a file."""

    file: str
    numbers: list[int]


def _value(value):
    """Bounds are kept as text; both sides are compared as their types say."""
    return value.isoformat() if hasattr(value, "isoformat") else str(value) if value.__class__.__name__ == "Decimal" else value


def _typed(value, kind: T.DataType):
    from datetime import date
    from decimal import Decimal

    if value is None:
        return None
    if isinstance(kind, T.DateType):
        return date.fromisoformat(value) if isinstance(value, str) else value
    return Decimal(value) if isinstance(kind, T.DecimalType) else value


class Scan(DataSourceReader):
    def __init__(self, path: str, table: str, schema: T.StructType, manifest: dict, split_bytes: int):
        self.path, self.table, self.schema, self.manifest, self.split_bytes = path, table, schema, manifest, split_bytes
        self.kinds = {f.name: f.dataType for f in schema.fields}
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        simple = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for f in filters:
            kind = self.kinds.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, IsNull | IsNotNull) and kind is not None or isinstance(f, simple) and isinstance(kind, ORDERED):
                self.filters.append(f)
            else:
                yield f

    def _may_hold(self, group: dict) -> bool:
        for f in self.filters:
            name = f.attribute[0]
            nulls, low, high = group["bounds"].get(name, (None, None, None))
            if isinstance(f, IsNull):
                if nulls == 0:
                    return False
                continue
            if nulls is not None and nulls == group["rows"]:
                return False
            if low is None or isinstance(f, IsNotNull):
                continue
            low, high = (_typed(x, self.kinds[name]) for x in (low, high))
            if isinstance(f, In):
                if not any(v is not None and low <= v <= high for v in f.value):
                    return False
            elif isinstance(f, EqualTo) and not low <= f.value <= high:
                return False
            elif isinstance(f, GreaterThan) and high <= f.value or isinstance(f, GreaterThanOrEqual) and high < f.value:
                return False
            elif isinstance(f, LessThan) and low >= f.value or isinstance(f, LessThanOrEqual) and low > f.value:
                return False
        return True

    def partitions(self) -> list[Groups]:
        out = []
        for file in self.manifest["files"]:
            numbers, size = [], 0
            for i, group in enumerate(file["groups"]):
                if not self._may_hold(group):
                    continue
                if numbers and size + group["bytes"] > self.split_bytes:
                    out.append(Groups(file["name"], numbers))
                    numbers, size = [], 0
                numbers.append(i)
                size += group["bytes"]
            if numbers:
                out.append(Groups(file["name"], numbers))
        return out or [Groups("", [])]

    def read(self, partition: Groups) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        names = [f.name for f in self.schema.fields]
        if not partition.file:
            yield pa.RecordBatch.from_pylist([], schema=to_arrow_schema(self.schema))
            return
        system, folder = at(self.path)
        with system.open_input_file(f"{folder}/{self.table}/{partition.file}") as raw:
            file = pq.ParquetFile(raw)
            for batch in file.iter_batches(row_groups=partition.numbers, columns=names):
                keep = None
                for f in self.filters:
                    column = batch.column(f.attribute[0])
                    mask = self._matches(pc, pa, column, f)
                    keep = mask if keep is None else pc.and_kleene(keep, mask)
                batch = batch if keep is None else batch.filter(keep)
                if batch.num_rows:
                    yield batch.select(names)

    @staticmethod
    def _matches(pc, pa, column, f: Filter):
        if isinstance(f, IsNull):
            return pc.is_null(column)
        if isinstance(f, IsNotNull):
            return pc.is_valid(column)
        if isinstance(f, In):
            return pc.is_in(column, value_set=pa.array([v for v in f.value if v is not None], column.type))
        compare = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}
        return compare[type(f)](column, pa.scalar(f.value, column.type))


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, table: str, schema: T.StructType, overwrite: bool, group_rows: int, file_rows: int):
        self.path, self.table, self.schema, self.overwrite = path, table, schema, overwrite
        self.group_rows, self.file_rows, self.version = group_rows, file_rows, uuid.uuid4().hex

    def write(self, iterator: Iterable) -> Written:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        system, folder = at(self.path)
        system.create_dir(f"{folder}/{self.table}/{self.version}", recursive=True)
        schema, files = to_arrow_schema(self.schema), []
        out = metadata = None
        held, n, in_file = [], 0, 0

        def flush() -> None:
            nonlocal out, metadata, held, n, in_file
            import pyarrow as pa

            if not n:
                return
            if out is None:
                files.append({"name": f"{self.version}/{uuid.uuid4().hex}.parquet"})
                metadata = []
                out = pq.ParquetWriter(f"{folder}/{self.table}/{files[-1]['name']}", schema, filesystem=system, metadata_collector=metadata)
            out.write_table(pa.Table.from_batches(held).cast(schema), row_group_size=n)
            held, n, in_file = [], 0, in_file + n
            if in_file >= self.file_rows:
                close()

        def close() -> None:
            nonlocal out, in_file
            if out is not None:
                out.close()
                files[-1]["groups"] = self._groups(metadata[0])
                out, in_file = None, 0

        for batch in iterator:
            for a in range(0, batch.num_rows, self.group_rows):
                part = batch.slice(a, self.group_rows)
                if n and n + part.num_rows > self.group_rows:
                    flush()
                held.append(part)
                n += part.num_rows
        flush()
        close()
        return Written(files)

    def _groups(self, metadata) -> list[dict]:
        ordered = {f.name for f in self.schema.fields if isinstance(f.dataType, ORDERED)}
        out = []
        for i in range(metadata.num_row_groups):
            group = metadata.row_group(i)
            bounds = {}
            for j in range(group.num_columns):
                column = group.column(j)
                stats = column.statistics
                if column.path_in_schema in {f.name for f in self.schema.fields} and stats is not None and stats.has_null_count:
                    known = column.path_in_schema in ordered and stats.has_min_max
                    bounds[column.path_in_schema] = (stats.null_count, *((_value(stats.min), _value(stats.max)) if known else (None, None)))
            out.append({"rows": group.num_rows, "bytes": group.total_byte_size, "bounds": bounds})
        return out

    def commit(self, messages) -> None:
        system, folder = at(self.path)
        files = [f for m in messages if m for f in m.files]
        before = None if self.overwrite else manifest_of(self.path, self.table)
        if before is not None:
            files = before["files"] + files
        text = json.dumps({"schema": self.schema.jsonValue(), "files": files})
        system.create_dir(f"{folder}/{self.table}/{self.version}", recursive=True)
        staged = f"{folder}/{self.table}/{self.version}/{MANIFEST}"
        with system.open_output_stream(staged) as f:
            f.write(text.encode())
        replace(system, staged, f"{folder}/{self.table}/{MANIFEST}")

    def abort(self, messages) -> None:
        from pyarrow import fs

        system, folder = at(self.path)
        mine = f"{folder}/{self.table}/{self.version}"
        if system.get_file_info(mine).type == fs.FileType.Directory:
            system.delete_dir(mine)


def sweep(path: str, table: str) -> int:
    """Delete files that the list no longer names, and say how many; for times at which nobody reads or writes the table."""
    from pyarrow import fs

    system, folder = at(path)
    found = manifest_of(path, table)
    named = {f["name"] for f in found["files"]} if found else set()
    gone = 0
    for info in system.get_file_info(fs.FileSelector(f"{folder}/{table}", recursive=True)):
        name = "/".join(info.path.split("/")[-2:])
        if info.is_file and info.base_name.endswith(".parquet") and name not in named:
            system.delete_file(info.path)
            gone += 1
    return gone


def register(spark) -> None:
    spark.dataSource.register(Warehouse)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
