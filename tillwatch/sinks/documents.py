"""Weekly documents as one named JSON file each, written entry by entry."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from tillwatch.sinks.files import Written, at, drop_staged, replace, staged_name

#: Columns of an entry: its place in the document, and its JSON text. Kind 0 is a flag, 1 a receipt.
ENTRY = "year int, weeknumber int, store_nr int, kpi_id int, kind int, entry string"
BUFFER = 1 << 20


def file_name(year: int, week: int) -> str:
    """The form is a fixed value."""
    return f"dbp_{year}_{week}.json"


class Document:
    """JSON of one week as its entries come, sorted by store, KPI and kind; only the place is remembered."""

    def __init__(self, write: Callable[[str], None], year: int, week: int, indent: int | None):
        self.write, self.indent = write, indent
        self.store = self.kpi = None
        self.kind, self.first = 0, True
        write("{")
        self._line(1)
        write(f'"year"{self._colon()}{year},')
        self._line(1)
        write(f'"weeknumber"{self._colon()}{week},')
        self._line(1)
        write(f'"evaluation"{self._colon()}[')

    def _colon(self) -> str:
        return ":" if self.indent is None else ": "

    def _line(self, depth: int) -> None:
        if self.indent is not None:
            self.write("\n" + " " * (self.indent * depth))

    def _list(self, name: str, text: str = "") -> None:
        self.write(f'{text}"{name}"{self._colon()}[')
        self.first = True

    def _end_list(self, depth: int) -> None:
        if not self.first:
            self._line(depth)
        self.write("]")

    def add(self, store: int, kpi: int, kind: int, entry: str) -> None:
        if store != self.store:
            self._end_store()
            if self.store is not None:
                self.write(",")
            self._line(2)
            self.write("{")
            self._line(3)
            self.write(f'"StoreID"{self._colon()}"{store}",')
            self._line(3)
            self._list("KPI")
            self.store = store
        if kpi != self.kpi:
            started = self.kpi is not None
            self._end_kpi()
            if started:
                self.write(",")
            self._line(4)
            self.write("{")
            self._line(5)
            self.write(f'"KPITypeID"{self._colon()}{kpi},')
            self._line(5)
            self._list("Anomalies")
            self.kpi, self.kind = kpi, 0
        if kind != self.kind:
            self._receipts()
        if not self.first:
            self.write(",")
        self._line(6)
        self.write(entry if self.indent is None else self._indented(entry))
        self.first = False

    def _indented(self, entry: str) -> str:
        text = json.dumps(json.loads(entry), indent=self.indent, ensure_ascii=False)
        return text.replace("\n", "\n" + " " * (6 * self.indent))

    def _receipts(self) -> None:
        self._end_list(5)
        self.write(",")
        self._line(5)
        self._list("Receipts")
        self.kind = 1

    def _end_kpi(self) -> None:
        if self.kpi is None:
            return
        if self.kind == 0:
            self._receipts()
        self._end_list(5)
        self._line(4)
        self.write("}")
        self.kpi = None

    def _end_store(self) -> None:
        if self.store is None:
            return
        self._end_kpi()
        self._line(3)
        self.write("]")
        self._line(2)
        self.write("}")

    def end(self) -> None:
        empty = self.store is None
        self._end_store()
        if not empty:
            self._line(1)
        self.write("]")
        self._line(0)
        self.write("}")


class NamedDocuments(DataSource):
    """``df.write.format("weekly_documents").save(folder)``: rows like ENTRY, all of a week in one partition and sorted. Option ``indent``."""

    @classmethod
    def name(cls) -> str:
        return "weekly_documents"

    def schema(self) -> str:
        return ENTRY

    def writer(self, schema, overwrite: bool) -> Writer:
        indent = self.options.get("indent")
        return Writer(self.options["path"], int(indent) if indent else None)


class Writer(DataSourceArrowWriter):
    """Tasks write files under names of their own; the driver renames those of the tasks that count, so a week's file is replaced at once or not at all."""

    def __init__(self, path: str, indent: int | None):
        self.path, self.indent, self.job = path, indent, uuid.uuid4().hex

    def write(self, iterator: Iterable) -> Written:
        import io

        system, folder = at(self.path)
        files, week, document, out = [], None, None, None

        def close() -> None:
            if document is not None:
                document.end()
                out.close()

        for batch in iterator:
            columns = [batch.column(c.split()[0]).to_pylist() for c in ENTRY.split(", ")]
            for year, number, store, kpi, kind, entry in zip(*columns):
                if (year, number) != week:
                    close()
                    week, name = (year, number), staged_name(folder, self.job)
                    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    out = io.TextIOWrapper(io.BufferedWriter(system.open_output_stream(name), BUFFER), encoding="utf-8", newline="")
                    document = Document(out.write, year, number, self.indent)
                    files.append((name, file_name(year, number)))
                document.add(store, kpi, kind, entry)
        close()
        return Written(files)

    def commit(self, messages) -> None:
        system, folder = at(self.path)
        for message in messages:
            for staged, name in message.files if message else ():
                replace(system, staged, f"{folder}/{name}")
        drop_staged(system, folder, self.job)

    def abort(self, messages) -> None:
        system, folder = at(self.path)
        drop_staged(system, folder, self.job)
