"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing: a record is text, and records end in two line ends, so the text writer with that line
separator makes WARC files through Spark's commit protocol, in any store that Spark writes to. Of
records with equal payloads one is a response, that with the largest page_id; the others revisit it.

Reading (format "warc"): partitions are files. Filters on record_type and on header columns
are pushed down: the header of a record is parsed first, and the block of one that isn't wanted, or
whose payload isn't asked for (option payload=false), is skipped without being read or decoded.

Null html is an empty payload, which is deduplicated like any other. A null url leaves out the
target; line ends in one are percent-encoded. Rows that repeat the largest page_id of a payload are
all responses; null ids are smaller than any other. An empty table gives archives without records.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith

from .common import kept

END = "\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 hexadecimal digits are eight groups of 20 bits, each four digits of base 32."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, n_bytes, refers_to (null for responses)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), base32_sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"))
    # only payloads that repeat; where these are few, Spark sends them to the pages instead of shuffling payloads
    last = rows.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    last = kept(last.where("n > 1").select("digest", "last"), "payloads")
    revisits = (F.col("n_bytes") >= least_bytes) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(last, "digest", "left").select("page_id", "url", "payload", "digest", "n_bytes", F.when(revisits, F.col("last")).alias("refers_to"))


def record(page_id="page_id") -> Column:
    """The text of a record, but for the two line ends that end it."""
    response = F.col("refers_to").isNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END * 2))
    block = F.concat(http, F.when(response, F.col("payload")).otherwise(F.lit("")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    uri = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.when(response, F.lit("WARC-Type: response")).otherwise(F.lit("WARC-Type: revisit")),
        F.concat(F.lit("WARC-Record-ID: "), uri(F.col(page_id))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(~response, F.concat(F.lit(f"WARC-Profile: {PROFILE}{END}WARC-Refers-To: "), uri(F.col("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END * 2), block)  # concat_ws leaves out nulls


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """One record for each row of page_id, url, html."""
    with_roles(pages, least_bytes).select(record().alias("value")).write.option("lineSep", END * 2).text(path)


@dataclass
class File(InputPartition):
    path: str


#: Columns that headers give, and their header.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", http_length long, payload binary"
BATCH_BYTES = 4 << 20


class Warc(DataSource):
    """spark.read.format("warc").load(folder or file); option payload: false leaves payloads out."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("payload", "true") != "false")


def accepts(kind: type, value, got: str | None) -> bool:
    if got is None:
        return False
    return {EqualTo: lambda: got == value, In: lambda: got in value, StringStartsWith: lambda: got.startswith(value), IsNotNull: lambda: True}[kind]()


class Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.wanted = path, payload, []

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            known = isinstance(f, EqualTo | In | StringStartsWith | IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in HEADERS
            if known:
                self.wanted.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[File]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.path)
        info = system.get_file_info(path)
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(path))
        return [File(f.path) for f in files if f.is_file and f.size and not f.base_name.startswith(("_", "."))] or [File("")]

    def read(self, partition: File):
        import pyarrow as pa
        from pyarrow import fs

        rows, size = [], 0
        kinds = [pa.string()] * len(HEADERS) + [pa.int64(), pa.binary()]
        names = [*HEADERS, "http_length", "payload"]

        def batch():
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        if partition.path:
            system, _ = fs.FileSystem.from_uri(self.path)
            with system.open_input_file(partition.path) as raw:
                for one in records(io.BufferedReader(raw, 1 << 20), self.wanted, self.payload):
                    rows.append(one)
                    size += 500 + len(one[-1] or b"")
                    if size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        yield batch()


def headers(stream) -> dict[str, str]:
    """Lines up to an empty one; a line that begins with a blank goes on from the one before."""
    found: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and name:
            found[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def records(stream, wanted, payload: bool) -> Iterator[tuple]:
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue  # the two line ends behind a record
        head = headers(stream)
        length = int(head.get("content-length") or 0)
        values = {c: head.get(h) for c, h in HEADERS.items()}
        if not all(accepts(kind, value, values[c]) for c, kind, value in wanted):
            stream.seek(length, io.SEEK_CUR)
            continue
        end, body, http_length = stream.tell() + length, None, None
        if head.get("content-type", "").startswith("application/http"):
            stream.readline()  # the status
            http = headers(stream)
            http_length = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        if payload and values["record_type"] != "revisit":
            body = stream.read(end - stream.tell())
        stream.seek(end)
        yield (*values.values(), http_length, body)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def pages(archive: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of archives that ``write`` made. Responses are measured anew; revisits carry the figures of the payload that they refer to."""
    page = lambda c: F.regexp_extract(c, f"<{ID}(-?[0-9]*)>", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    has = F.col("payload").isNotNull()
    return archive.select(
        number("record_id").alias("page_id"),
        F.when(has, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(has, base32_sha1(F.col("payload"))).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), number("refers_to")).alias("refers_to"),
    )
