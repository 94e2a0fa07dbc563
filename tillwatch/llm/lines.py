"""Lines that many documents share, as keep bitmaps of documents.

The key of a line is the line without white space at its ends, in small letters (A-Z). A key of at least
``least_chars`` code points that at least ``least_docs`` documents hold loses its lines, except in the
document of the largest id that holds it. Keys are compared by hashes of 128 bits.

Hashes are dealt out by range and sorted by key, then document (largest first) and position. A task
streams its keys: the first document of a key is the one that keeps it; further lines go once
the third document has come. A key with very many lines lies in several ranges, since documents
and positions are part of the range; a task can't know whether its first key began before or its last
goes on, so lines of these two at most wait for a count over the tasks that hold them, which
combines before it is shuffled.

What is returned for a document is a compressed bitmap of its lines; texts stay where they are until
``kept_text`` applies it.

Null and empty texts are one empty line. Rows with the same id are one document for the counts, and each
gets the bitmap of its own text; rows without an id are one document, the smallest. Further columns
don't matter, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from .common import ascii_lower, kept

LEAST_CHARS, LEAST_DOCS = 20, 3
BLANKS = " \t\n\x0b\x0c\r"
#: What a task says of a line: its document holds the key; it goes; it goes if the key's documents in all tasks are enough.
HOLDS, GOES, WAITS = 0, 1, 2


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def key(line: Column) -> Column:
    line = F.btrim(line, F.lit(BLANKS))
    # small letters of all kinds are those of A-Z where there is nothing else
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(ascii_lower(line))


def keyed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """h1, h2 (of the key), doc_id, version (of the text), position of every line that is long enough."""
    text = text_of()
    lines = docs.select("doc_id", F.xxhash64(text).alias("version"), F.posexplode(split(text)).alias("position", "line"))
    lines = lines.withColumn("key", key(F.col("line"))).where(F.char_length("key") >= least_chars)
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "version", "position")


def _changes(column: pa.Array) -> np.ndarray:
    """Which values differ from the one before; the first counts as different."""
    n = len(column)
    out = np.ones(n, dtype=bool)
    if n > 1:
        a, b = column.slice(1), column.slice(0, n - 1)
        nulls = pc.xor(pc.is_null(a), pc.is_null(b))
        out[1:] = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | nulls.to_numpy(zero_copy_only=False)
    return out


def _stream(least_docs: int):
    def run(batches):
        head = None  # first key of the task
        rest = None  # lines of the last key so far: all of them, or one of each of its first documents if those are enough
        full = False  # the last key has enough documents

        def state(table: pa.Table, values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in table.columns), pa.array(values, pa.int8())], names=[*table.column_names, "state"])

        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            held = 0 if rest is None else rest.num_rows
            table = fresh if rest is None else pa.concat_tables([rest, fresh]).combine_chunks()
            h1, h2 = np.asarray(table["h1"]), np.asarray(table["h2"])
            if head is None:
                head = h1[0], h2[0]
            new_key = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            new_doc = _changes(table["doc_id"].combine_chunks()) | new_key
            begins = np.flatnonzero(new_key)
            run_of = np.cumsum(new_key) - 1
            doc_before = np.cumsum(new_doc)
            nth = doc_before - doc_before[begins][run_of]  # 0 for lines of the key's first document
            enough = np.maximum.reduceat(nth, begins) >= least_docs - 1
            first = (h1 == head[0]) & (h2 == head[1])
            last = run_of == run_of[-1]
            seen = np.arange(len(h1)) < held if full else np.zeros(len(h1), dtype=bool)  # told before
            goes = enough[run_of] & (nth > 0) & ~first & ~seen
            if goes.any():
                yield state(table.filter(pa.array(goes)), np.full(goes.sum(), GOES))
            # a first key that ended, and what was held of a last key that ended, are settled here
            waits = first & ~last
            if waits.any():
                yield state(table.filter(pa.array(waits)), np.where(seen[waits], HOLDS, WAITS))
            is_first = bool(first[-1])
            now_full = bool(enough[-1]) and not is_first
            if is_first:  # may be a key of many tasks: its lines wait, nothing is held
                tell = last & ~seen
                if tell.any():
                    yield state(table.filter(pa.array(tell)), np.full(tell.sum(), WAITS))
                keep = np.flatnonzero(last)[-1:]
                now_full = True
            elif now_full:
                keep = np.flatnonzero(last & new_doc & (nth < least_docs))
            else:
                keep = np.flatnonzero(last)
            rest, full = table.take(pa.array(keep)).combine_chunks(), now_full
        if rest is not None and rest.num_rows:
            yield state(rest, np.full(rest.num_rows, HOLDS if full else WAITS))

    return run


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, version, position of every line that goes."""
    lines = kept(keyed_lines(docs, least_chars), "lines")  # ranges are drawn from it, then it is read again
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "version", "position"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = dict(lines.dtypes)["doc_id"]
    told = kept(ranged.mapInArrow(_stream(least_docs), f"h1 long, h2 long, doc_id {kind}, version long, position int, state byte"), "line-states")
    ends = told.where(F.col("state") != GOES)
    held = ends.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
    # keys at the ends of tasks, at most two for each task: small enough to go to the lines, whose keys are hot
    held = F.broadcast(kept(held.where(F.col("docs") >= least_docs), "shared-ends"))
    late = ends.where(F.col("state") == WAITS).join(held, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    names = ["doc_id", "version", "position"]
    return told.where(F.col("state") == GOES).select(*names).unionByName(late.select(*names))


@F.pandas_udf(BinaryType())
def bitmap(n: pd.Series, dropped: pd.Series) -> pd.Series:
    """One bit for each of ``n`` lines, 1 if it stays; lowest bit first, compressed by zlib."""
    out = []
    for size, gone in zip(n, dropped):
        bits = np.ones(size, dtype=np.uint8)
        bits[np.asarray(gone, dtype=np.int64)] = 0
        out.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 9))
    return pd.Series(out, dtype=object)


@F.pandas_udf(StringType())
def _kept_lines(text: pd.Series, keep: pd.Series) -> pd.Series:
    out = []
    for t, k in zip(text, keep):
        if t is None or k is None:
            out.append(None)
            continue
        lines = t.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(k), dtype=np.uint8), count=len(lines), bitorder="little")
        out.append("\n".join([line for line, bit in zip(lines, bits.tolist()) if bit]))
    return pd.Series(out, dtype=object)


def kept_text(text: Column, keep: Column) -> Column:
    """What is left of a text; without a bitmap it stays as it is, null as empty."""
    some = F.when(keep.isNotNull(), text)
    return F.coalesce(_kept_lines(some, keep), text, F.lit(""))


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, text, n_lines, n_dropped and keep (null: all lines stay) for every row of ``docs``."""
    gone = dropped_lines(docs.select("doc_id", "text"), least_chars, least_docs)
    gone = kept(gone.groupBy("doc_id", "version").agg(F.collect_set("position").alias("dropped")), "dropped-lines")
    gone = gone.select(F.col("doc_id").alias("of"), F.col("version").alias("as"), "dropped")
    rows = docs.select("doc_id", "text", F.xxhash64(text_of()).alias("version"))
    rows = rows.join(gone, rows["doc_id"].eqNullSafe(gone["of"]) & (rows["version"] == gone["as"]), "left")
    rows = rows.withColumn("n_lines", F.size(split(text_of())).cast("long"))
    keep = F.when(F.col("dropped").isNotNull(), bitmap("n_lines", F.coalesce("dropped", F.array().cast("array<int>"))))
    return rows.select("doc_id", "text", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), keep.alias("keep"))
