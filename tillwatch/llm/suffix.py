"""Repeated substrings by two-stage suffix sorting.

A byte goes if a string of ``length`` (400) bytes that covers it starts anywhere else, too. Equal strings
have the same lowest hash of their ``gram``-byte parts at the same place, so this anchor is their
meeting place: runs of windows with one anchor are segments, and two equal windows lie in segments of one
anchor. Equal segments are counted, not moved. Only different segments of one anchor are compared:
one copy of each goes to the task of its anchor, which sorts the suffixes of a block of segments.

Two-stage sorting: a suffix smaller than its successor is sorted directly, by its first ``length``
bytes; the order of the others is induced by scanning the buckets of first bytes upwards, each suffix
putting its predecessor behind those that its bucket has. Windows whose prefix with an adjacent
suffix is ``length`` long or more are repeated.

Anchors with more than ``hot`` different segments are spread: their windows are counted by hash,
which combines before the shuffle. Equality of windows that are compared by hash rests on 128 bits.

Exact copies of a text are taken as one; where there are several, all of it goes if it is as long
as a window. Null and empty texts have no bytes, and nothing goes. Rows with repeated or null ids are
rows like others. Results don't depend on order. An empty table gives an empty one.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, small_batches, unused
from .wordhash import BASE, INVERSE, mix, powers

LENGTH, GRAM, HOT = 400, 24, 2048
#: Bytes of a text that are cut into segments at once, and of segments that are sorted together.
AT_ONCE, BLOCK = 1 << 20, 2 << 20
BASE2 = np.uint64(0xD1342543DE82EF95)
INVERSE2 = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
#: Does not occur in UTF-8.
BETWEEN = 0xFF


def key(text: Column) -> Column:
    """16 bytes of the SHA-256 of a text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def _sums(data: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), base), out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray | slice, end, inverse: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * inverse[start])


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, content hash, first window, last window) of the runs of windows with one anchor."""
    parts = []
    for at in range(0, max(len(data) - length + 1, 0), AT_ONCE):
        parts.append(_segments(data[at : at + AT_ONCE + length - 1], at, length, gram))
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _segments(data: np.ndarray, at: int, length: int, gram: int):
    sums, inverse = _sums(data, BASE), powers(len(data) + 1, INVERSE)
    n = len(data) - gram + 1
    grams = _hashes(sums, slice(0, n), slice(gram, gram + n), inverse)
    # the lowest 40 bits of hash, then the leftmost place, over each window's grams: minima of blocks from either end
    width = length - gram + 1
    rows = -(-n // width)
    low = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    low[:n] = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
    low = low.reshape(rows, width)
    ahead = np.minimum.accumulate(low, axis=1).ravel()
    behind = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(data) - length + 1
    anchor = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
    last = np.concatenate((first[1:] - 1, [count - 1]))
    content = _hashes(sums, first, last + length, inverse) ^ mix((last - first).astype(np.uint64))
    return grams[anchor[first]], content, first + at, last + at


def _cut(length: int, gram: int):
    def run(batches):
        for batch in batches:
            found = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                part = segments(np.frombuffer(text.encode(), dtype=np.uint8), length, gram)
                found[0].append(np.full(len(part[0]), i))
                for c, v in zip(found[1:], part):
                    c.append(v)
            row, anchor, content, first, last = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(row, pa.int64())), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(first.astype(np.int64)), pa.array((last - first).astype(np.int32)), batch.column("copies").take(pa.array(row, pa.int64()))],
                names=["doc", "anchor", "content", "first", "more", "copies"],
            )

    return run


def _fetch(length: int):
    """The bytes of the wanted segments of each text."""

    def run(batches):
        for batch in batches:
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                data = text.encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["anchor"] for w in wanted], pa.int64()), pa.array([w["content"] for w in wanted], pa.int64()), pa.array([w["hot"] for w in wanted], pa.bool_()),
                     pa.array([data[w["first"] : w["first"] + w["more"] + length] for w in wanted], pa.binary())],
                    names=["anchor", "content", "hot", "bytes"],
                )

    return run


def _together(batches, size: int = 5000):
    """Small batches made into larger ones."""
    rows, n = [], 0
    for batch in batches:
        rows.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            rows, n = [], 0
    if n:
        yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]


def big_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, and from the end, as a number that sorts like them; zeros behind the end."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    for k in range(min(8, len(data))):
        out[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def sorted_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes that begin at ``at``, sorted by their first ``depth`` bytes. Only ties are read on, and only those that differ are sorted again."""
    out = at[np.argsort(words[at], kind="stable")]
    rank = np.arange(len(out))
    place = rank
    w = words[out]
    group = np.cumsum(np.concatenate(([0], (w[1:] != w[:-1]).astype(np.int64)))) if len(out) else rank
    for d in range(8, depth, 8):
        size = np.bincount(group)
        tied = size[group] > 1
        if not tied.all():
            place, group = place[tied], group[tied]
        if not len(place):
            break
        group = np.concatenate(([0], np.cumsum(group[1:] != group[:-1])))
        here = out[place]
        w = words[np.minimum(here + d, len(words) - 1)]
        apart = (w[1:] != w[:-1]) & (group[1:] == group[:-1])
        if not apart.any():
            continue
        split = np.zeros(group[-1] + 1, dtype=bool)
        split[group[1:][apart]] = True
        some = np.flatnonzero(split[group])
        order = some[np.lexsort((w[some], group[some]))]
        out[place[some]] = here[order]
        w[some] = w[order]
        group = np.cumsum(np.concatenate(([0], ((w[1:] != w[:-1]) | (group[1:] != group[:-1])).astype(np.int64))))
    return out


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes, sorted by their first ``depth`` bytes."""
    n = len(data)
    step = np.sign(np.diff(data.astype(np.int16), append=-1))
    # of equal bytes, the next that differs decides; the last suffix is larger than the empty one behind it
    decides = np.where(step != 0, np.arange(n), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    small = step[decides] > 0
    direct = sorted_directly(np.flatnonzero(small), big_words(data), depth)
    byte = data[direct]
    begins = np.searchsorted(byte, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        new = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        have = [new]
        while len(new):  # predecessors with the same byte stand in the same bucket, behind
            new = new[new > 0] - 1
            new = new[(data[new] == c) & ~small[new]]
            have.append(new)
        bucket = np.concatenate([*have, direct[begins[c] : begins[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (data[before] > c)]
        if len(before):
            byte_before = data[before]
            order = np.argsort(byte_before, kind="stable")
            cuts = np.flatnonzero(np.diff(byte_before[order])) + 1
            for part in np.split(before[order], cuts):
                induced[data[part[0]]].append(part)
    return np.concatenate(out)


def repeated(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string, which of its windows occur in another place of any of them."""
    sizes = np.array([len(p) for p in parts])
    data = np.full(int(sizes.sum()) + len(parts), BETWEEN, dtype=np.uint8)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
    for b, p in zip(begins, parts):
        data[b : b + len(p)] = np.frombuffer(p, dtype=np.uint8)
    windows = np.zeros(len(data), dtype=bool)
    for b, n in zip(begins, sizes):
        windows[b : b + n - length + 1] = True
    order = suffix_array(data, length)
    order = order[windows[order]]
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    a, b = order[:-1], order[1:]
    for base, inverse in ((BASE, INVERSE), (BASE2, INVERSE2)):
        sums, back = _sums(data, base), powers(len(data) + 1, inverse)
        h = _hashes(sums, order, order + length, back)
        same &= h[1:] == h[:-1]
    twice = np.zeros(len(data), dtype=bool)
    twice[a[same]] = twice[b[same]] = True
    return [twice[s : s + n - length + 1] for s, n in zip(begins, sizes)]


def runs(marks: np.ndarray) -> list[int]:
    """first, last, first, last ... of the runs of marked places."""
    edge = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1], axis=1).ravel().tolist()


def _sorted_blocks(length: int):
    """Rows come sorted by anchor; blocks end between anchors."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        found = repeated(rows["bytes"].to_pylist(), length)
        return pa.RecordBatch.from_arrays([rows["anchor"].combine_chunks(), rows["content"].combine_chunks(), pa.array([runs(m) for m in found], pa.list_(pa.int32()))], names=["anchor", "content", "windows"])

    def run(batches):
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part]).combine_chunks()
            while rest.num_rows:
                anchor = np.asarray(rest["anchor"])
                total = np.cumsum(np.asarray(pa.compute.binary_length(rest["bytes"])))
                if total[-1] < BLOCK:
                    break
                ends = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1  # whole anchors only
                full = ends[total[ends - 1] >= BLOCK]
                if not len(full):
                    if not len(ends):
                        break
                    full = ends[-1:]
                yield solve(rest.slice(0, int(full[0])))
                rest = rest.slice(int(full[0])).combine_chunks()
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return run


def _windows(length: int):
    """Hashes of all windows of a segment."""

    def run(batches):
        for batch in batches:
            for anchor, content, data in zip(batch.column("anchor").to_pylist(), batch.column("content").to_pylist(), batch.column("bytes").to_pylist()):
                raw = np.frombuffer(data, dtype=np.uint8)
                n = len(raw) - length + 1
                h = [_hashes(_sums(raw, b), slice(0, n), slice(length, length + n), powers(len(raw) + 1, i)).view(np.int64) for b, i in ((BASE, INVERSE), (BASE2, INVERSE2))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchor)), pa.array(np.full(n, content)), pa.array(np.arange(n, dtype=np.int32)), pa.array(h[0]), pa.array(h[1])], names=["anchor", "content", "at", "h1", "h2"])

    return lambda batches: _together(run(batches), 50_000)


def _cleaned(length: int):
    """What goes from each text, and the bytes that stay."""

    def run(batches):
        for batch in batches:
            left, places, n = [], [], [0]
            for text, copies, spans in zip(batch.column("text").to_pylist(), batch.column("copies").to_pylist(), batch.column("spans").to_pylist()):
                data = text.encode()
                found = []
                if copies > 1 and len(data) >= length:
                    found, data = [0, len(data) - 1], b""
                elif spans:
                    gone = np.zeros(len(data) + 1, dtype=np.int32)
                    for s in spans:
                        pairs = np.array(s["windows"], dtype=np.int64).reshape(-1, 2) + s["first"]
                        np.add.at(gone, pairs[:, 0], 1)
                        np.add.at(gone, pairs[:, 1] + length, -1)
                    marks = np.cumsum(gone[:-1]) > 0
                    found, data = runs(marks), np.frombuffer(data, dtype=np.uint8)[~marks].tobytes()
                left.append(data)
                places += found
                n.append(len(places) // 2)
            removed = pa.StructArray.from_arrays([pa.array(places[::2], pa.int64()), pa.array([p + 1 for p in places[1::2]], pa.int64())], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.ListArray.from_arrays(pa.array(n, pa.int32()), removed), pa.array(left, pa.binary())], names=["doc", "removed", "kept"])

    return run


def distinct_texts(docs: DataFrame) -> DataFrame:
    """doc (key), text, copies of each text, bucketed by key: later joins on it don't move texts."""
    spark = small_batches(docs).sparkSession
    rows = docs.select(key(F.col("text")).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.groupBy("doc").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc").saveAsTable(name)
    return spark.table(name)


def repeated_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc, spans (first window of a segment; first, last, ... of its repeated windows, from there) of the texts that have any."""
    cut = kept(texts.select("doc", "text", "copies").mapInArrow(_cut(length, gram), "doc binary, anchor long, content long, first long, more int, copies long"), "segments")
    one = F.min(F.struct("doc", "first", "more")).alias("one")
    kinds = kept(cut.groupBy("anchor", "content").agg(F.sum("copies").alias("n"), one), "segment-kinds")
    # segments that occur twice are repeated as a whole; only those that occur once need be compared, with all of their anchor
    met = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.min("n").alias("least"))
    met = kept(met.where("different > 1 AND least = 1").drop("least"), "anchors")
    mixed = kinds.join(met, "anchor").select("anchor", "content", "n", "one.*", (F.col("different") > hot).alias("hot"))
    wanted = mixed.groupBy("doc").agg(F.collect_list(F.struct("anchor", "content", "hot", "first", "more")).alias("wanted"))
    fetched = texts.select("doc", "text").join(wanted.hint("shuffle_hash"), "doc").select("text", "wanted")
    fetched = kept(fetched.mapInArrow(lambda b: _together(_fetch(length)(b)), "anchor long, content long, hot boolean, bytes binary"), "segment-bytes")
    cold = fetched.where("NOT hot").drop("hot").repartition("anchor").sortWithinPartitions("anchor")
    found = cold.mapInArrow(_sorted_blocks(length), "anchor long, content long, windows array<int>")
    spread = fetched.where("hot").select("anchor", "content", "bytes").mapInArrow(_windows(length), "anchor long, content long, at int, h1 long, h2 long")
    twice = kept(spread.groupBy("anchor", "h1", "h2").count().where("count > 1").drop("count"), "hot-windows")
    # windows of one segment; there are fewer of them than bytes between two anchors
    marked = spread.join(twice, ["anchor", "h1", "h2"]).groupBy("anchor", "content").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("windows"))
    compared = found.unionByName(marked).where(F.size("windows") > 0)
    # a segment that occurs twice as a whole is repeated as a whole
    whole = kinds.where("n > 1").select("anchor", "content", F.array(F.lit(0), F.col("one.more")).alias("windows"))
    marks = kept(compared.join(whole.select("anchor", "content"), ["anchor", "content"], "left_anti").unionByName(whole), "segment-windows")
    return cut.join(marks, ["anchor", "content"]).groupBy("doc").agg(F.collect_list(F.struct("first", "windows")).alias("spans"))


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per different text: doc (``key``), removed (start and end, in bytes, of each run that goes), kept (the bytes that stay; a cut may fall within a character)."""
    texts = distinct_texts(docs)
    spans = repeated_windows(texts, length, gram, hot)
    rows = texts.join(spans.hint("shuffle_hash"), "doc", "left").select("doc", "text", "copies", "spans")
    return rows.mapInArrow(_cleaned(length), "doc binary, removed array<struct<start:long,end:long>>, kept binary")


def clean(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The rows of ``docs`` with ``removed`` and ``kept`` of their texts (with underscores behind, if there are such columns)."""
    by, removed, left = (unused(name, docs.columns) for name in ("doc", "removed", "kept"))
    texts = kept(cleaned(docs, length, gram, hot), "cleaned").toDF(by, removed, left)
    return docs.withColumn(by, key(F.col("text"))).join(texts, by).drop(by)


def figures(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start:end of what goes, in bytes, comma-joined)."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    texts = cleaned(docs, length, gram, hot).select(
        "doc", (F.octet_length("kept") + n).alias("n_bytes"), n.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), spans.alias("spans")
    )
    return docs.select("doc_id", key(F.col("text")).alias("doc")).join(kept(texts, "removed"), "doc").drop("doc")


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``figures`` without spans."""
    return figures(docs, length, gram, hot).drop("spans")
