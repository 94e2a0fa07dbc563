"""Near-duplicate texts by SimHash, compared bit-sliced.

A fingerprint has a bit for each of the 64 bits of the XXH64 (seed 42) of the text's word
shingles, set if over half of them have it. Different fingerprints are linked at ``radius`` (3) or
fewer differing bits; equal ones always are.

Search: the 64 bits are cut into ``radius + 2`` blocks; two fingerprints within the radius agree in
two of them at least, so each pair of blocks is a key of buckets, and no link is missed. Within a
bucket, bit planes lie vertically: one 64-bit word holds one bit of 64 fingerprints, and
carry-save counters (ones, twos, four or more) add up 64 distances with seven bitwise operations a
plane. Queries whose 64-fold blocks have all left the radius are abandoned on the way.

Buckets of more than ``chunk`` fingerprints are cut into chunks, and each pair of chunks is a task of
its own; a bucket hands on a chain through each of its groups, not all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows and null
ids count as rows; a group's id is the smallest that is not null. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import bucket_tasks, kept, small_batches, unused
from .components import components

SEED = 42
RADIUS = 3
WORD_BITS = 64
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16


def fingerprint(text: str, size: int = 3) -> int:
    """SimHash of one text."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    if len(parts) <= size:
        return xxh64_intdigest(whole, SEED)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: 1 - size].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), AT_ONCE):
        hashes = np.array([xxh64_intdigest(whole[a:b], SEED) for a, b in zip(starts[at : at + AT_ONCE], ends[at : at + AT_ONCE])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((counts * 2 > len(starts)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, column: str = "fingerprint", size: int = 3, text: bool = False) -> DataFrame:
    """All columns of ``docs``, with or without ``text``, and the fingerprint of its text as a signed number (replacing a column of that name)."""
    docs = small_batches(docs.drop(column))
    names = [c for c in docs.columns if text or c != "text"]

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t or "", size) for t in batch.column("text").to_pylist()), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found.view(np.int64))], names=[*names, column])

    return docs.mapInArrow(run, StructType([*(docs.schema[c] for c in names), StructField(column, LongType())]))


def planes(fp: np.ndarray) -> np.ndarray:
    """(64, words): bit b of fingerprint i is bit i % 64 of word i // 64 of row b."""
    bits = np.unpackbits(np.ascontiguousarray(fp, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    words = -(-len(fp) // WORD_BITS)
    packed = np.zeros((64, words * 8), dtype=np.uint8)
    packed[:, : -(-len(fp) // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return packed.view("<u8")


def unpacked(mask: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(mask).view(np.uint8), axis=-1, bitorder="little")[..., :n].view(bool)


class Counters:
    """Carry-save counters of differing bits: exact up to three, then over the radius."""

    def __init__(self, shape):
        self.ones, self.twos, self.over = (np.zeros(shape, dtype=np.uint64) for _ in range(3))

    def add(self, x: np.ndarray) -> None:
        carry = self.ones & x
        self.ones ^= x
        self.over |= self.twos & carry
        self.twos ^= carry

    def keep(self, rows: np.ndarray) -> None:
        self.ones, self.twos, self.over = self.ones[rows], self.twos[rows], self.over[rows]


def within(queries: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of queries that are left, their masks over the members) after all planes."""
    rows, count = np.arange(len(queries)), Counters((len(queries), members.shape[1]))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for b in range(64):
        flip = np.where((queries[rows] >> np.uint64(b)) & np.uint64(1), full, np.uint64(0))
        count.add(members[b][None, :] ^ flip[:, None])
        if b % 8 == 7:
            alive = (count.over != full).any(axis=1)
            if not alive.any():
                return rows[:0], count.over[:0]
            if alive.mean() < 0.7:
                rows = rows[alive]
                count.keep(alive)
    return rows, ~count.over


class Forest:
    """Groups of row numbers, joined by many pairs at once."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.of[i], self.of[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while (self.of[self.of] != self.of).any():
                self.of = self.of[self.of]


def bucket_chains(fp: np.ndarray, bounds: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chains through the groups within each bucket [bounds[k], bounds[k + 1]). Rows of unlike sides are compared where a bucket has two sides, else all."""
    n, forest = len(fp), Forest(len(fp))
    sizes = np.diff(bounds)
    end = np.repeat(bounds[1:], sizes)
    small = np.repeat(sizes <= WORD_BITS, sizes) & np.repeat(sizes > 1, sizes)
    if small.any():
        at = np.flatnonzero(small)
        p = planes(fp[at])
        left = end[at] - at
        after = np.concatenate([p[:, 1:], np.zeros((64, 1), np.uint64)], axis=1)
        two = np.repeat(np.add.reduceat(side, bounds[:-1]) % np.maximum(sizes, 1) > 0, sizes)[at] if len(sizes) else np.zeros(0, bool)
        for d in range(1, int(left.max())):
            ok = left > d
            if not ok.any():
                break
            count = Counters(p.shape[1])
            for b in range(64):
                shifted = (p[b] >> np.uint64(d)) | (after[b] << np.uint64(64 - d)) if d < 64 else after[b]
                count.add(p[b] ^ shifted)
            i = np.flatnonzero(unpacked(~count.over, len(at)) & ok)
            i = i[~two[i] | (side[at[i]] != side[at[np.minimum(i + d, len(at) - 1)]])]
            forest.join(at[i], at[i] + d)
    for k in np.flatnonzero(sizes > WORD_BITS):
        a, z = int(bounds[k]), int(bounds[k + 1])
        s = side[a:z]
        two = 0 < s.sum() < z - a
        members = np.flatnonzero(s) if two else np.arange(z - a)
        asking = np.flatnonzero(~s.astype(bool)) if two else members
        p = planes(fp[a:z][members])
        for at in range(0, len(asking), WORD_BITS):
            q = asking[at : at + WORD_BITS]
            rows, mask = within(fp[a:z][q], p)
            if len(rows):
                i, j = np.nonzero(unpacked(mask, len(members)))
                forest.join(a + q[rows[i]], a + members[j])
    # a chain through each group of each bucket
    order = np.lexsort((np.arange(n), forest.of))
    same = forest.of[order][1:] == forest.of[order][:-1]
    return fp[order[:-1][same]], fp[order[1:][same]]


def _chains(batches):
    """Rows come sorted by bucket; a bucket may go on in the next batch."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch]).combine_chunks()
        rest = part if rest is None else pa.concat_tables([rest, part]).combine_chunks()
        if rest.num_rows < 200_000:
            continue
        last = np.asarray(rest["task"])
        cut = int(np.searchsorted(last, last[-1]))
        if cut:
            yield _linked(rest.slice(0, cut))
            rest = rest.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield _linked(rest)


def _linked(rows: pa.Table) -> pa.RecordBatch:
    task = np.asarray(rows["task"])
    bounds = np.concatenate(([0], np.flatnonzero(task[1:] != task[:-1]) + 1, [len(task)]))
    a, b = bucket_chains(np.asarray(rows["fp"]).view(np.uint64), bounds, np.asarray(rows["side"]).astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def masks(radius: int = RADIUS) -> list[int]:
    """Of each pair of blocks, the bits."""
    n = radius + 2
    edges = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [((1 << (z - a)) - 1) << a for a, z in zip(edges, edges[1:])]
    return [blocks[i] | blocks[j] for i in range(n) for j in range(i)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, chunk: int = 4096) -> DataFrame:
    """Chains (a, b) whose groups are those of all pairs within the radius, from distinct fingerprints (fp: long)."""
    keys = F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks())))
    rows = fps.select("fp", F.explode(keys).alias("bucket"))
    rows = bucket_tasks(rows, "fp", chunk)
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(_chains, "a long, b long")


def groups(docs: DataFrame, size: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (signed number), component_id."""
    rows = kept(fingerprints(docs.select("doc_id", "text"), size=size), "fingerprints")
    return rows.join(grouped(rows), "fingerprint").drop("label")


def grouped(rows: DataFrame) -> DataFrame:
    """fingerprint, label of its group, component_id: for each fingerprint of rows of doc_id and fingerprint."""
    first = kept(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    label = components(links(first.select("fp"))).withColumnRenamed("node", "fp")
    known = kept(first.join(label, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label")), "labelled")
    least = kept(known.groupBy("label").agg(F.min("first").alias("component_id")), "least")
    return kept(known.join(least, "label").select(F.col("fp").alias("fingerprint"), "label", "component_id"), "groups")


def one_of_each(docs: DataFrame, size: int = 3) -> DataFrame:
    """All columns of one row of each group: that of the smallest doc_id; of rows that repeat this id, one of the smallest fingerprint."""
    rows = kept(fingerprints(docs.select("doc_id", "text"), size=size), "fingerprints")
    of_group = rows.join(grouped(rows), "fingerprint").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = of_group.groupBy("label").agg(F.first("doc_id").alias("doc_id"), F.min("fingerprint").alias("fp"))
    often = rows.groupBy(F.col("doc_id").alias("other")).count()
    own, fp = unused("kept_id", docs.columns), unused("kept_fp", docs.columns)
    stays = stays.join(often, F.col("doc_id").eqNullSafe(F.col("other"))).select(F.col("doc_id").alias(own), F.col("fp").alias(fp), (F.col("count") > 1).alias("repeats"))
    stays = kept(stays, "stays")
    once, again = stays.where("NOT repeats").select(own), stays.where("repeats").select(own, fp)
    same = docs["doc_id"].eqNullSafe(F.col(own))
    single = docs.join(once, same, "left_semi")
    if again.isEmpty():
        return single
    print_of = unused("print", docs.columns)
    some = fingerprints(docs.join(again.select(own).distinct(), same, "left_semi"), print_of, size, text=True)
    some = some.join(again, some["doc_id"].eqNullSafe(F.col(own)) & (F.col(print_of) == F.col(fp)), "left_semi")
    return single.unionByName(some.dropDuplicates(["doc_id", print_of]).select(*docs.columns))
