"""Near-duplicate embeddings by randomised-rotation binary codes.

Vectors of equal values are one, with a count. A unit vector is rotated at random, and its code
is the signs of its coordinates; the stored factor is the inner product of vector and code.
The product of a code with another rotated vector, divided by the factor, is an unbiased estimate of the
cosine, and its error is below ``confidence * sqrt((1 - f^2) / f^2 / (d - 1))`` but for a chance that falls
exponentially with ``confidence``. Pairs whose upper bound is below the threshold are dropped;
the cosine of the others is computed anew in double precision and decides.

Candidates share at least one of ``bands`` keys of ``bits`` signs of random projections. At the
threshold a pair is found with the chance ``recall``; no pair is linked below it. A bucket of more than
``chunk`` vectors is cut into chunks, each pair of which is a task. A pair that shares several keys is
counted at the first. Tasks give numbers of links, and chains through groups instead of all pairs.

Vectors that are null or zero, or hold nulls or non-finite values, link with nothing; vectors
of different lengths are not compared. Repeated rows are rows like others, linked with each other; the
smallest id that is not null stands for a group. An empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_tasks, kept
from .components import components
from .simhash import Forest

THRESHOLD, BITS, BANDS, CHUNK, CONFIDENCE = 0.95, 14, 18, 2048, 4.0
SEED = 20_240_501
#: Queries that are compared at once.
AT_ONCE = 256


def recall(threshold: float = THRESHOLD, bits: int = BITS, bands: int = BANDS) -> float:
    """Chance that a pair of this cosine shares a key."""
    return 1 - (1 - (1 - math.acos(threshold) / math.pi) ** bits) ** bands


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def projections(d: int, bits: int, bands: int) -> np.ndarray:
    return np.random.default_rng(SEED - d).standard_normal((d, bits * bands))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _keys(bits: int, bands: int):
    """Vectors with their code, factor and keys."""

    def run(batches):
        for batch in batches:
            vectors = batch.column("v")
            lengths = np.diff(np.asarray(vectors.offsets))
            flat = np.asarray(vectors.flatten(), dtype=np.float64)
            starts = np.concatenate(([0], np.cumsum(lengths)))
            for d in np.unique(lengths):
                rows = np.flatnonzero(lengths == d)
                x = unit(np.stack([flat[starts[r] : starts[r] + d] for r in rows]))
                z = x @ rotation(d)
                code = np.packbits(z > 0, axis=1, bitorder="little")
                factor = np.abs(z).sum(axis=1) / math.sqrt(d)
                signs = (x @ projections(d, bits, bands) > 0).reshape(len(rows), bands, bits)
                keys = (signs << np.arange(bits)).sum(axis=2).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(rows)) for c in ("node", "n")]
                    + [pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in code], pa.binary()), pa.array(factor), pa.array(list(keys), pa.list_(pa.int32()))],
                    names=["node", "n", "x", "code", "factor", "keys"],
                )

    return run


def compare(x, code, factor, keys, weight, side, band: int, threshold: float, confidence: float) -> tuple[np.ndarray, Forest]:
    """Linked weight of each row of a task, and its groups. Pairs that share an earlier key are left to that one for counting."""
    n, d = x.shape
    z = (x @ rotation(d)).astype(np.float32)
    signs = np.unpackbits(code, axis=1, count=d, bitorder="little").astype(np.float32) * 2 - 1
    two = 0 < side.sum() < n
    asking = np.flatnonzero(side == 0) if two else np.arange(n)
    asked = np.flatnonzero(side == 1) if two else np.arange(n)
    bound = confidence * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(d - 1, 1)) if d > 1 else np.full(n, 2.0)
    scale = 1 / (math.sqrt(d) * factor)
    linked, forest = np.zeros(n, dtype=np.int64), Forest(n)
    for at in range(0, len(asking), AT_ONCE):
        q = asking[at : at + AT_ONCE]
        to = asked if two else asked[q[0] :]
        estimate = (z[q] @ signs[to].T) * scale[to] + bound[to]
        a, b = np.nonzero(estimate >= threshold)
        i, j = q[a], to[b]
        if not two:
            i, j = i[j > i], j[j > i]
        for first in range(0, len(i), 1 << 16):
            p, r = i[first : first + (1 << 16)], j[first : first + (1 << 16)]
            exact = np.einsum("ij,ij->i", x[p], x[r]) >= threshold
            p, r = p[exact], r[exact]
            forest.join(p, r)
            new = ~(keys[p, :band] == keys[r, :band]).any(axis=1)
            p, r = p[new], r[new]
            np.add.at(linked, p, weight[r])
            np.add.at(linked, r, weight[p])
    return linked, forest


def _tasks(threshold: float, confidence: float):
    """Rows come sorted by task: (node, linked weight, null) for counts, (node, null, node) for chains."""

    def one(rows: pa.Table):
        node, weight, side = (np.asarray(rows[c]) for c in ("node", "n", "side"))
        x = np.frombuffer(b"".join(rows["x"].to_pylist()), dtype=np.float64).reshape(len(node), -1)
        code = np.frombuffer(b"".join(rows["code"].to_pylist()), dtype=np.uint8).reshape(len(node), -1)
        keys = np.asarray(rows["keys"].combine_chunks().flatten()).reshape(len(node), -1)
        linked, forest = compare(x, code, np.asarray(rows["factor"]), keys, weight, side, rows["band"][0].as_py(), threshold, confidence)
        some = np.flatnonzero(linked)
        order = np.lexsort((np.arange(len(node)), forest.of))
        same = forest.of[order][1:] == forest.of[order][:-1]
        a, b = node[order[:-1][same]], node[order[1:][same]]
        return [(node[some], linked[some], None), (a, None, b)]

    def batch_of(found) -> pa.RecordBatch:
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        column = lambda k: pa.chunked_array([pa.array(f[k], pa.int64()) if f[k] is not None else pa.nulls(len(f[0]), pa.int64()) for f in found], pa.int64()).combine_chunks()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), column(1), column(2)], names=["a", "linked", "b"])

    def run(batches):
        rest, found, size = None, [], 0
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part]).combine_chunks()
            task = np.asarray(rest["task"])
            bounds = np.concatenate(([0], np.flatnonzero(task[1:] != task[:-1]) + 1))
            for k in range(len(bounds) - 1):
                found += one(rest.slice(bounds[k], bounds[k + 1] - bounds[k]))
            rest = rest.slice(bounds[-1]).combine_chunks()
            if sum(len(f[0]) for f in found) > 100_000:
                yield batch_of(found)
                found = []
        if rest is not None and rest.num_rows:
            found += one(rest)
        yield batch_of(found)

    return run


def links(vectors: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, bands: int = BANDS, chunk: int = CHUNK, confidence: float = CONFIDENCE) -> DataFrame:
    """From distinct vectors (node, n, v): rows (a, linked, null) that add up to the linked rows of a node, and chains (a, null, b)."""
    coded = kept(vectors.mapInArrow(_keys(bits, bands), "node long, n long, x binary, code binary, factor double, keys array<int>"), "codes")
    length = F.octet_length("x")
    rows = coded.select("*", F.posexplode("keys").alias("band", "key"))
    rows = rows.withColumn("bucket", F.xxhash64(length, "band", "key")).drop("key")
    tasks = bucket_tasks(rows, "node", chunk)
    # tasks of one hash are told apart by band; vectors of other lengths or keys do not meet
    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_tasks(threshold, confidence), "a long, linked long, b long")


def near(table: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """One row per row of (vec_id, embedding): vec_id, n_links, component_id."""
    rows = table.select("vec_id", F.col("embedding").alias("v"))
    finite = ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists("v", lambda e: e != 0)
    valid = rows.where(F.coalesce(finite, F.lit(False)))
    other = rows.where(~F.coalesce(finite, F.lit(False)))
    distinct = valid.groupBy("v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = kept(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    found = kept(links(distinct.select("node", "n", "v"), threshold, **how), "vector-links")
    label = components(found.where("b is not null").select("a", "b"))
    counts = found.where("linked is not null").groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked"))
    known = distinct.join(label, "node", "left").join(counts, "node", "left")
    known = kept(known.select("v", "first", F.coalesce("label", "node").alias("label"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-groups")
    least = kept(known.groupBy("label").agg(F.min("first").alias("component_id")), "least-vectors")
    known = kept(known.join(least, "label").select("v", "n_links", "component_id"), "vector-components")
    out = valid.join(known, "v").select("vec_id", "n_links", "component_id")
    return out.unionByName(other.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
