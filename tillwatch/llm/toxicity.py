"""Toxicity by two class-conditional Kneser-Ney models of words.

A word is a chain of expressions, each with the one before as its context: its first 4, 6
and 8 bytes, then the whole word. Either class (toxic, ordinary) has discounted counts of the
training documents that hold an expression; what the discount takes goes to one backoff
distribution that both share: the number of different words of the whole corpus that continue
an expression (Kneser-Ney's continuation count). So a rare expression gets the same
probability from both classes, and a new word of a toxic stem is judged by its stem.

A document's evidence is the highest length-normalised difference of the two log-likelihoods
over windows of ``window`` words; a logistic curve, fitted on labelled documents that the counts
have not seen, turns it and the number of words into a score.

The two models are fitted on a bounded sample of the labelled rows (``Bounds``); continuation
counts cover every text, and every text is scored whole. The counts that are broadcast are
bounded by the sample: at most ``rows * longest / 2`` words.

Null and empty texts, and texts without words, hold no evidence (0). Repeated rows are scored
each; labels of one document that differ count as toxic; null labels and ids teach nothing.
Without labels of both classes every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, small_batches
from .wordhash import find, groups, words

#: Bytes that make up the expressions of a word before the whole of it.
STEMS = (4, 6, 8)
#: What is taken from a count of 1, 2, and 3 or more. An expression seen in one document only is left to the backoff.
DISCOUNT = np.array([0.0, 1.0, 1.6, 2.0])


@dataclass(frozen=True)
class Bounds:
    """Of the labelled rows that are learned from: rows of either class, rows for the curve, longest text in characters."""

    toxic: int = 3000
    ordinary: int = 6000
    curve: int = 6000
    longest: int = 20_000


@dataclass
class Model:
    """For each level the sorted expressions, the log ratio of each, and that of the continuations that have no entry."""

    keys: list[np.ndarray] = field(default_factory=list)
    ratio: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    window: int = 4

    def evidence(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Highest windowed mean of the log ratio, and the number of words, for each text."""
        best, count = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        for at, part in groups(texts):
            w = words(part, STEMS)
            total, below = np.zeros(len(w.hash)), np.full(len(w.hash), self.start)
            for level, hashes in enumerate([*w.prefix, w.hash]):
                i = find(self.keys[level], hashes)
                known = i >= 0
                total += np.where(known, self.ratio[level][i] if len(self.keys[level]) else 0, below)
                below = np.where(known, self.rest[level][i] if len(self.keys[level]) else 0, 0.0)
            n = np.diff(w.bounds)
            sums = np.concatenate(([0.0], np.cumsum(total)))
            # windows are cut at the end of their document; a shorter document has one window, filled up with even odds
            last = np.minimum(np.arange(len(total)) + self.window, np.repeat(w.bounds[1:], n))
            means = (sums[last] - sums[:-1]) / self.window
            full = np.flatnonzero(n)
            whole = (np.arange(len(total)) + self.window <= np.repeat(w.bounds[1:], n)) | (np.arange(len(total)) == np.repeat(w.bounds[:-1], n))
            means[~whole] = -np.inf
            if len(full):
                best[at + full] = np.maximum.reduceat(means, w.bounds[:-1][full])
            count[at : at + len(part)] = n
        return best, count

    def score(self, best: np.ndarray, count: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * best + c * np.log1p(count), -60, 60)))


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, bounds: Bounds) -> DataFrame:
    """A bounded sample of the labelled documents: part 'counts' or 'curve', toxic, text. Rows are picked by a hash of their id."""
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("pick", F.xxhash64("doc_id")).withColumn("curve", F.pmod("pick", F.lit(4)) == 0)

    def some(curve: bool, toxic: int | None, n: int) -> DataFrame:
        rows = known.where((F.col("curve") == curve) & (F.lit(True) if toxic is None else F.col("toxic") == toxic))
        return rows.orderBy("pick", "doc_id").limit(n)

    chosen = some(False, 1, bounds.toxic).unionByName(some(False, 0, bounds.ordinary)).unionByName(some(True, None, bounds.curve))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= bounds.longest)
    # at most toxic + ordinary + curve rows of three numbers
    return texts.join(F.broadcast(chosen), "doc_id").select("curve", "toxic", "text").dropDuplicates(["curve", "text"])


def _chains(batches):
    """(level, context, expression, toxic documents, ordinary documents) of each batch of sample texts."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic")).astype(bool)
        for at, part in groups(batch.column("text")):
            w = words(part, STEMS)
            context = np.zeros(len(w.hash), np.uint64)
            for level, hashes in enumerate([*w.prefix, w.hash]):
                key, first, of = np.unique(hashes, return_index=True, return_inverse=True)
                pairs = np.unique(of * len(part) + w.doc)  # each expression counts once a document
                of, is_toxic = pairs // len(part), toxic[at + pairs % len(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), level, np.int32)), pa.array(context[first].view(np.int64)), pa.array(key.view(np.int64)),
                     pa.array(np.bincount(of, is_toxic, len(key)).astype(np.int64)), pa.array(np.bincount(of, ~is_toxic, len(key)).astype(np.int64))],
                    names=["level", "context", "key", "toxic", "ordinary"],
                )
                context = hashes


def _continuations(keys: list[np.ndarray]):
    """Distinct words of a task with the index of their stems among the model's."""

    def run(batches):
        for batch in batches:
            for _, part in groups(batch.column(0)):
                w = words(part, STEMS)
                word, first = np.unique(w.hash, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), *(pa.array(find(keys[i], w.prefix[i][first]).astype(np.int32)) for i in range(len(STEMS)))], names=["word", *(f"stem{i}" for i in range(len(STEMS)))])

    return run


def _distinct(batches):
    """Words that a task has met before are left out, within bounded memory."""
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        word = np.asarray(batch.column(0))
        new = np.ones(len(word), bool)
        for have in seen.values():
            new &= find(have, word) < 0
        if not new.any():
            continue
        size = sum(map(len, seen.values()))
        if size > 2_000_000:
            seen.clear()
        seen[len(seen)] = word[new]
        if len(seen) > 8:
            merged = np.unique(np.concatenate(list(seen.values())))
            seen.clear()
            seen[0] = merged
        yield batch.filter(pa.array(new))


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, bounds: Bounds = Bounds(), window: int = 4) -> Model:
    """The two models and the curve. ``learn`` says which rows of ``labels`` may be learned from."""
    small_batches(docs)
    sample = kept(labelled(docs, labels, F.lit(True) if learn is None else learn, bounds), "toxicity-sample")
    counts = sample.where(~F.col("curve")).select("toxic", "text").repartition(6).mapInArrow(_chains, "level int, context long, key long, toxic long, ordinary long")
    rows = counts.groupBy("level", "context", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).toArrow()
    level, toxic, ordinary = (np.asarray(rows[c]) for c in ("level", "toxic", "ordinary"))
    key, context = (np.asarray(rows[c]).view(np.uint64) for c in ("key", "context"))
    model = Model(window=window)
    tables = []
    for at in range(len(STEMS) + 1):
        here = level == at
        order = np.argsort(key[here])
        tables.append((key[here][order], context[here][order], np.stack([toxic[here][order], ordinary[here][order]]).astype(float)))
    cont = _shared(docs, [t[0] for t in tables])
    keys_below = np.zeros(1, np.uint64)
    types = cont.pop()
    spread_below = np.array([max(types, 1.0)])
    for at, (k, ctx, n) in enumerate(tables):
        of = find(keys_below, ctx)
        d = np.minimum(DISCOUNT[np.minimum(n, 3).astype(int)], n)
        size, mass = (np.stack([np.bincount(of, x, len(keys_below)) for x in y]) for y in (n, d))
        backoff = np.maximum(cont[at], 1) / np.maximum(spread_below[of], 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(size[:, of] > 0, (n - d + mass[:, of] * backoff) / size[:, of], backoff)
            rest = np.where(size > 0, mass / size, 1.0)
        # where a class has seen a context but never left mass for anything else, half a document is left
        rest = np.where(rest > 0, rest, 0.5 / np.maximum(size, 1))
        p = np.maximum(p, rest[:, of] * backoff)
        ratio, rest = np.log(p[0] / p[1]), np.log(rest[0] / rest[1])
        if at:
            model.rest.append(rest)
        else:
            model.start = float(rest[0])
        keys_below, spread_below = k, cont[at]
        if at == len(STEMS):  # words whose counts are all discounted are what their stem leaves to any word
            k, ratio = k[n.max(axis=0) >= 2], ratio[n.max(axis=0) >= 2]
            model.rest.append(np.zeros(len(k)))
        model.keys.append(k)
        model.ratio.append(ratio)
    model.curve = _curve(sample.where("curve"), model, sample)
    return model


def _shared(docs: DataFrame, keys: list[np.ndarray]) -> list:
    """Continuation counts of the model's stems over all texts, 1 for whole words, and the number of different words."""

    def run(batches):
        yield from _distinct(_continuations(keys)(batches))

    stems = [f"stem{i}" for i in range(len(STEMS))]
    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "word long, " + ", ".join(f"{s} int" for s in stems))
    found = found.groupBy("word").agg(*(F.first(s).alias(s) for s in stems))
    pairs = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).alias("i")), *(F.struct(F.lit(i).alias("level"), F.col(s).alias("i")) for i, s in enumerate(stems)))
    rows = found.select(F.inline(pairs)).where("i >= 0").groupBy("level", "i").count().toArrow()
    level, at, n = (np.asarray(rows[c]) for c in ("level", "i", "count"))
    out = []
    for i, k in enumerate(keys):
        here = level == i
        c = np.zeros(len(k))
        c[at[here]] = n[here]
        out.append(c if i < len(STEMS) else np.ones(len(k)))
    return [*out, float(n[level == -1].sum())]


def _curve(rows: DataFrame, model: Model, sample: DataFrame, penalty: float = 1e-3) -> tuple[float, float, float]:
    """Logistic regression of the label on evidence and length, by Newton's steps."""

    def run(batches):
        for batch in batches:
            best, count = model.evidence(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(best), pa.array(count)], names=["toxic", "best", "n"])

    got = rows.select("toxic", "text").mapInArrow(run, "toxic int, best double, n long").toArrow()
    y, best, n = np.asarray(got["toxic"]).astype(float), np.asarray(got["best"]), np.asarray(got["n"])
    if not len(y) or y.min() == y.max() or not all(len(k) for k in model.keys):
        share = sample.agg(F.avg("toxic")).first()[0] or 0.0
        return (float(np.log((share + 1e-9) / (1 - share + 1e-9))), 0.0, 0.0)
    x = np.stack([np.ones(len(y)), best, np.log1p(n)], axis=1)
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * len(y) * np.diag([1e-3, 1, 1]), x.T @ (y - p) - penalty * len(y) * np.array([1e-3, 1, 1]) * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """All columns of ``docs``, and the score of its ``text`` as ``column`` (which replaces one of that name)."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    docs = small_batches(docs.drop(column))
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            best, count = model.evidence(batch.column(at).fill_null(""))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(best, count))], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)
