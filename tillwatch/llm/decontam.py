"""Benchmark passages in documents, also with other numbers, names or units.

Words of either side are taken plainly and as templates: a number, a unit behind a number and a
name (a capitalised word) become typed placeholders; digits are parted from letters glued to them.
A capitalised word that begins a sentence may be a name or not: windows with one have both forms, and
along an alignment it is a name where the words differ. Windows of ``size`` words are
hashed; a document's window meets an item's where the plain forms are equal, or the template forms
within a stretch of equal words and placeholders that holds ``literal`` words which are no placeholders.
To find such stretches, a template window with fewer of these words is hashed up to the word that makes
them enough; then item and document are compared word by word along the alignment. An item is found in a
document if ``threshold`` of its windows are met. Slots must be consistent: along one alignment, a value
of the item has one value in the document, else the alignment's template windows don't count. Items
with fewer than ``literal`` such words in all are found plainly only.

Items are taken in blocks of at most ``block`` characters; all documents are read once for
each block, so what goes to the tasks has a bound, and a larger benchmark takes more passes.

Texts of fewer words than ``size`` are one window, their whole sequence: such an item is found only
in a document that is that sequence. Null and empty texts, and texts without words, meet nothing.
Rows are judged each, whatever their ids; repeated items are each found.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .common import small_batches
from .wordhash import BASE, INVERSE, Words, find, groups, mix, powers, words

SIZE, THRESHOLD, LITERAL = 5, 0.8, 3
#: Words that are a unit behind a number.
UNITS = (
    "mm cm m km g kg mg t l ml s ms min h hz kb mb gb tb "
    "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "gram grams kilogram kilograms pound pounds ounce ounces ton tons liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees"
).split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x6E756D626572, 0x756E6974, 0x6E616D65))
UNIT_HASHES = np.sort(words(pa.array(UNITS)).hash)

_stop = np.zeros(256, dtype=bool)
_stop[list(b".!?:\n\"")] = True
_numeric = np.zeros(256, dtype=bool)
_numeric[list(b"0123456789.,")] = True
_weights = np.array([pow(int(BASE), k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)


def template(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(the placeholder of each word, or 0; which of the others may be names, as they begin a sentence)."""
    if not len(w.hash):
        return w.hash, np.zeros(0, dtype=bool)
    numeric = np.concatenate(([0], np.cumsum(_numeric[w.raw])))
    number = numeric[w.end] - numeric[w.start] == w.end - w.start
    first = np.zeros(len(w.hash), dtype=bool)
    first[w.bounds[:-1][w.bounds[:-1] < len(w.hash)]] = True
    after = np.zeros(len(w.hash), dtype=bool)
    after[1:] = number[:-1]
    unit = after & ~first & ~number & (find(UNIT_HASHES, w.hash) >= 0)
    stops = np.concatenate(([0], np.cumsum(_stop[w.raw])))
    begins = first.copy()
    begins[1:] |= stops[w.start[1:]] > stops[w.end[:-1]]
    head, second = w.raw[w.start], w.raw[np.minimum(w.start + 1, len(w.raw) - 1)]
    name = ~number & ~unit & (head >= 65) & (head <= 90) & (w.end - w.start > 1) & (second >= 97) & (second <= 122)
    return np.where(number, NUMBER, np.where(unit, UNIT, np.where(name & ~begins, NAME, np.uint64(0)))), name & begins


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of each window; a shorter text has one."""
    n = np.diff(bounds)
    start = np.arange(len(hashes))
    whole = start[start + size <= np.repeat(bounds[1:], n)]
    with np.errstate(over="ignore"):
        total = np.zeros(len(whole), dtype=np.uint64)
        for k in range(size):
            total += hashes[whole + k] * _weights[k]
        short = bounds[:-1][(n > 0) & (n < size)]
        lengths = n[(n > 0) & (n < size)]
        brief = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            brief += np.where(k < lengths, hashes[np.minimum(short + k, max(len(hashes) - 1, 0))] * _weights[k], np.uint64(0)) if len(short) else brief
        brief += lengths.astype(np.uint64) * _weights[-1]
    return mix(np.concatenate([total, brief])), np.concatenate([whole, short])


def both_forms(w: Words, kind: np.ndarray, maybe: np.ndarray, size: int, literal: int) -> tuple[np.ndarray, np.ndarray]:
    """Template windows, and further those that differ if words that may be names are."""
    one, two = forms(w, kind, kind > 0, size, literal), forms(w, np.where(maybe, NAME, kind), maybe, size, literal)
    return np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])


def forms(w: Words, kind: np.ndarray, wanted: np.ndarray, size: int, literal: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of each template window with a wanted word: ``size`` words, or as many more as hold ``literal`` others than placeholders; a shorter text has one at most."""
    slot = kind > 0
    start = np.arange(len(slot))
    last = np.repeat(w.bounds[1:], np.diff(w.bounds))
    other = np.flatnonzero(~slot)
    nth = np.cumsum(~slot) - ~slot + max(literal, 1) - 1
    end = np.full(len(slot), len(slot) + 1)
    end[nth < len(other)] = other[nth[nth < len(other)]] + 1
    short = np.repeat(np.diff(w.bounds) < size, np.diff(w.bounds))
    end = np.where(short, np.where(end <= last, last, end), np.maximum(end, start + size))
    keep = (end <= last) & (~short | (start == np.repeat(w.bounds[:-1], np.diff(w.bounds))))
    start, end, short = start[keep], end[keep], short[keep]
    held = np.concatenate(([0], np.cumsum(wanted)))
    some = held[end] > held[start]
    start, end, short = start[some], end[some], short[some]
    total = np.zeros(len(slot) + 1, np.uint64)
    np.cumsum(np.where(slot, kind, w.hash) * powers(len(slot)), out=total[1:])
    return mix((total[end] - total[start]) * powers(len(slot) + 1, INVERSE)[start] + (2 * (end - start) + short).astype(np.uint64)), start


@dataclass
class Index:
    """Windows of a block of items: sorted hashes, and for each the item's row and first word; ``typed`` where the template form was taken."""

    ids: pa.Array
    hash: np.ndarray
    row: np.ndarray
    at: np.ndarray
    typed: np.ndarray
    count: np.ndarray
    word: np.ndarray
    kind: np.ndarray
    maybe: np.ndarray
    bounds: np.ndarray
    size: int
    literal: int
    threshold: float

    @classmethod
    def of(cls, ids: pa.Array, texts: pa.Array, size: int, literal: int, threshold: float) -> Index:
        w = words(texts, split=True)
        kind, maybe = template(w)
        plain, at = windows(w.hash, w.bounds, size)
        form, start = both_forms(w, kind, maybe, size, literal)
        hashes, starts = np.concatenate([plain, form]), np.concatenate([at, start])
        kinds = np.concatenate([np.zeros(len(plain), bool), np.ones(len(form), bool)])
        order = np.argsort(hashes, kind="stable")
        row = w.doc[starts[order]] if len(order) else np.zeros(0, np.int64)
        return cls(ids, hashes[order], row, starts[order], kinds[order], np.bincount(w.doc[at], minlength=len(ids)) if len(at) else np.zeros(len(ids), int), w.hash, kind, maybe, w.bounds, size, literal, threshold)

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, float, bool]]:
        """(row of the texts, row of the items, share of the item's windows, only as a template) of each item found."""
        keys = np.unique(self.hash)
        left, right = np.searchsorted(self.hash, keys), np.searchsorted(self.hash, keys, side="right")
        for base, part in groups(texts):
            w = words(part, split=True)
            kind, maybe = template(w)
            named = (kind == NAME) | maybe
            met, lines = defaultdict(set), defaultdict(set)
            for (hashes, at), is_form in ((windows(w.hash, w.bounds, self.size), False), (both_forms(w, kind, maybe, self.size, self.literal), True)):
                key = find(keys, hashes)
                hit = np.flatnonzero(key >= 0)
                n = (right - left)[key[hit]]
                entry = np.repeat(left[key[hit]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                own = at[np.repeat(hit, n)]
                fits = self.typed[entry] == is_form
                entry, own = entry[fits], own[fits]
                for d, item, x, q in zip(w.doc[own].tolist(), self.row[entry].tolist(), self.at[entry].tolist(), own.tolist()):
                    lines[d, item].add(q - x)
                    if not is_form:
                        met[d, item].add(x)
            for (d, item), shifts in lines.items():
                count, own = int(self.count[item]), met[d, item]
                found = set(own)
                if len(own) < count:
                    for shift in shifts:
                        found |= self._along(item, d, shift, w, kind, named)
                if len(found) / count >= self.threshold - 1e-9:
                    yield base + d, item, len(found) / count, len(own) / count < self.threshold - 1e-9

    def _along(self, item: int, d: int, shift: int, w: Words, kind: np.ndarray, named: np.ndarray) -> set[int]:
        """The item's windows that are met ``shift`` words further on in the texts, as templates; none if slots are inconsistent."""
        first, last = int(self.bounds[item]), int(self.bounds[item + 1])
        a, b = max(first, int(w.bounds[d]) - shift), min(last, int(w.bounds[d + 1]) - shift)
        own, other, slot, maybe = self.word[a:b], w.hash[a + shift : b + shift], self.kind[a:b] > 0, self.maybe[a:b]
        name = maybe | (self.kind[a:b] == NAME)
        same = (own == other) | (slot & (self.kind[a:b] == kind[a + shift : b + shift])) | (name & named[a + shift : b + shift])
        edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
        fixed = np.concatenate(([0], np.cumsum((own == other) & ~slot)))
        slot = slot | maybe
        size = min(self.size, last - first)
        value: dict[int, int] = {}
        back: dict[int, int] = {}
        out: set[int] = set()
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - s >= size and fixed[e] - fixed[s] >= self.literal:
                held = slot[s:e]
                for x, u in zip(own[s:e][held].tolist(), other[s:e][held].tolist()):
                    if value.setdefault(x, u) != u or back.setdefault(u, x) != x:
                        return set()
                out.update(range(a + s, a + e - size + 1))
        return out


def indexes(benchmark: DataFrame, size: int, literal: int, threshold: float, block: int) -> Iterator[Index]:
    """Indexes of blocks of at most ``block`` characters (or one longer item)."""
    ids, texts, length = [], [], 0
    kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    for r in benchmark.select("item_id", "text").toLocalIterator():
        text = r["text"] or ""
        if texts and length + len(text) > block:
            yield Index.of(pa.array(ids, kind), pa.array(texts, pa.string()), size, literal, threshold)
            ids, texts, length = [], [], 0
        ids.append(r["item_id"]), texts.append(text)
        length += len(text)
    if texts:
        yield Index.of(pa.array(ids, kind), pa.array(texts, pa.string()), size, literal, threshold)


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, literal: int = LITERAL, block: int = 4_000_000) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, containment, as_template."""
    docs = small_batches(docs.select("doc_id", "text"))
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    names = ["doc_id", "item_id", "containment", "as_template"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, containment double, as_template boolean"

    def search(index: Index):
        def run(batches):
            for batch in batches:
                found = list(index.matches(batch.column("text")))
                row, item, share, only = zip(*found) if found else ([], [], [], [])
                ids = batch.column("doc_id").take(pa.array(row, pa.int64())), index.ids.take(pa.array(item, pa.int64()))
                yield pa.RecordBatch.from_arrays([*ids, pa.array(share, pa.float64()), pa.array(only, pa.bool_())], names=names)

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, size, literal, threshold, block):
        out = out.unionByName(docs.mapInArrow(search(index), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, literal: int = LITERAL, block: int = 4_000_000) -> DataFrame:
    """The documents, all columns, in which no item is found."""
    at = small_batches(docs).columns.index("text")

    def without(index: Index):
        def run(batches):
            for batch in batches:
                good = np.ones(batch.num_rows, dtype=bool)
                good[[row for row, *_ in index.matches(batch.column(at))]] = False
                yield batch.filter(pa.array(good))

        return run

    for index in indexes(benchmark, size, literal, threshold, block):
        docs = docs.mapInArrow(without(index), docs.schema)
    return docs
