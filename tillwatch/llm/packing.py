"""Best-fit packing of tokenised texts into sequences of at most ``size`` tokens.

Texts become pieces (ids of the tokenizer, then an end mark; longer ones are cut every ``size``
ids). Packing needs only how many pieces there are of each length, at most ``size`` numbers. The
plan goes through lengths from the longest down: an index of the available single, pair and
triple sums gives what fills a gap exactly, and a combination is used as often as its lengths are
available; what is left is packed best fit, longest first, many equal bins at once. Then
pieces of one length are numbered, in buckets of that length, so that a length that a third of all
pieces have is spread, and each number gets its place in the plan.

Null and empty texts are one piece of the end mark. Repeated rows and null ids are pieces like
others. An empty table gives an empty one. The result depends on the rows only, not on their order,
but for which of two equal pieces (same doc_id, piece and ids) takes which place.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, small_batches
from .wordhash import LOWER, groups, text_bytes

SIZE = 2048
END = 0
#: Pieces of one length are numbered in so many buckets.
BUCKETS = 1024
#: Words whose ids a worker keeps, and their bytes; one group of texts may add to them before they are dropped.
KEPT_WORDS, KEPT_BYTES, LONGEST = 1_000_000, 32 << 20, 40
#: Bytes of text whose words are looked up together.
GROUP = 6 << 20

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
MARK = np.zeros(256, dtype=bool)
MARK[list(b".,;:!?")] = True

_workers: dict[str, Encoder] = {}


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.LargeStringArray:
    """Byte ranges, one behind the other, none empty and with something between them, as strings."""
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[start], edge[end] = 1, -1
    offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[np.cumsum(edge[:-1], dtype=np.int8) > 0]))


class Encoder:
    """Ids of texts by a tokenizer that splits at white space.

    The parts of a group of texts between blanks and line ends are encoded as a dictionary, each different one is
    tokenised once as long as its ids are kept, and the ids of the texts are gathered by offsets. Parts of letters (to U+00FF) with or without
    marks behind them count as two, and letters as small ones, which saves most of them and goes straight to the tokenizer's merges. That is right
    for tokenizers that lower-case and split letters from marks, which is tried out once; for others every part is taken whole.
    """

    PROBES = ("The", "été", "ÀÉÎÕÜ", "ÿØß", "word,", "Word.", "what?!", "x", "Äpfel;", "internationalisation:")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: split.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self._forget()
        self.parts_apart = False
        whole = self.encode(list(self.PROBES))
        self._forget()
        self.parts_apart = True
        self.parts_apart = self.encode(list(self.PROBES)) == whole
        self._forget()

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    def _forget(self) -> None:
        #: of each kind of part, those known and their numbers
        self.known = {kind: (pa.array([], pa.large_string()), np.zeros(0, np.int64)) for kind in ("whole", "letters", "marks")}
        #: ids of all known parts behind each other; where a part's begin, and how many it has
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _one_by_one(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids behind each other, how many each part has)."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array([i for part in ids for i in part], dtype=np.uint32), np.array([len(i) for i in ids], dtype=np.int64)

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of small letters, straight by the tokenizer's merges."""
        merge, spelled = self.tokenizer.model.tokenize, self.spelled
        ids = [[t.id for t in merge(w if w.isascii() else w.translate(spelled))] for w in words]
        return np.array([i for part in ids for i in part], dtype=np.uint32), np.array([len(i) for i in ids], dtype=np.int64)

    def _numbers(self, kind: str, parts: pa.Array) -> np.ndarray:
        """The numbers of different parts; those that are new are tokenised."""
        known, numbers = self.known[kind]
        place = pc.index_in(parts, value_set=known)
        new = parts.filter(pc.is_null(place))
        if len(new):
            ids, sizes = (self._merged if kind == "letters" else self._one_by_one)(new.to_pylist())
            numbers = np.concatenate([numbers, len(self.size) + np.arange(len(new))])
            self.known[kind] = pa.concat_arrays([known, new]), numbers
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes) - sizes])
            self.size, self.flat = np.concatenate([self.size, sizes]), np.concatenate([self.flat, ids])
        at = np.array(place.fill_null(-1), dtype=np.int64)
        at[at < 0] = np.arange(len(known), len(known) + len(new))
        return numbers[at]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by END; where each begins, and the end)."""
        if len(self.size) > KEPT_WORDS or sum(known.nbytes for known, _ in self.known.values()) > KEPT_BYTES:
            self._forget()
        raw, starts = text_bytes(texts)
        inside = (raw != 32) & (raw != 10)
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        letters = np.zeros(len(start), dtype=np.int64)
        if self.parts_apart:
            # two bytes are a letter of U+00C0 to U+00FF, but for the signs of multiplication and division
            two = np.zeros(len(raw) + 1, dtype=bool)
            two[: len(raw) - 1] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0xBF) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
            letter = LETTER[raw] | two[:-1]
            letter[1:] |= two[:-2]
            before = np.concatenate(([0], np.cumsum(letter, dtype=np.int32)))
            n = (before[end] - before[start]).astype(np.int64)
            more = end - start - n
            # letters first, then at most two marks; anything else is taken whole
            apart = (n > 0) & (n <= LONGEST) & (before[start + n] - before[start] == n) & (more <= 2)
            apart &= ((more < 1) | MARK[raw[end - 1]]) & ((more < 2) | MARK[raw[end - 2]])
            letters = np.where(apart, n, 0)
            small = LOWER[raw]
            small[1:] += (two[:-2] & (raw[1:] <= 0x9E)).astype(np.uint8) * np.uint8(32)
        apart = letters > 0
        marked = apart & (start + letters < end)
        units = 1 + marked
        place = np.cumsum(units) - units
        number = np.zeros(int(units.sum()), dtype=np.int64)
        kinds = [("whole", ~apart, place, start, end, raw)]
        if apart.any():
            kinds += [("letters", apart, place, start, start + letters, small), ("marks", marked, place + 1, start + letters, end, raw)]
        for kind, some, at, a, z, data in kinds:
            if some.any():
                coded = _strings(data, a[some], z[some]).dictionary_encode()
                number[at[some]] = self._numbers(kind, coded.dictionary)[np.asarray(coded.indices)]
        size, begin = self.size[number], self.begin[number]
        before = np.cumsum(size) - size
        ids = self.flat[np.repeat(begin - before, size) + np.arange(int(size.sum()))]
        doc = np.repeat(np.searchsorted(starts, start, side="right") - 1, units)
        counts = np.bincount(doc, weights=size, minlength=len(starts)).astype(np.int64) + 1
        bounds = np.concatenate(([0], np.cumsum(counts)))
        out = np.full(int(bounds[-1]), END, dtype="<u4")
        token = np.ones(len(out), dtype=bool)
        token[bounds[1:] - 1] = False
        out[token] = ids
        return out, bounds

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, without END."""
        ids, bounds = self.ids(pa.array(texts, pa.string()))
        return [ids[a : z - 1].tobytes() for a, z in zip(bounds[:-1], bounds[1:])]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every document."""
    docs = small_batches(docs.select("doc_id", "text"))

    def run(batches):
        encoder = Encoder.at(tokenizer)
        for batch in batches:
            for first, some in groups(batch.column("text"), GROUP):
                ids, bounds = encoder.ids(some)
                n = -(-np.diff(bounds) // size)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                begin = bounds[:-1][row] + piece * size
                length = np.minimum(begin + size, bounds[1:][row]) - begin
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * z]) for a, z in zip(begin.tolist(), (begin + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row + first)), pa.array(piece.astype(np.int32)), pa.array(piece * size), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Sums:
    """Index of the available lengths by what one, two or three of them add up to.

    For every sum it holds how far its pairs and triples have been gone through, longest first. Lengths are only ever
    used up, so what was not available once never is again, and no entry is looked at twice.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        size = len(left)
        #: the longest length of a pair, and of a triple, that may still be available for a sum
        self.longest_of_two = np.arange(size) - 1
        self.longest_of_three = np.arange(size) - 2

    def available(self, lengths: tuple[int, ...]) -> int:
        """How often these lengths can be taken together."""
        return min(int(self.left[n]) // lengths.count(n) for n in lengths)

    def singles(self, total: int) -> Iterator[tuple[int, ...]]:
        if self.left[total]:
            yield (total,)

    def pairs(self, total: int) -> Iterator[tuple[int, ...]]:
        """Available pairs of this sum, from the index on."""
        a, whole = int(self.longest_of_two[total]), True
        while 2 * a >= total and a > 0:
            if self.available((a, total - a)):
                yield a, total - a
                whole = whole and not self.available((a, total - a))
            if whole:
                self.longest_of_two[total] = a - 1
            a -= 1

    def triples(self, total: int) -> Iterator[tuple[int, ...]]:
        a, whole = int(self.longest_of_three[total]), True
        while 3 * a >= total and a > 0:
            if self.left[a]:
                for b, c in self.pairs(total - a):
                    if b <= a and self.available((a, b, c)):
                        yield a, b, c
                whole = whole and not self.left[a]
            if whole:
                self.longest_of_three[total] = a - 1
            a -= 1


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """(how often, lengths) for each kind of sequence; each length is used as often as ``counts`` says."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    out: list[tuple[int, tuple[int, ...]]] = []
    sums = Sums(left)

    def use(lengths: tuple[int, ...]) -> None:
        """Take the combination as often as it is available."""
        times = sums.available(lengths)
        if times:
            for n in lengths:
                left[n] -= times
            out.append((times, lengths))

    use((size,))
    for longest in range(size - 1, 0, -1):
        for index in (sums.singles, sums.pairs, sums.triples):
            if not left[longest]:
                break
            for rest in index(size - longest):
                use((longest, *rest))
                if not left[longest]:
                    break
    return out + _best_fit(left, size)


def _best_fit(left: np.ndarray, size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Longest first into the open sequence with the least room; equal sequences are filled together."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            fits = min((r for r, bins in room.items() if r >= length and bins), default=None)
            if fits is None:
                per = size // length
                if n >= per:
                    room.setdefault(size - per * length, []).append((n // per, (length,) * per))
                    n %= per
                else:
                    room.setdefault(size - n * length, []).append((1, (length,) * n))
                    n = 0
                continue
            times, lengths = room[fits].pop()
            now = min(times, n)
            if times > now:
                room[fits].append((times - now, lengths))
            room.setdefault(fits - length, []).append((now, (*lengths, length)))
            n -= now
    return [one for bins in room.values() for one in bins]


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """All columns of ``cut`` (doc_id, piece, length, ids_crc32 and more; a plain table, read twice), sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    length, first, sequence, offset = [], [], [], []
    done = np.zeros(size + 1, dtype=np.int64)
    base = 0
    for times, lengths in plan(counts, size):
        at = 0
        for one in lengths:
            length.append(one), first.append(done[one]), sequence.append(base), offset.append(at)
            done[one] += times
            at += one
        base += times
    order = np.lexsort((first, length))
    length, first, sequence, offset = (np.array(x, dtype=np.int64)[order] for x in (length, first, sequence, offset))
    begins = np.searchsorted(length, np.arange(size + 2))

    bucketed = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    before = bucketed.groupBy("length", "_bucket").count()
    # at most ``size * BUCKETS`` rows, BUCKETS of a length
    before = before.withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).drop("count")
    ranked = bucketed.withColumn("_rank", F.row_number().over(own)).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") - 1 + F.col("_before")).select(*cut.columns, "_rank")

    def place(batches):
        for batch in batches:
            n, rank = np.asarray(batch.column("length")), np.asarray(batch.column("_rank"))
            slot = np.empty(len(n), dtype=np.int64)
            for one in np.unique(n):
                here = n == one
                a, z = begins[one], begins[one + 1]
                slot[here] = a + np.searchsorted(first[a:z], rank[here], side="right") - 1
            columns = [batch.column(c) for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence[slot] + rank - first[slot]), pa.array(offset[slot])], names=[*(c for c in batch.schema.names if c != "_rank"), "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    return pack(kept(pieces(docs, tokenizer, size), "pieces"), size)
