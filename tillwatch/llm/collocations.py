"""Phrases whose words stand together more often than chance, by counting quotient filters.

A text's words (small letters for A-Z) are what lies between blanks and tabs; phrases never go over a
sentence sign or line end, which cut the text into pieces. Everything is counted per language (null: ``und``).
Candidates are phrases of 2 to ``longest`` words that occur ``least`` times or more.
As all parts of a candidate occur as often, lengths are counted one after the other, and of each
length only phrases whose first and last words (all but one) are frequent themselves.

Texts become shards of a bounded size, with words numbered by a dictionary of their own. Dictionaries are cut into blocks by
the words' hashes, the blocks of all shards are merged, and a shard is told which of its words are frequent, and their ids. Then for each length:
a shard packs every possible phrase into a number (id of its first words, id of the last word), counts
them in a counting quotient filter, lossless, and cuts it into blocks by the upper bits of the permuted
numbers. The filters of a block from all shards are merged in one task; blocks are equally large, as
the permutation spreads keys evenly, and a phrase that is everywhere is one entry of each shard. A shard is told which of its
phrases are frequent, and keeps of its text only what longer phrases may need, in its own small numbers. Nothing is broadcast or
brought to the driver but for single figures that say how many bits and blocks there are.

The score of a cut is floor(1000 a n / (l r)) in exact arithmetic: a, l and r are the counts of the phrase, of the words before
the cut and of those behind it, n all words of the language. The lowest counts; of equal ones the first. A candidate
goes if one that holds it occurs ``cover`` percent as often; it is enough to look at those one word longer, which are
as frequent as the longer ones around them.

Null and empty texts have no words. Repeated rows are counted as often as they stand there. Ties in rank are
broken by count, then by the phrase's bytes, so ranks are unique. An empty table gives an empty one. Further columns don't matter.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, shared_folder, small_batches
from .quotient import counted, merged, packed, permuted, restored, unpacked
from .wordhash import INVERSE, LOWER, groups, mix, powers, text_bytes

LEAST, LONGEST, COVER, TOP = 100, 5, 100, 2000


@dataclass(frozen=True)
class Sizes:
    """What a task has in memory at a time; results don't depend on it."""

    #: bytes of text in a shard; a longer text is one of its own
    shard: int = 12 << 20
    #: positions in a row of a shard, entries in a row of a filter
    part: int = 8192
    row: int = 4096
    #: occurrences of phrases in a block
    block: int = 2 << 20


SIZES = Sizes()
BREAK = np.zeros(256, dtype=bool)
BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
OUTSIDE = BREAK.copy()
OUTSIDE[list(b" \t")] = True
#: Rows of a table that a step writes: what shards keep (of a block: what is frequent in it), what is said to others, and totals.
STATE, SAID, TOTAL = 0, 1, 2
#: Rows of a shard before its parts: what its numbers stand for, and what blocks say of its phrases.
TABLE, TOLD = -2, -1


def in_kinds(df: DataFrame, name: str) -> DataFrame:
    """Like ``kept``, with a folder for each kind."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_numbers(values: np.ndarray) -> bytes:
    """Seven bits a byte, lowest first; all but a number's last byte have the upper bit."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), dtype=np.int64)
    for k in range(1, 10):
        more = v >= np.uint64(1 << 7 * k)
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(v) else 0, dtype=np.uint8)
    for k in range(int(size.max()) if len(v) else 0):
        here = size > k
        out[(ends - size)[here] + k] = ((v[here] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | np.where(size[here] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def long_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    begins = np.concatenate(([0], np.flatnonzero(raw < 128)[:-1] + 1))
    sizes = np.diff(np.concatenate((begins, [len(raw)])))
    bits = (raw & 127).astype(np.uint64) << (7 * (np.arange(len(raw)) - np.repeat(begins, sizes))).astype(np.uint64)
    return np.add.reduceat(bits, begins)


_zstd = pa.Codec("zstd", 3)


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + _zstd.compress(data, asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return _zstd.decompress(data[4:], decompressed_size=int.from_bytes(data[:4], "little"), asbytes=True)


def squeezed_numbers(values: np.ndarray) -> bytes:
    return squeezed(short_numbers(values))


def read_numbers(data: bytes) -> np.ndarray:
    return long_numbers(unsqueezed(data))


def rising(values: np.ndarray) -> bytes:
    """Numbers in order, as steps."""
    return squeezed_numbers(np.diff(values, prepend=values.dtype.type(0)))


def read_rising(data: bytes) -> np.ndarray:
    return np.cumsum(read_numbers(data), dtype=np.uint64)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, index of each one's text, whether a piece begins with it)."""
    raw, starts = text_bytes(texts)
    raw[np.concatenate((starts[1:], [len(raw)])).astype(np.int64) - 1] = 10  # texts are pieces of their own
    inside = ~OUTSIDE[raw]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[inside]]))
    piece = np.searchsorted(np.flatnonzero(BREAK[raw]), start)
    return words, np.searchsorted(starts, start, side="right") - 1, np.concatenate(([True], piece[1:] != piece[:-1]))[: len(start)]


def _cuts(sequence: np.ndarray, size: int) -> list[np.ndarray]:
    """Parts of about ``size`` positions; they end at a 0, which none of them needs."""
    zeros = np.flatnonzero(sequence == 0)
    at = np.searchsorted(zeros, np.arange(size, len(sequence), size))
    ends = np.unique(zeros[at[at < len(zeros)]])
    return [p for p in np.split(sequence, ends) if p.any()]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word, equal on every machine."""
    ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
        return mix((sums[ends[1:]] - sums[ends[:-1]]) * powers(len(data) + 1, INVERSE)[ends[:-1]])


ROWS = pa.schema([("kind", pa.int8()), ("shard", pa.int64()), ("part", pa.int64()), ("seq", pa.binary()), ("phrases", pa.binary()), ("lang", pa.string()), ("words", pa.binary())])
ROWS_DDL = "kind byte, shard long, part long, seq binary, phrases binary, lang string, words binary"


def rows_of(**columns) -> pa.RecordBatch:
    """A batch with these columns; a single value stands for all rows, others are null."""
    n = max(len(c) for c in columns.values() if isinstance(c, list))
    whole = [pa.array(v if isinstance(v, list) else [v] * n, f.type) if (v := columns.get(f.name)) is not None else pa.nulls(n, f.type) for f in ROWS]
    return pa.RecordBatch.from_arrays(whole, schema=ROWS)


def _encode(sizes: Sizes, block_bits: int):
    """Rows of the shards: blocks of their words (SAID: numbers, counts, words) and their texts as numbers of words, most frequent first, with 0 between pieces (STATE)."""

    def shard(rows: pa.Table, number: int):
        words, doc, begins = tokens(rows["text"].combine_chunks())
        if not len(words):
            return
        coded, langs = words.dictionary_encode(), rows["lang"].combine_chunks().dictionary_encode()
        types = len(coded.dictionary)
        both = np.asarray(coded.indices).astype(np.int64) + np.asarray(langs.indices)[doc].astype(np.int64) * types
        del words, doc
        code, kinds = pd.factorize(both)
        del both
        n = np.bincount(code)
        order = np.argsort(-n, kind="stable")
        local = np.empty(len(n), dtype=np.int32)
        local[order] = np.arange(1, len(n) + 1)
        at = np.cumsum(begins, dtype=np.int32)
        at += np.arange(-1, len(at) - 1, dtype=np.int32)
        sequence = np.zeros(int(at[-1]) + 1, dtype=np.int32)
        sequence[at] = local[code]
        del at, code
        parts = _cuts(sequence, sizes.part)
        for a in range(0, len(parts), 200):
            some = parts[a : a + 200]
            yield rows_of(kind=STATE, shard=number, part=list(range(a, a + len(some))), seq=[squeezed_numbers(p) for p in some])
        word, lang, kinds = kinds % types, kinds // types, None
        hashes = word_hashes(coded.dictionary)[word] ^ word_hashes(langs.dictionary.cast(pa.large_string()))[lang]
        block = hashes >> np.uint64(64 - block_bits) if block_bits else np.zeros(len(word), np.uint64)
        order = np.lexsort((local, lang, block))
        block, lang, word, local, n = block[order].astype(np.int64), lang[order], word[order], local[order], n[order]
        edges = np.flatnonzero((block[1:] != block[:-1]) | (lang[1:] != lang[:-1])) + 1
        names, told = langs.dictionary.to_pylist(), []
        for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(word)]):
            for i in range(a, z, sizes.row):
                e = min(i + sizes.row, z)
                # a line end is no part of a word
                joined = "\n".join(coded.dictionary.take(pa.array(word[i:e])).to_pylist())
                told.append((int(block[a]), rising(local[i:e]), squeezed_numbers(n[i:e]), names[lang[a]], squeezed(joined.encode())))
        for a in range(0, len(told), 200):
            part, seq, counts, lang_of, joined = (list(c) for c in zip(*told[a : a + 200]))
            yield rows_of(kind=SAID, shard=number, part=part, seq=seq, phrases=counts, lang=lang_of, words=joined)

    def run(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for at, some in groups(batch.column("text"), sizes.shard):
                length = pa.compute.sum(pa.compute.binary_length(some)).as_py() or 0
                if held and size + length > sizes.shard:
                    yield from shard(pa.concat_tables(held), number)
                    number, held, size = number + 1, [], 0
                held.append(table.slice(at, len(some)))
                size += length
        if held:
            yield from shard(pa.concat_tables(held), number)

    return run


def by_key(batches, name: str):
    """(key, rows) of sorted rows; a group of rows is in memory at a time."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[name] != key:
                if rows:
                    yield key, rows
                key, rows = row[name], []
            rows.append(row)
    if rows:
        yield key, rows


FOUND = pa.schema([("kind", pa.int8()), ("block", pa.int64()), ("shard", pa.int64()), ("key", pa.int64()), ("nr", pa.int64()), ("n", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("seq", pa.binary()), ("phrases", pa.binary())])
FOUND_DDL = "kind byte, block long, shard long, key long, nr long, n long, lang string, word string, seq binary, phrases binary"


def found_rows(size: int, **columns) -> pa.RecordBatch:
    whole = [pa.nulls(size, f.type) if (v := columns.get(f.name)) is None else v.cast(f.type) if isinstance(v, pa.Array) else pa.array(np.full(size, v) if np.isscalar(v) and not isinstance(v, str) else [v] * size if isinstance(v, str) else v, f.type) for f in FOUND]
    return pa.RecordBatch.from_arrays(whole, schema=FOUND)


def _merge_words(least: int):
    """Rows come sorted by block: the frequent words (STATE), which of them each shard has (SAID: its numbers, numbers in the block), and all occurrences of each language (TOTAL)."""

    def run(batches):
        for block, rows in by_key(batches, "part"):
            next_nr = 0
            for lang in sorted({r["lang"] for r in rows}):
                own = [r for r in rows if r["lang"] == lang]
                lists = [pa.array(unsqueezed(r["words"]).decode().split("\n")) for r in own]
                coded = pa.chunked_array(lists).combine_chunks().dictionary_encode()
                index, counts = np.asarray(coded.indices), np.concatenate([read_numbers(r["phrases"]) for r in own]).astype(np.int64)
                total = np.zeros(len(coded.dictionary), dtype=np.int64)
                np.add.at(total, index, counts)
                yield found_rows(1, kind=TOTAL, block=block, n=int(total.sum()), lang=lang)
                often = np.flatnonzero(total >= least)
                if not len(often):
                    continue
                nr = np.full(len(total), -1, dtype=np.int64)
                nr[often] = np.arange(next_nr, next_nr + len(often))
                next_nr += len(often)
                yield found_rows(len(often), kind=STATE, block=block, nr=nr[often], n=total[often], lang=lang, word=coded.dictionary.take(pa.array(often)))
                begins = np.cumsum([0, *map(len, lists)])
                for r, a, z in zip(own, begins[:-1], begins[1:]):
                    mine = nr[index[a:z]]
                    here = mine >= 0
                    if here.any():
                        yield found_rows(1, kind=SAID, block=block, shard=r["shard"], seq=[rising(read_rising(r["seq"])[here])], phrases=[squeezed_numbers(mine[here])])

    return run


def look_up(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place + 1 of each wanted key in the sorted keys, 0 where it is not there."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at + 1, 0)


def grown(now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places at which a frequent phrase begins and another one at the next; what stands there, with a 0 where it doesn't go on).

    ``now`` says which frequent phrase begins at each place, 0 for none.
    """
    on = np.flatnonzero((now[:-1] > 0) & (now[1:] > 0))
    if not len(on):
        return on, on
    stay = np.zeros(len(now), dtype=bool)
    stay[on] = stay[on + 1] = True
    stay = np.flatnonzero(stay)
    at = np.arange(len(stay)) + np.concatenate(([0], np.cumsum(np.diff(stay) > 1)))
    left = np.zeros(at[-1] + 1, dtype=np.int64)
    left[at] = now[stay]
    return on, left


def filter_rows(keys: np.ndarray, bits: int, block_bits: int, size: int) -> list[tuple[int, bytes]]:
    """(block, filter) of the keys, with their counts."""
    values, counts = counted(permuted(keys, bits))
    block = (values >> np.uint64(bits - block_bits)).astype(np.int64) if block_bits else np.zeros(len(values), np.int64)
    out = []
    for b in np.unique(block).tolist():
        a, z = np.searchsorted(block, (b, b + 1))
        out += [(b, packed(values[i : min(i + size, z)], counts[i : min(i + size, z)], bits)) for i in range(a, z, size)]
    return out


def _grow(length: int, low_bits: int, word_bits: int, bits: int, block_bits: int, last: bool, size: int):
    """Rows come sorted by shard and part: what its numbers stand for, what was said to it, its parts.

    A part says which phrase of length - 1 words begins at each place (of one word, which word stands there), in the shard's numbers, and
    the table which id and last word these have. With the ids of the frequent phrases of ``length`` words, which begin where two of them
    begin side by side, phrases one word longer are counted (SAID), and what these need is kept (STATE).
    """
    none = np.zeros(1, dtype=np.uint64)

    def spread(numbers: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(int(numbers.max()) + 1 if len(numbers) else 1, dtype=np.uint64)
        out[numbers.astype(np.int64)] = values
        return out

    def run(batches):
        shard = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if shard is not None:
                        yield from close(shard, found)
                    shard, ids, ends, told, keys, found = row["shard"], none, none, [], None, []
                if row["part"] == TABLE:
                    numbers = read_rising(row["seq"])
                    ids = spread(numbers, read_numbers(row["phrases"]))
                    ends = ids if length == 2 else spread(numbers, read_numbers(row["words"]))
                elif row["part"] == TOLD:
                    told.append((read_rising(row["seq"]) if length == 1 else np.frombuffer(row["seq"], dtype="<u8"), (np.uint64(row["key"]) << np.uint64(low_bits)) | read_numbers(row["phrases"])))
                elif told:
                    if keys is None:
                        keys, new_ids = (np.concatenate(c) for c in zip(*told))
                        order = np.argsort(keys)
                        keys, new_ids = keys[order], new_ids[order]
                        # numbers of words stay, those of longer phrases are their places among the keys, from 1
                        numbers = keys if length == 1 else np.arange(1, len(keys) + 1, dtype=np.uint64)
                        new_ends = new_ids if length == 1 else keys & np.uint64((1 << word_bits) - 1)
                        if not last:
                            yield rows_of(kind=STATE, shard=shard, part=[TABLE], seq=[rising(numbers)], phrases=[squeezed_numbers(new_ids)], words=None if length == 1 else [squeezed_numbers(new_ends)])
                        id_of, end_of = spread(numbers, new_ids), spread(numbers, new_ends)
                        frequent = spread(numbers, np.ones(len(numbers))) > 0
                    own = read_numbers(row["seq"]).astype(np.int64)
                    if length == 1:
                        now = np.where(frequent[np.where(own < len(frequent), own, 0)], own, 0)
                    else:
                        both = np.flatnonzero((own[:-1] > 0) & (own[1:] > 0))
                        now = np.zeros(len(own), dtype=np.int64)
                        now[both] = look_up(keys, (ids[own[both]] << np.uint64(word_bits)) | ends[own[both + 1]])
                    on, left = grown(now)
                    if len(on):
                        found.append((id_of[now[on]] << np.uint64(word_bits)) | end_of[now[on + 1]])
                        if not last:
                            yield rows_of(kind=STATE, shard=shard, part=[row["part"]], seq=[squeezed_numbers(left)])
        if shard is not None:
            yield from close(shard, found)

    def close(shard: int, found: list):
        if found:
            every = filter_rows(np.concatenate(found), bits, block_bits, size)
            for a in range(0, len(every), 200):
                some = every[a : a + 200]
                yield rows_of(kind=SAID, shard=shard, part=[b for b, _ in some], seq=[f for _, f in some])

    return run


def _merge(least: int):
    """Rows come sorted by block: the frequent phrases (STATE: key, number in the block, count), and which of them each shard has (SAID: keys, numbers in the block)."""

    def run(batches):
        for block, rows in by_key(batches, "part"):
            lists = [(r["shard"], *unpacked(r["seq"])) for r in rows]
            bits = lists[0][3]
            values, counts = merged([(v, n) for _, v, n, _ in lists])
            values, counts = values[counts >= least], counts[counts >= least]
            if not len(values):
                continue
            yield found_rows(len(values), kind=STATE, block=block, key=restored(values, bits).view(np.int64), nr=np.arange(len(values)), n=counts)
            for shard, v, _, _ in lists:
                nr = look_up(values, v)
                here = nr > 0
                if here.any():
                    yield found_rows(1, kind=SAID, block=block, shard=shard, seq=[restored(v[here], bits).astype("<u8").tobytes()], phrases=[squeezed_numbers(nr[here] - 1)])

    return run


def _id_bits(found: DataFrame) -> tuple[int, int]:
    """How many bits the number in a block and the whole id have."""
    most = found.agg(F.max("block").alias("block"), F.max("nr").alias("nr")).first()
    low, high = max((most["nr"] or 0).bit_length(), 1), max((most["block"] or 0).bit_length(), 1)
    return low, low + high


def _id(low: int) -> Column:
    return F.shiftleft("block", low).bitwiseOR(F.col("nr"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sizes: Sizes = SIZES) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n: all words) and, for each length from 1, the phrases that occur ``least`` times or more.

    id, lang, phrase, a (its count); prefix_id and suffix_id (all words but the last, but the first), word_id (the last), firsts
    and lasts (counts of its first and last 1, 2, ... words).
    """
    rows = small_batches(docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")))
    # as many blocks of words as the input has partitions, which are of a bounded size
    block_bits = (rows.rdd.getNumPartitions() - 1).bit_length()
    shards = in_kinds(rows.mapInArrow(_encode(sizes, block_bits), ROWS_DDL), "shards")

    def merge(step: DataFrame, how, name: str) -> DataFrame:
        said = step.where(F.col("kind") == SAID).drop("kind").repartition("part").sortWithinPartitions("part", "shard")
        return in_kinds(said.mapInArrow(how, FOUND_DDL), name)

    def told(found: DataFrame) -> DataFrame:
        nothing = F.lit(None).cast("binary").alias("words")
        return found.where(F.col("kind") == SAID).select("shard", F.lit(TOLD).cast("long").alias("part"), F.col("block").alias("key"), "seq", "phrases", nothing)

    found = merge(shards, _merge_words(least), "merged-words")
    totals = kept(found.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    words = found.where(F.col("kind") == STATE)
    low, bits = _id_bits(words)
    word_bits, longs = bits, F.array().cast("array<long>")
    levels = [kept(words.select(_id(low).alias("id"), "lang", F.col("word").alias("phrase"), F.col("n").alias("a"), *(F.lit(None).cast("long").alias(c) for c in ("prefix_id", "suffix_id")), _id(low).alias("word_id"), longs.alias("firsts"), longs.alias("lasts")), "phrases-1")]
    step = shards
    for length in range(1, longest):
        most = levels[-1].agg(F.sum("a")).first()[0] or 0
        if not most:
            break
        bits += word_bits
        if bits > 64:
            raise ValueError("more different phrases than keys of 64 bits can tell apart")
        block_bits = min((most // sizes.block).bit_length(), bits)
        state = step.where(F.col("kind") == STATE).select("shard", "part", F.lit(None).cast("long").alias("key"), "seq", "phrases", "words")
        every = state.unionByName(told(found)).repartition("shard").sortWithinPartitions("shard", "part")
        grow = _grow(length, low, word_bits, bits, block_bits, length == longest - 1, sizes.row)
        step = in_kinds(every.mapInArrow(grow, ROWS_DDL), "phrase-filters")
        found = merge(step, _merge(least), "merged-filters")
        new = found.where(F.col("kind") == STATE)
        low, bits = _id_bits(new)
        new = new.select(_id(low).alias("id"), F.shiftrightunsigned("key", word_bits).alias("prefix_id"), F.col("key").bitwiseAND((1 << word_bits) - 1).alias("word_id"), F.col("n").alias("a"))
        levels.append(kept(_described(new, levels), f"phrases-{length + 1}"))
    return totals, levels


def _described(new: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Phrases with what their first and last words say."""
    first = levels[-1].select(F.col("id").alias("prefix_id"), "lang", F.col("phrase").alias("first_words"), F.col("a").alias("first_a"), F.col("firsts").alias("before"), F.col("suffix_id").alias("middle_id"))
    last = levels[-1].select(F.col("id").alias("suffix_id"), F.col("prefix_id").alias("middle_id"), "word_id", F.element_at(F.split("phrase", " "), -1).alias("word"), F.col("a").alias("last_a"), F.col("lasts").alias("behind"))
    rows = new.join(first, "prefix_id")
    rows = rows.join(last.drop("middle_id"), "word_id") if len(levels) == 1 else rows.join(last, ["middle_id", "word_id"])
    return rows.select(
        "id", "lang", F.concat_ws(" ", "first_words", "word").alias("phrase"), "a", "prefix_id", "suffix_id", "word_id",
        F.concat("before", F.array("first_a")).alias("firsts"), F.concat("behind", F.array("last_a")).alias("lasts"),
    )


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, cover: int = COVER, top: int = TOP, sizes: Sizes = SIZES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    totals, levels = frequent_phrases(docs, least, longest, sizes)
    candidates = []
    for i, level in enumerate(levels[1:], 1):
        rows = level
        if i + 1 < len(levels):
            more = levels[i + 1]
            around = more.select(F.col("prefix_id").alias("id"), F.col("a").alias("around")).unionByName(more.select(F.col("suffix_id").alias("id"), F.col("a").alias("around")))
            rows = rows.join(around.groupBy("id").agg(F.max("around").alias("around")), "id", "left").where(f"around IS NULL OR 100 * around < {cover} * a")
        candidates.append(rows.select("lang", "phrase", "a", "firsts", "lasts"))
    if not candidates:
        candidates = [levels[0].select("lang", "phrase", "a", "firsts", "lasts").where(F.lit(False))]
    rows = reduce(DataFrame.unionByName, candidates).join(totals, "lang")
    # 1000 a n has 37 digits at most, l r 32
    score = "CAST(CAST(1000 AS DECIMAL(4)) * CAST(a AS DECIMAL(16)) * CAST(n AS DECIMAL(18)) AS DECIMAL(38)) div CAST(CAST(firsts[k] AS DECIMAL(16)) * CAST(lasts[size(lasts) - 1 - k] AS DECIMAL(16)) AS DECIMAL(38))"
    best = F.expr(f"array_min(transform(sequence(0, size(firsts) - 1), k -> struct({score} AS score, k AS k, firsts[k] AS l, lasts[size(lasts) - 1 - k] AS r)))")
    rows = rows.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # the first of each of some parts of a language, then the first of those: no task gets more than these
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    rows = rows.withColumn("part", part).withColumn("rank", first).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
