"""Words of many texts as hashed numbers, without a Python loop over words.

Words are runs of ASCII letters, digits and bytes from 0x80 up; a '.' or ',' between two
digits belongs to the number. Where asked for, digits and what is glued to them are words of their own. ASCII and Latin-1 capitals count as small letters. A word's
hash is the polynomial of its bytes modulo 2^64, mixed: equal on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes that are hashed at once; a longer word makes its block longer.
BLOCK = 1 << 19
#: Texts are taken in groups of about this many bytes.
GROUP = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True

_known: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of MurmurHash3)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept, as every block needs them."""
    have = _known.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 1), base, dtype=np.uint64)
        have[0] = 1
        _known[int(base)] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


@dataclass
class Words:
    """``doc``: index of the text; ``hash``: of the word; ``prefix``: hashes of its first bytes, one array for each asked length; ``start``, ``end``: its bytes in ``raw``; ``bounds``: first word of each text, then the number of words."""

    doc: np.ndarray
    hash: np.ndarray
    prefix: list[np.ndarray]
    start: np.ndarray
    end: np.ndarray
    raw: np.ndarray
    bounds: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by one blank, and where each begins; null counts as empty."""
    col = texts.cast(pa.large_string()).fill_null("")
    n = len(col)
    ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if n and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    raw = np.full(int(ends[-1] - ends[0]) + n, 32, dtype=np.uint8)
    starts = ends[:-1] - ends[0] + np.arange(n)
    blank = np.zeros(len(raw), dtype=bool)
    blank[starts + np.diff(ends)] = True
    raw[~blank] = data[ends[0] : ends[-1]]
    return raw, starts


def groups(texts: pa.Array, size: int = GROUP) -> Iterator[tuple[int, pa.Array]]:
    """Slices of the column of about ``size`` bytes, with the index of their first text; a longer text is a slice of its own."""
    lengths = np.asarray(pc.binary_length(texts.cast(pa.large_string())).fill_null(0))
    total, at = np.cumsum(lengths), 0
    while at < len(texts):
        before = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


def words(texts: pa.Array, prefixes: tuple[int, ...] = (), split: bool = False) -> Words:
    """All words of the texts, in order; ``split`` parts numbers from letters ('50kg')."""
    raw, starts = text_bytes(texts)
    inside = WORD[raw]
    if len(raw) > 2:
        digit = DIGIT[raw]
        inside[1:-1] |= ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & digit[:-2] & digit[2:]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if split and len(raw):
        digit = DIGIT[raw] | (inside & ~WORD[raw])
        parts = np.flatnonzero(inside[1:] & inside[:-1] & (digit[1:] != digit[:-1])) + 1
        start, end = np.sort(np.concatenate([start, parts])), np.sort(np.concatenate([end, parts]))
    hashes = [np.empty(len(start), np.uint64) for _ in range(1 + len(prefixes))]
    first = 0
    with np.errstate(over="ignore"):
        while first < len(start):
            last = max(first + 1, int(np.searchsorted(end, start[first] + BLOCK, side="right")))
            a, b = start[first:last] - start[first], end[first:last] - start[first]
            part = raw[start[first] : end[last - 1]]
            low = LOWER[part]
            # Latin-1 capitals: 0x80..0x9E after 0xC3, but for the multiplication sign
            low[1:] += ((part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[1:] != 0x97)).astype(np.uint8) * np.uint8(32)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(len(part)), out=total[1:])
            back, begin, size = powers(len(part) + 1, INVERSE)[a], total[a], (b - a).astype(np.uint64)
            hashes[0][first:last] = mix((total[b] - begin) * back + size)
            for i, n in enumerate(prefixes):
                to = np.minimum(a + n, b)
                hashes[1 + i][first:last] = mix((total[to] - begin) * back + np.uint64(n * 7919) + np.minimum(size, np.uint64(n + 1)))
            first = last
    bounds = np.concatenate((np.searchsorted(start, starts), [len(start)])).astype(np.int64)
    return Words(np.repeat(np.arange(len(starts)), np.diff(bounds)), hashes[0], hashes[1:], start, end, raw, bounds)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted number in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)
