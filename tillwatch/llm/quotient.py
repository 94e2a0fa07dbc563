"""Counting quotient filters over keys of a known number of bits, without loss.

A key goes through an invertible permutation of its bits. The upper bits of the result are the
quotient, which is not stored but counted: a bit 1 for each entry and a 0 at the end of each
quotient's run. The others are the remainder, stored in full, so equal remainders of a quotient
are equal keys, and keys can be had back. Entries are in the order of the permuted keys. A bit says whether an entry's
count is more than one; such a count takes a byte, and those that need more stand behind. Filters in this order are merged like sorted lists.
"""

from __future__ import annotations

import struct

import numpy as np

#: Odd multipliers of the permutation; any odd numbers do.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
HEAD = struct.Struct("<QIBBI")
LARGE = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _xor_shift(x: np.ndarray, bits: int) -> np.ndarray:
    return x ^ (x >> np.uint64((bits + 1) // 2))  # its own inverse, as the shift is half the bits at least


def permuted(keys: np.ndarray, bits: int) -> np.ndarray:
    """A bijection of the numbers below 2^bits."""
    x = keys.astype(np.uint64)
    with np.errstate(over="ignore"):
        for m in MULTIPLIERS:
            x = _xor_shift((x * np.uint64(m)) & _mask(bits), bits)
    return x


def restored(values: np.ndarray, bits: int) -> np.ndarray:
    """The keys of permuted values."""
    x = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        for m in reversed(MULTIPLIERS):
            x = (_xor_shift(x, bits) * np.uint64(pow(m, -1, 1 << 64))) & _mask(bits)
    return x


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, and how often each occurs."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(np.concatenate((first, [len(values)])))


def _bits(values: np.ndarray, size: int) -> bytes:
    """Numbers of ``size`` bits, one behind the other."""
    return np.packbits(np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - size :]).tobytes()


def packed(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of permuted values of ``bits`` bits, different and in order."""
    n = len(values)
    low = int(values[0]) if n else 0
    # about as many quotients as entries
    size = max((int(values[-1]) - low).bit_length() - n.bit_length(), 0) if n else 0
    offset = values - np.uint64(low)
    quotient = (offset >> np.uint64(size)).astype(np.int64)
    slots = int(quotient[-1]) + 1 if n else 0
    ones = np.zeros(n + slots, dtype=np.uint8)
    ones[quotient + np.arange(n)] = 1
    several = counts > 1
    more = counts[several]
    large = more > LARGE
    head = HEAD.pack(low, n, bits, size, slots)
    return b"".join(
        [head, np.packbits(ones).tobytes(), _bits(offset, size), np.packbits(several).tobytes(), np.where(large, 0, more).astype(np.uint8).tobytes(), more[large].astype("<i8").tobytes()]
    )


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(permuted values in order, counts, bits) of a filter."""
    low, n, bits, size, slots = HEAD.unpack_from(data)
    raw, at = np.frombuffer(data, dtype=np.uint8), HEAD.size

    def take(count: int) -> np.ndarray:
        """The next so many bits."""
        nonlocal at
        begin, at = at, at + -(-count // 8)
        return np.unpackbits(raw[begin:at], count=count)

    quotient = np.flatnonzero(take(n + slots)) - np.arange(n)
    rest = np.zeros((n, 64), dtype=np.uint8)
    rest[:, 64 - size :] = take(n * size).reshape(n, size)
    offset = np.packbits(rest, axis=1).view(">u8").ravel().astype(np.uint64)
    counts = np.ones(n, dtype=np.int64)
    several = np.flatnonzero(take(n))
    more = raw[at : at + len(several)].astype(np.int64)
    more[more == 0] = np.frombuffer(data, dtype="<i8", offset=at + len(several))
    counts[several] = more
    return (offset | (quotient.astype(np.uint64) << np.uint64(size))) + np.uint64(low), counts, bits


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Values and counts of several sorted lists as one; counts of equal values add up."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values, counts = (np.concatenate(x) for x in zip(*parts))
    if len(parts) > 1:
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
    if not len(values):
        return values, counts
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.add.reduceat(counts, first)
