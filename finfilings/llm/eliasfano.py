"""Elias-Fano lists: rising numbers in about 2 + log2(universe / n) bits each.

The high bits of the numbers are a bit vector (a one for each number, a zero for each step
of the high part), the low bits are packed.  Access selects ones, successor search reads on
through the list; both work on whole arrays of queries, straight out of a buffer such as a
mapped file.
"""

from __future__ import annotations

import numpy as np

_SLICE = 1 << 15
#: Numbers that a successor search decodes at a time.
_PART = 1 << 14
_ONE = np.uint64(1)


def encode(values: np.ndarray) -> bytes:
    """A list of rising whole numbers (repeats allowed) below 2^62."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    most = int(values[-1]) if n else 0
    low = max(0, min(56, (most // max(n, 1)).bit_length() - 1))
    high = np.zeros(-(-(n + (most >> low) + 1) // 64), np.uint64)
    for at in range(0, n, _SLICE):
        part = values[at:at + _SLICE]
        place = (part >> np.uint64(low)) + np.arange(at, at + len(part), dtype=np.uint64)
        np.bitwise_or.at(high, (place >> np.uint64(6)).astype(np.int64), _ONE << (place & np.uint64(63)))
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
    packed = []
    for at in range(0, n if low else 0, _SLICE):  # a slice fills whole bytes but for the last
        part = values[at:at + _SLICE]
        packed.append(np.packbits(((part[:, None] >> np.arange(low, dtype=np.uint64)) & _ONE).astype(np.uint8).ravel(), bitorder="little").tobytes())
    lows = b"".join(packed) + b"\0" * 8
    lows += b"\0" * (-len(lows) % 8)
    return np.array([n, low, len(high), len(lows)], "<u8").tobytes() + high.astype("<u8").tobytes() + before.astype("<u8").tobytes() + lows


def _nth_one(word: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th set bit (from 0) of each word."""
    at = np.zeros(len(word), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        part = word & np.uint64((1 << step) - 1)
        ones = np.bitwise_count(part).astype(np.int64)
        over = n >= ones
        n = np.where(over, n - ones, n)
        word = np.where(over, word >> np.uint64(step), part)
        at += step * over
    return at


class EliasFano:
    """An encoded list at ``offset`` of a buffer; ``end`` is the offset behind it."""

    def __init__(self, buffer, offset: int = 0):
        self.n, self.low, words, lows = (int(x) for x in np.frombuffer(buffer, "<u8", 4, offset))
        offset += 32
        self.high = np.frombuffer(buffer, "<u8", words, offset)
        self.ones = np.frombuffer(buffer, "<i8", words + 1, offset + 8 * words)
        offset += 16 * words + 8
        # an unaligned 64-bit number at every byte
        self.lows = np.ndarray((lows - 7,), "<u8", buffer, offset, (1,))
        self.end = offset + lows

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        return (self.lows[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places ``i``."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, "right") - 1
        high = 64 * word + _nth_one(self.high[word], i - self.ones[word]) - i
        return ((high.astype(np.uint64) << np.uint64(self.low)) | self._low(i)).astype(np.int64)

    def part(self, begin: int, end: int) -> np.ndarray:
        """The numbers at the places from ``begin`` to before ``end``, read in one go."""
        first, last = np.searchsorted(self.ones, [begin, end - 1], "right") - 1
        bits = np.unpackbits(self.high[first:last + 1].view(np.uint8), bitorder="little")
        skip = begin - int(self.ones[first])
        at = np.arange(begin, end)
        high = 64 * first + np.flatnonzero(bits)[skip:skip + end - begin] - at
        return (high << self.low) | self._low(at).astype(np.int64)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number that is ``x`` or more (n if none), and whether it is x.

        The questions go in rising order over the list, of which only parts are decoded that
        have one: no question searches bits by itself.
        """
        x = np.asarray(x, np.int64)
        place, found = np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        if not self.n or not len(x):
            return place, found
        order = np.argsort(x, kind="stable")
        x = x[order]
        starts = np.arange(0, self.n, _PART)
        # a number above a part's first one, up to the next part's, has its successor there or at that
        own = np.maximum(np.searchsorted(self[starts], x) - 1, 0)
        cuts = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(x))
        for a, b in zip(cuts[:-1], cuts[1:]):
            begin = int(starts[own[a]])
            numbers = self.part(begin, min(begin + _PART + 1, self.n))
            i = np.searchsorted(numbers, x[a:b])
            place[order[a:b]] = begin + i
            found[order[a:b]] = (i < len(numbers)) & (numbers[np.minimum(i, len(numbers) - 1)] == x[a:b])
        return place, found
