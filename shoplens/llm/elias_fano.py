"""Elias-Fano sequences and an n-gram trie made of them, read in place from one buffer."""

from __future__ import annotations

import struct

import numpy as np

BLOCK_BITS = 64
POPCOUNT = np.array([b.bit_count() for b in range(256)], np.int8)
# where the k-th one of a byte stands, from its highest bit
PLACES = np.array(
    [([k for k in range(8) if b >> (7 - k) & 1] + [8] * 8)[:8] for b in range(256)], np.int8
)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after the other, each with its type and length and aligned to 8 bytes."""
    parts = [struct.pack("<Q", len(arrays))]
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        parts.append(struct.pack("<8sQ", a.dtype.str.encode(), len(raw)))
        parts.append(raw + bytes(-len(raw) % 8))
    return b"".join(parts)


def unpack(buffer) -> list[np.ndarray]:
    """Views of the arrays in a buffer of ``pack``; nothing is copied."""
    (n,) = struct.unpack_from("<Q", buffer, 0)
    out, at = [], 8
    for _ in range(n):
        kind, size = struct.unpack_from("<8sQ", buffer, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        out.append(np.frombuffer(buffer, dtype, size // dtype.itemsize, at + 16))
        at += 16 + size + -size % 8
    return out


class EliasFano:
    """A non-decreasing sequence of unsigned numbers.

    The low bits of each number are stored as they are, the high bits as a bit string with a one for
    each number and a zero for each step of the high part. Counts before blocks of the bit string
    lead to the k-th one or zero.
    """

    def __init__(self, arrays: list[np.ndarray]) -> None:
        head, self.low, self.high, self.ones = arrays
        self.size, self.low_bits = int(head[0]), int(head[1])
        self.low_mask = np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def arrays(values: np.ndarray, universe: int) -> list[np.ndarray]:
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        mask = np.uint64((1 << low_bits) - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        n_bits = n + (universe >> low_bits) + 1
        bits = np.zeros(-(-n_bits // BLOCK_BITS) * BLOCK_BITS, np.uint8)
        bits[high + np.arange(n)] = 1
        ones = np.concatenate(([0], np.cumsum(bits.reshape(-1, BLOCK_BITS).sum(axis=1, dtype=int))))
        low = EliasFano._packed(values & mask, low_bits)
        return [np.array([n, low_bits]), low, np.packbits(bits), ones.astype(np.int32)]

    @staticmethod
    def _packed(low: np.ndarray, width: int) -> np.ndarray:
        words = np.zeros((len(low) * width >> 6) + 2, np.uint64)
        if not width:
            return words
        at = np.arange(len(low), dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(words, word, low << shift)
        over = shift + np.uint64(width) > 64
        np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        return words

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> shift
        over = np.flatnonzero(shift + np.uint64(self.low_bits) > 64)
        out[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return out & self.low_mask

    def _select(self, nth: np.ndarray, bit: int) -> np.ndarray:
        """Where the ``nth`` one or zero of the high bits stands."""
        before = self.ones
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = np.searchsorted(before, nth, side="right") - 1
        rest = nth - before[block]
        width = BLOCK_BITS // 8
        own = self.high[block[:, None] * width + np.arange(width)]
        own = own if bit else ~own
        counts = np.cumsum(POPCOUNT[own], axis=1, dtype=np.int8)
        byte = (counts <= rest[:, None]).sum(axis=1)
        row = np.arange(len(nth))
        found = own[row, byte]
        rest = rest - counts[row, byte] + POPCOUNT[found]
        return block * BLOCK_BITS + byte * 8 + PLACES[found, rest]

    def access(self, index: np.ndarray) -> np.ndarray:
        high = (self._select(index, 1) - index).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(index)

    def successor(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the first number that is at least ``value`` and whether it is equal.

        The index is the size if there is none; ``value`` must not exceed the universe.
        """
        high = (value >> np.uint64(self.low_bits)).astype(np.int64)
        low = np.where(high > 0, self._select(np.maximum(high - 1, 0), 0) - high + 1, 0)
        last = self._select(high, 0) - high
        end = last.copy()
        want = value & self.low_mask
        # binary search among the numbers of the same high part
        open_ = np.flatnonzero(low < end)
        while len(open_):
            middle = (low[open_] + end[open_]) >> 1
            less = self._low(middle) < want[open_]
            low[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < end[open_]]
        equal = low < last
        equal[equal] = self._low(low[equal]) == want[equal]
        return low, equal


class Trie:
    """Words and, below each, the words that precede it, with quantised values on both levels.

    A level of keys is one Elias-Fano sequence. The keys below a word are stored relative to its
    number, so that they rise throughout, and are found by a successor search from there. Where a
    word's children begin is a second sequence.
    """

    CODES = 1 << 16

    def __init__(self, buffer) -> None:
        arrays = unpack(buffer)
        self.words = EliasFano(arrays[0:4])
        self.children = EliasFano(arrays[4:8])
        self.contexts = EliasFano(arrays[8:12])
        self.word_codes, self.context_codes, self.scale = arrays[12:15]

    @staticmethod
    def build(
        words: np.ndarray, word_values: np.ndarray, owner: np.ndarray, contexts: np.ndarray,
        context_values: np.ndarray,
    ) -> bytes:
        """``words`` rise; ``owner`` (index of the word) and ``contexts`` (32 bits) rise together."""
        starts = np.searchsorted(owner, np.arange(len(words) + 1)).astype(np.uint64)
        keys = (owner.astype(np.uint64) << np.uint64(32)) | contexts.astype(np.uint64)
        values = np.concatenate((word_values, context_values, [0.0]))
        lowest, step = values.min(), max(float(np.ptp(values)), 1e-9) / (Trie.CODES - 1)

        def codes(x: np.ndarray) -> np.ndarray:
            return np.rint((x - lowest) / step).astype(np.uint16)

        top = int(words[-1]) + 1 if len(words) else 1
        return pack(
            [
                *EliasFano.arrays(words, top),
                *EliasFano.arrays(starts, len(owner) + 1),
                *EliasFano.arrays(keys, max(len(words), 1) << 32),
                codes(word_values), codes(context_values), np.array([lowest, step]),
            ]
        )

    def _values(self, codes: np.ndarray) -> np.ndarray:
        return codes * self.scale[1] + self.scale[0]

    def find(self, words: np.ndarray) -> np.ndarray:
        """The index of each word, -1 where it is unknown."""
        found = np.full(len(words), -1)
        if self.words.size:
            top = self.words.access(np.array([self.words.size - 1]))[0]
            inside = np.flatnonzero(words <= top)
            at, equal = self.words.successor(words[inside])
            found[inside[equal]] = at[equal]
        return found

    def word_values(self) -> np.ndarray:
        return self._values(self.word_codes)

    def after(self, index: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """The values of known words (by index) after their contexts, NaN where it is not stored."""
        starts = self.children.access(np.arange(self.words.size + 1)).astype(np.int64)
        out = np.full(len(index), np.nan)
        have = np.flatnonzero(starts[index + 1] > starts[index])
        index, contexts = index[have], contexts[have].astype(np.uint64)
        at, equal = self.contexts.successor((index.astype(np.uint64) << np.uint64(32)) | contexts)
        out[have[equal]] = self._values(self.context_codes[at[equal]])
        return out
