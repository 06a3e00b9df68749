"""Wavelet matrix: a sequence of integers as bit planes with rank support."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Bit planes from the highest bit down; below a plane its zeros come first, in order."""

    def __init__(self, planes: list[np.ndarray], size: int) -> None:
        self.size = size
        # entry i: zeros before position i
        self.zeros = []
        for plane in planes:
            count = np.zeros(size + 1, np.int64)
            np.cumsum(~plane, out=count[1:])
            self.zeros.append(count)

    @classmethod
    def of(cls, values: np.ndarray, n_bits: int) -> WaveletMatrix:
        return cls(list(planes_of(values, n_bits)), len(values))

    def place(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of the sequence falls in the last order, as seen by ``value``.

        The difference of two such places is the number of times that ``value`` stands between.
        """
        for k, zeros in enumerate(self.zeros):
            low = zeros[at]
            bit = (value >> (len(self.zeros) - 1 - k)) & 1
            at = np.where(bit == 1, zeros[-1] + at - low, low)
        return at

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``value`` stands before position ``at``."""
        return self.place(value, at) - self.place(value, np.zeros_like(at))

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at some positions."""
        value = np.zeros(len(at), np.int64)
        for zeros in self.zeros:
            low = zeros[at]
            bit = zeros[at + 1] == low
            at = np.where(bit, zeros[-1] + at - low, low)
            value = (value << 1) | bit
        return value

    def select(self, value: int, nth: np.ndarray) -> np.ndarray:
        """The position of the ``nth`` occurrence (from 0) of ``value``."""
        at = self.place(np.int64(value), np.int64(0)) + nth
        for k in range(len(self.zeros) - 1, -1, -1):
            zeros = self.zeros[k]
            if (value >> (len(self.zeros) - 1 - k)) & 1:
                ones = np.arange(self.size + 1) - zeros
                at = np.searchsorted(ones, at - zeros[-1] + 1) - 1
            else:
                at = np.searchsorted(zeros, at + 1) - 1
        return at


def planes_of(values: np.ndarray, n_bits: int):
    """The planes as arrays of booleans, one after the other."""
    for k in range(n_bits - 1, -1, -1):
        plane = (values & values.dtype.type(1 << k)).astype(bool)
        yield plane
        ones = np.flatnonzero(plane)
        if k and len(ones):
            n_zeros = len(values) - len(ones)
            below = np.empty_like(values)
            np.take(values, np.flatnonzero(~plane), out=below[:n_zeros], mode="clip")
            np.take(values, ones, out=below[n_zeros:], mode="clip")
            values = below


def values_of(planes: list[np.ndarray], dtype) -> np.ndarray:
    """The whole sequence, from the lowest plane up."""
    values = np.zeros(len(planes[0]) if planes else 0, dtype)
    for k, plane in enumerate(reversed(planes)):
        ones = np.flatnonzero(plane)
        if len(ones):
            n_zeros = len(plane) - len(ones)
            above = np.empty_like(values)
            above[np.flatnonzero(~plane)] = values[:n_zeros]
            above[ones] = values[n_zeros:] | dtype(1 << k)
            values = above
    return values
