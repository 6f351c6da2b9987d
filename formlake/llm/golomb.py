"""Golomb coding, with a power of two as divisor, of sorted distinct numbers."""

from __future__ import annotations

import numpy as np


def encode(sorted_values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Divisor bits, unary quotients and binary remainders of the gaps (uint64, ascending)."""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    mean = float(sorted_values[-1]) / len(sorted_values)
    bits = max(0, int(np.floor(np.log2(max(1.0, mean * 0.69)))))
    ends = np.cumsum((gaps >> np.uint64(bits)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    low = ((gaps[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return bits, np.packbits(unary).tobytes(), np.packbits(low.reshape(-1)).tobytes()


def decode(count: int, bits: int, unary: bytes, low: bytes) -> np.ndarray:
    """The numbers that ``encode`` was given."""
    ends = np.nonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[0][:count] + 1
    gaps = (np.diff(ends, prepend=0) - 1).astype(np.uint64) << np.uint64(bits)
    if bits:
        spread = np.unpackbits(np.frombuffer(low, np.uint8))[: count * bits].reshape(count, bits)
        gaps += (spread.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)
