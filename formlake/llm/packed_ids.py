"""Patched frame-of-reference coding of token ids, and the file format built on it.

Ids are cut into blocks of 128. A block stores its minimum, a bit width chosen so that a
percentile of its differences from the minimum fits, the low bits of all differences, and
the high bits of the few that don't fit in an exception list with their places.

A file holds whole documents; its header is big-endian, the rest little-endian:

    header   magic, version, range number, file number in the range, position of the
             file's first id in its range, counts of documents, ids and exceptions,
             bytes of an exception's high bits
    documents  ids (int64), null flags (uint8), lengths (uint32)
    blocks   minimum (uint32), width (uint8), exceptions (uint8), start of the packed
             bits (uint64, in bytes): the index by which a block is found
    exceptions  place in the block (uint8), high bits (1, 2 or 4 bytes)
    bits     the packed blocks, those of one width together
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

BLOCK = 128
MAGIC = b"PFORIDS\x01"
_HEADER = struct.Struct(">8sqqqqqqq")
#: Where the header has the range number and the count of ids, from 1, in 8 bytes each.
RANGE_AT, COUNT_AT = 9, 41
_SLAB = 4096  # blocks whose bits are spread out in memory at a time


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits needed for each unsigned 32-bit value."""
    _, exponents = np.frexp(values.astype(np.float64))
    return exponents.astype(np.uint8)


def _container(width: int) -> np.dtype:
    """The narrowest little-endian integer that holds so many bits."""
    return np.dtype("u1" if width <= 8 else "<u2" if width <= 16 else "<u4")


def _pack_groups(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value; eight values fill ``width`` bytes, by way of 64-bit words."""
    groups = (values & np.uint32((1 << width) - 1)).astype(np.uint64).reshape(-1, 8)
    words = np.zeros((len(groups), -(-width // 8) + 1), np.uint64)
    for k in range(8):
        word, shift = divmod(k * width, 64)
        words[:, word] |= groups[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= groups[:, k] >> np.uint64(64 - shift)
    return words.view(np.uint8)[:, :width].tobytes()


def _unpack_groups(packed: np.ndarray, width: int) -> np.ndarray:
    """The values that ``_pack_groups`` was given, in blocks."""
    groups = packed.reshape(-1, width)
    words = np.zeros((len(groups), -(-width // 8) + 1), np.uint64)
    words.view(np.uint8)[:, :width] = groups
    mask = np.uint64((1 << width) - 1)
    values = np.empty((len(groups), 8), np.uint32)
    for k in range(8):
        word, shift = divmod(k * width, 64)
        got = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            got |= words[:, word + 1] << np.uint64(64 - shift)
        values[:, k] = got & mask
    return values.reshape(-1, BLOCK)


@dataclass
class Blocks:
    minima: np.ndarray
    widths: np.ndarray
    patched: np.ndarray  # exceptions in each block
    starts: np.ndarray
    places: np.ndarray
    high: np.ndarray
    bits: bytes
    count: int


def pack(ids: np.ndarray, percentile: float = 0.95) -> Blocks:
    """Code ids (uint32); the last block is filled up with its last id."""
    count = len(ids)
    n = -(-count // BLOCK)
    table = np.full(n * BLOCK, ids[-1] if count else 0, np.uint32)
    table[:count] = ids
    table = table.reshape(n, BLOCK)
    minima = table.min(axis=1) if n else np.zeros(0, np.uint32)
    deltas = table - minima[:, None]
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    widths = _bit_lengths(np.partition(deltas, at, axis=1)[:, at]) if n else np.zeros(0, np.uint8)
    fits = ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    rows, places = np.nonzero(deltas > fits[:, None])
    high = deltas[rows, places] >> np.minimum(widths, 31)[rows].astype(np.uint32)
    starts = np.zeros(n, np.uint64)
    bits, size = [], 0
    for width in np.unique(widths).tolist():
        chosen = np.nonzero(widths == width)[0]
        each = width * BLOCK // 8
        starts[chosen] = size + np.arange(len(chosen)) * each
        size += len(chosen) * each
        if width == 0:
            continue
        kind = _container(width)
        for first in range(0, len(chosen), _SLAB):
            part = chosen[first : first + _SLAB]
            if width == kind.itemsize * 8:
                bits.append(deltas[part].astype(kind).tobytes())
                continue
            bits.append(_pack_groups(deltas[part], width))
    return Blocks(
        minima, widths, np.bincount(rows, minlength=n).astype(np.uint8), starts,
        places.astype(np.uint8), high, b"".join(bits), count,
    )


def unpack(blocks: Blocks) -> np.ndarray:
    """The ids that ``pack`` was given."""
    n = len(blocks.minima)
    deltas = np.zeros((n, BLOCK), np.uint32)
    bits = np.frombuffer(blocks.bits, np.uint8)
    for width in np.unique(blocks.widths).tolist():
        if width == 0:
            continue
        chosen = np.nonzero(blocks.widths == width)[0]
        each = width * BLOCK // 8
        kind = _container(width)
        for first in range(0, len(chosen), _SLAB):
            part = chosen[first : first + _SLAB]
            start = int(blocks.starts[part[0]])
            if width == kind.itemsize * 8:
                deltas[part] = bits[start : start + len(part) * each].view(kind).reshape(len(part), BLOCK)
                continue
            deltas[part] = _unpack_groups(bits[start : start + len(part) * each], width)
    rows = np.repeat(np.arange(n), blocks.patched)
    places = blocks.places.astype(np.int64)
    deltas[rows, places] |= blocks.high.astype(np.uint32) << blocks.widths[rows].astype(np.uint32)
    return (deltas + blocks.minima[:, None]).reshape(-1)[: blocks.count]


@dataclass
class TokenFile:
    """What one file holds; doc_ids has None for null ids."""

    range_no: int
    file_no: int
    first: int  # ids of the range before this file
    doc_ids: list[int | None]
    lengths: np.ndarray
    ids: np.ndarray

    def to_bytes(self, percentile: float = 0.95) -> bytes:
        blocks = pack(self.ids, percentile)
        top = int(blocks.high.max()) if len(blocks.high) else 0
        wide = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
        header = _HEADER.pack(
            MAGIC, self.range_no, self.file_no, self.first, len(self.doc_ids), len(self.ids), len(blocks.high), wide
        )
        known = np.array([d or 0 for d in self.doc_ids], "<i8")
        null = np.array([d is None for d in self.doc_ids], "u1")
        parts = [
            header, known, null, self.lengths.astype("<u4"),
            blocks.minima.astype("<u4"), blocks.widths, blocks.patched, blocks.starts.astype("<u8"),
            blocks.places, blocks.high.astype(f"<u{wide}"), blocks.bits,
        ]
        return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, content: bytes) -> TokenFile:
        magic, range_no, file_no, first, docs, count, exceptions, wide = _HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(content, kind, n, at)
            at += got.nbytes
            return got

        known, null, lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        n = -(-count // BLOCK)
        minima, widths, patched, starts = take("<u4", n), take("u1", n), take("u1", n), take("<u8", n)
        places, high = take("u1", exceptions), take(f"<u{wide}", exceptions)
        size = int(widths.astype(np.int64).sum()) * BLOCK // 8
        blocks = Blocks(minima, widths, patched, starts, places, high, content[at : at + size], count)
        doc_ids = [None if missing else int(d) for d, missing in zip(known, null)]
        return cls(range_no, file_no, first, doc_ids, lengths, unpack(blocks))
