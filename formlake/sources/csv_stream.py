"""Stream CSV text into Arrow batches whose columns are all text.

Records are found first, then parsed: a block that goes to the parser holds whole records,
so a cell may be as long as memory allows, and hold line breaks. Lines may end in LF, CR LF
or CR.
"""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from collections.abc import Iterator
from contextlib import closing
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv

from formlake.sources.ahead import made_ahead

# Fixed value: the text that means a missing cell, besides an empty one.
MISSING_TEXT = "NA"

BLOCK_BYTES = 4 << 20
SHORT_ROWS = "rows with missing cells"

_QUOTE, _COMMA, _LF, _CR = b'",\n\r'
BOM = b"\xef\xbb\xbf"
# Where quotes stand inside cells, a record is found cell by cell.
_CELL = rb'(?:"(?:[^"]++|"")*+"[^,\r\n]*+|(?!")[^,\r\n]*+)'
_RECORD = re.compile(_CELL + rb"(?:," + _CELL + rb")*+(?:\r\n|\n|\r)")


class HeaderError(ValueError):
    """The first record doesn't name columns."""


class QuoteScan:
    """Quotes and line ends of a byte stream, taken piece by piece.

    A quote counts as a mark if cells are quoted as a whole, which can be seen: an opening
    mark follows a separator, a closing one comes before a separator or another mark. Then
    a line end closes a record if the number of marks before it is even.
    """

    def __init__(self, inside: bool = False, before: int = _LF):
        self.inside, self.faulty = inside, False
        self._before = before

    def take(self, piece: bytes, after: int | None = None) -> np.ndarray:
        """Positions behind the line ends that close a record.

        ``after`` is the byte behind the piece, where it is known.
        """
        signs = np.frombuffer(piece, np.uint8)
        quotes = np.flatnonzero(signs == _QUOTE)
        ends = np.flatnonzero((signs == _LF) | (signs == _CR))
        if len(signs):
            closing = (np.arange(len(quotes)) + self.inside) % 2 == 1
            before = np.where(quotes > 0, signs[quotes - 1], self._before)
            last = _COMMA if after is None else after
            behind = np.append(signs, np.uint8(last))[quotes + 1]
            next_to = np.where(closing, behind, before)
            sound = (next_to == _COMMA) | (next_to == _LF) | (next_to == _CR) | (next_to == _QUOTE)
            self.faulty |= not sound.all()
            if self._before == _QUOTE and not self.inside and signs[0] not in (_QUOTE, _COMMA, _LF, _CR):
                self.faulty = True  # the piece before ended with a closing mark
            self._before = int(signs[-1])
        outside = (np.searchsorted(quotes, ends) + self.inside) % 2 == 0
        self.inside = bool((len(quotes) + self.inside) % 2)
        return ends[outside] + 1


def _ends_cell_by_cell(data: bytes) -> int:
    """The position behind the last whole record; 0 if there is none."""
    at = 0
    while found := _RECORD.match(data, at):
        at = found.end()
    return at


def record_blocks(stream: BinaryIO, block_bytes: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The stream in blocks of whole records; a longer record is a block of its own."""
    held: list[bytes] = []
    scan, size, begun = QuoteScan(), block_bytes, False
    while piece := stream.read(size):
        if not begun:
            piece, begun = piece.removeprefix(BOM), True
        if not scan.faulty:
            ends = scan.take(piece)
        if scan.faulty:
            data = b"".join([*held, piece])
            end = _ends_cell_by_cell(data)
            if end:
                yield data[:end]
            held, size = [data[end:]], block_bytes if end else min(2 * size, 1 << 28)
        elif len(ends):
            yield b"".join([*held, piece[: ends[-1]]])
            held, size = [piece[ends[-1] :]], block_bytes
        else:
            held.append(piece)
    if rest := b"".join(held):
        yield rest


def _first_record(block: bytes) -> int:
    ends = QuoteScan().take(block)
    if len(ends):
        return int(ends[0])
    found = _RECORD.match(block)
    return found.end() if found else len(block)


def split_header(block: bytes) -> tuple[list[str], bytes]:
    """Column names, and the records behind them; no names for a block without text."""
    while block:
        end = _first_record(block)
        first, block = block[:end], block[end:]
        if not first.strip():
            continue
        try:
            names = next(csv.reader(io.StringIO(first.decode("utf-8").rstrip("\r\n"), newline=""), strict=True))
        except (UnicodeDecodeError, csv.Error) as e:
            raise HeaderError(f"the header can't be read: {e}") from e
        if twice := [n for n, times in Counter(names).items() if times > 1]:
            raise HeaderError(f"the header names {twice[0]!r} more than once")
        return names, block
    return [], b""


def read_header(stream: BinaryIO) -> list[str]:
    """Column names of a CSV stream; empty for a stream without text."""
    for block in record_blocks(stream, 1 << 16):
        names, _ = split_header(block)
        if names:
            return names
    return []


def _clean(cells: pa.Array) -> pa.Array:
    cells = pc.utf8_trim(cells, " \t")
    missing = pc.is_in(cells, value_set=pa.array(["", MISSING_TEXT]))
    return pc.if_else(missing, pa.scalar(None, pa.string()), cells)


def _parse(block: bytes, names: list[str], include: list[str] | None, notes: Counter) -> Iterator[pa.RecordBatch]:
    """Cells of whole records. Cells missing at a record's end are missing values."""
    short: list[str] = []

    def handle(row) -> str:
        if row.actual_columns < row.expected_columns:
            short.append(row.text)
            return "skip"
        return "error"

    table = pacsv.read_csv(
        pa.BufferReader(block),
        read_options=pacsv.ReadOptions(column_names=names, block_size=len(block) + 1, use_threads=False),
        parse_options=pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=handle),
        convert_options=pacsv.ConvertOptions(
            column_types={n: pa.string() for n in names}, include_columns=include, strings_can_be_null=False
        ),
    )
    wanted = table.column_names
    for batch in table.to_batches():
        yield batch
    if short:
        notes[SHORT_ROWS] += len(short)
        rows = [next(csv.reader(io.StringIO(text.rstrip("\r\n"), newline=""))) for text in short]
        places = [names.index(n) for n in wanted]
        cells = [pa.array([r[p] if p < len(r) else "" for r in rows], pa.string()) for p in places]
        yield pa.RecordBatch.from_arrays(cells, names=wanted)


def csv_batches(
    stream: BinaryIO,
    columns: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    names: list[str] | None = None,
    notes: Counter | None = None,
    ahead: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Batches of text columns: blanks trimmed, empty and ``NA`` cells missing.

    ``names`` are the columns of a stream that begins behind its header. Memory is bounded
    by the block and the longest record, not by the stream. A record with too few cells is
    filled up and counted in ``notes``; one with too many is an error. With ``ahead`` a
    thread reads the stream while blocks are parsed and used; two blocks wait at most.
    """
    notes = Counter() if notes is None else notes
    blocks = record_blocks(stream, block_bytes)
    with closing(made_ahead(blocks) if ahead else blocks) as blocks:
        for block in blocks:
            if names is None:
                found, block = split_header(block)
                if not found:
                    continue
                names = found
            if not block.strip():
                continue
            include = None if columns is None else [c for c in columns if c in names] or names[:1]
            for batch in _parse(block, names, include, notes):
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([_clean(c) for c in batch.columns], names=batch.schema.names)


def align(batch: pa.RecordBatch, columns: list[str]) -> list[pa.Array]:
    """The batch's cells for the given columns, absent ones missing."""
    names = batch.schema.names
    return [
        batch.column(names.index(c)) if c in names else pa.nulls(batch.num_rows, pa.string())
        for c in columns
    ]
