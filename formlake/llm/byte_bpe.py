"""Byte-level BPE in linear time: longest matches, taken back where neighbours don't fit.

Bytes are mapped to the Latin-1 character of the same number, so that one Aho-Corasick
automaton over the whole vocabulary yields every token that starts at a place. The encoder
takes the longest token whose boundary with the token before it is one that BPE merging
would keep, and steps back when no token fits. Boundaries are judged pair by pair and
remembered: a token list is the merge result exactly when each adjacent pair is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from formlake.llm.batches import id_and_text, text_slices
from formlake.llm.segments import BYTE_LEVEL, SegmentCache

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = 1_000_000):
        self.ranks, self.remembered = ranks, remembered
        self.pretokens = regex.compile(pattern)
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Textbook BPE: merge the adjacent parts of lowest rank, leftmost first, to the end."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 62))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps the boundary between these two tokens; remembered."""
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= self.remembered:
                self.fits.clear()
            known = self.merge(self.token_bytes[left] + self.token_bytes[right]) == [left, right]
            self.fits[key] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            starts[end + 1 - match[0]].append(match)  # shorter ones first, as ends ascend
        open_at = [True] * (size + 1)
        out: list[tuple[int, int]] = []
        tried: list[int] = []  # for each token taken, its place in the list of its start
        at, choice = 0, len(starts[0]) - 1
        while at < size:
            while choice >= 0:
                length, rank = starts[at][choice]
                if open_at[at + length] and (not out or self.compatible(out[-1][1], rank)):
                    break
                choice -= 1
            if choice >= 0:
                out.append(starts[at][choice])
                tried.append(choice)
                at += starts[at][choice][0]
                if at < size:
                    choice = len(starts[at]) - 1
            elif not out:
                raise ValueError("the vocabulary lacks a single byte")
            else:
                open_at[at] = False  # nothing that begins here fits, whatever led here
                length, _ = out.pop()
                at, choice = at - length, tried.pop() - 1
        return [rank for _, rank in out]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each match of the pattern by itself."""
        return [i for m in self.pretokens.findall(text) for i in self.encode_piece(m.encode("utf-8"))]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _cache(path: str, pattern: str) -> SegmentCache:
    bpe = encoder(path, pattern)

    def ids(segment: str) -> tuple[bytes, str]:
        found = bpe.encode(segment)
        return np.array(found, dtype="<u4").tobytes(), "".join(f"{i} " for i in found)

    return SegmentCache(ids, limit=300_000)


def encode_and_decode(
    docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) are digested per row into counts and hashes.

    One row per input row. A null or empty text has no ids and decodes to no bytes; a null
    id stays null; repeated rows give repeated rows; other columns are not read.
    """

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = encoder(ranks, pattern), _cache(ranks, pattern)
        for batch, texts in text_slices(batches):
            counts, id_hashes, byte_hashes = [], [], []
            for text in texts:
                parts = [cache[s] for s in BYTE_LEVEL.findall(text)]
                ids = np.frombuffer(b"".join([p[0] for p in parts]), dtype="<u4").tolist()
                counts.append(len(ids))
                id_hashes.append(hashlib.sha256("".join([p[1] for p in parts])[:-1].encode()).hexdigest())
                byte_hashes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(id_hashes, pa.string()),
                    "decoded_sha256": pa.array(byte_hashes, pa.string()),
                }
            )

    return id_and_text(docs, id_column, text_column).mapInArrow(digest, SCHEMA)


def encode_documents(
    docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and ids (array of int) of every row; empty for a null or empty text."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(ranks, pattern)
        for batch, texts in text_slices(batches):
            ids = [np.frombuffer(b"".join([cache[s][0] for s in BYTE_LEVEL.findall(t)]), dtype="<u4") for t in texts]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "ids": pa.array([i.astype("int32") for i in ids], pa.list_(pa.int32()))}
            )

    return id_and_text(docs, id_column, text_column).mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and decoded (binary) of every row of ``encode_documents``."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks, pattern)
        for batch in batches:
            decoded = [bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "decoded": pa.array(decoded, pa.binary())})

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, decoded binary")
