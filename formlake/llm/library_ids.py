"""Ids by the tokenizers library, one segment at a time through a bounded cache."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

from formlake.llm.segments import BYTE_LEVEL, LETTERS, WORD_END, SegmentCache
from formlake.llm.workers import holds


def _byte_characters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as a visible character: itself, or one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


class LibraryIds:
    """Ids of texts as little-endian unsigned integers of type ``kind``; none are put around a text.

    A segment of letters is one pre-token, so the library's model gets it directly; others
    go through the whole library. With ``added``, strings of added tokens in a text get their
    tokens' ids, as is the library's default; the text between them is cut into segments.
    """

    def __init__(self, path: str, segments: re.Pattern[str], lower: bool, remembered: int, added: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # no segment holds one, or it is ordinary text
        tokens = list(self.library.get_added_tokens_decoder().items()) if added else []
        self.added = {t.content: number for number, t in tokens}
        # Tokens that take white space along, or match the normalized text, are left to the library.
        simple = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for _, t in tokens)
        self.default = None if simple else Tokenizer.from_file(path)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(map(re.escape, longest_first))})").split
        self.model = self.library.model
        self.lower, self.characters = lower, _byte_characters()
        self.space = chr(self.characters[ord(" ")])
        self.word = re.compile(f" ?[{LETTERS}]+" if not lower else f"[{LETTERS}]+").fullmatch
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.findall = segments.findall
        self.ids_of = SegmentCache(self._segment_ids, limit=remembered).__getitem__

    def _segment_ids(self, segment: str) -> bytes:
        if self.word(segment):
            word = segment.lower() if self.lower else segment
            if word.isascii():
                visible = word.replace(" ", self.space)
            else:
                visible = word.encode("utf-8").decode("latin-1").translate(self.characters)
            return array(self.code, [token.id for token in self.model.tokenize(visible)]).tobytes()
        return array(self.code, self.library.encode(segment, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.default is not None:
            return array(self.code, self.default.encode(text, add_special_tokens=False).ids).tobytes()
        if not any(content in text for content in self.added):
            return b"".join(map(self.ids_of, self.findall(text)))
        return b"".join(
            array(self.code, [self.added[part]]).tobytes() if place % 2 else b"".join(map(self.ids_of, self.findall(part)))
            for place, part in enumerate(self.split(text))
        )


@lru_cache(maxsize=2)
def byte_level_ids(path: str, added: bool = False) -> LibraryIds:
    return LibraryIds(path, BYTE_LEVEL, lower=False, remembered=800_000, added=added)


@lru_cache(maxsize=2)
def word_end_ids(path: str, added: bool = False) -> LibraryIds:
    return LibraryIds(path, WORD_END, lower=True, remembered=300_000, added=added)


holds("token_files", byte_level_ids.cache_clear)
holds("packing", word_end_ids.cache_clear)
