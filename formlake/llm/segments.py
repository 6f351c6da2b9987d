"""Cutting texts where no tokenizer merge can cross, and a bounded cache of segment encodings.

A segment always ends where the tokenizer itself would end a pre-token, whatever follows,
so a text's encoding is its segments' encodings one after the other. Natural text repeats
its segments, so almost all of them come from the cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NO_LETTER = "(?=[\0-@\\[-`{-\x7f]|\\Z)"  # ASCII alone is looked up fastest
# An apostrophe may begin a pre-token of its own, so symbols next to one are left whole.
_SYMBOLS = "[!-&(-/:-@\\[-`{-~]+(?=[\t-\r 0-9A-Za-z]|\\Z)"

#: Byte-level pre-tokens take one space before a word; runs of white space leave it theirs.
BYTE_LEVEL = re.compile(
    f" ?[{LETTERS}]+{_NO_LETTER}|{_SYMBOLS}| ?[^{WHITE_SPACE}]+"
    f"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
#: Word-end vocabularies drop white space.
WORD_END = re.compile(f"[{LETTERS}]+{_NO_LETTER}|{_SYMBOLS}|[^{WHITE_SPACE}]+")
#: Piece vocabularies have the space mark only at the front of a piece; the mark itself
#: (U+2581) in a text counts like a space.
SPACE_LED = re.compile("[ ▁]+[^ ▁]*")


class SegmentCache(dict):
    """segment -> value, computed on first use.

    Beyond ``limit`` entries the later half goes: the earliest entries are those that
    turned up first, which are the frequent ones. Long segments are never kept.
    """

    def __init__(self, compute: Callable[[str], object], limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, segment: str):
        value = self.compute(segment)
        if len(segment) <= self.longest:
            if len(self) >= self.limit:
                kept = list(islice(self.items(), self.limit // 2))
                self.clear()
                self.update(kept)
            self[segment] = value
        return value
