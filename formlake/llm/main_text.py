"""The main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block element. A line weighs as much as it has
characters, or nothing where it is page furniture (menus, adverts, forms and the like, by
element, role or class) or mostly links. Weights are summed over a sliding window of
lines; the article begins where the sum surges and ends where it dives to nothing. Further
lines of the element that holds it belong to it too. Lines of a marked article weigh double.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import named, text_slices

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

WINDOW = 3  # lines
SURGE = 80  # characters in a window that begin a region
REGION_SHARE = 0.25  # of the largest region, for a further one to count

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")

_RAW = frozenset("script style textarea title noscript template svg math iframe object select".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav footer aside form button dialog menu fieldset head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer comment comments disqus respond share sharing social related recommended newsletter "
    "subscribe subscription widget login signin signup search pagination pager toolbar copyright legal "
    "masthead header topbar skip".split()
)
_LANDMARKS = frozenset(("article", "main"))


_PAGE = frozenset(("html", "body"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class _Line:
    __slots__ = ("parts", "links", "furniture", "path")

    def __init__(self, furniture: bool, path: tuple[_Block, ...]):
        self.parts: list[str] = []
        self.links = 0
        self.furniture, self.path = furniture, path


class _Block:
    """An open element."""

    __slots__ = ("tag", "own", "named", "names", "held", "title")

    def __init__(self, tag: str, own: bool, named: bool, names: str):
        self.tag, self.own, self.named, self.names = tag, own, named, names  # furniture; furniture by its names alone
        self.held, self.title = 0, False  # characters outside links and other furniture; whether it has the title


def _is_furniture(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, str]:
    """Whether an element is furniture, whether by its names alone, and the names."""
    if tag in _FURNITURE:
        return True, tag == "form", ""
    if tag == "header" and not in_article:
        return True, False, ""
    if not attributes or tag in ("html", "body", "main"):
        return False, False, ""
    named, names = False, ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False, ""
        if name == "role" and value in _ROLES:
            return True, False, ""
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True, False, ""
        if name in ("class", "id"):
            if name == "class":
                names = value
            words = set(_WORD.findall(value))
            if tag == "article":  # comments are often articles of their own
                words &= {"comment", "comments", "ad", "advert", "sponsored", "related"}
            if in_article:  # an article may have a header of its own
                words.discard("header")
            named = named or bool(words & _NAMES)
    return named, named, names


def _lines(html: str, spared: frozenset[int] | None = frozenset()) -> tuple[list[_Line], dict[int, _Block], int]:
    """Text by block element, in page order; the elements named like furniture by number; what the page holds.

    ``spared`` are the numbers of such elements that are none; None spares all of them.
    """
    lines = [_Line(False, ())]
    open_tags: list[_Block] = []
    by_name: dict[int, _Block] = {}
    furniture = landmark = certain = 0  # open elements of either kind; furniture not by names alone
    elements = links = held = 0
    at = 0

    def text(piece: str) -> None:
        nonlocal held
        line = lines[-1]
        if not certain and not links:
            length = len(piece.strip())
            held += length
            if by_name:
                for block in open_tags:
                    block.held += length
        if furniture and not line.furniture:  # inside an inline element that is furniture
            return
        line.parts.append(piece)
        if links:
            line.links += len(piece)

    def opened(tag: str, attributes: str) -> None:
        nonlocal furniture, landmark, certain, elements
        elements += 1
        own, named, names = _is_furniture(tag, attributes, landmark > 0)
        block = _Block(tag, own, named, names)
        if named:
            by_name[elements] = block
            block.own = spared is not None and elements not in spared
        if tag in ("h1", "main"):
            for outer in open_tags:
                outer.title = True
        open_tags.append(block)
        furniture += block.own
        certain += own and not named
        landmark += tag in _LANDMARKS

    def shut(first: int, last: int | None = None) -> None:
        nonlocal furniture, landmark, certain
        for block in open_tags[first:last]:
            furniture -= block.own
            certain -= block.own and not block.named
            landmark -= block.tag in _LANDMARKS
        del open_tags[first:last]

    def innermost(tag: str) -> int:
        for depth in range(len(open_tags) - 1, -1, -1):
            if open_tags[depth].tag == tag:
                return depth
        return -1

    def new_line() -> None:
        path = tuple(block for block in open_tags if block.tag not in _INLINE)
        if lines[-1].parts:
            lines.append(_Line(furniture > 0, path))
        else:
            lines[-1].furniture, lines[-1].path = furniture > 0, path

    while True:
        found = _TAG.search(html, at)
        if not found:
            break
        if found.start() > at:
            text(html[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        closing, tag = found[1], found[2].lower()
        if tag in _RAW:
            if not closing and not found[3].endswith("/"):
                end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                if end is None:
                    at = len(html)
                    break
                close = html.find(">", end.end())
                at = len(html) if close < 0 else close + 1
            continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
            if tag in _VOID:
                text(" ")
                continue
            if closing or tag == "a":  # a link ends the one before it
                depth = innermost(tag)
                if depth >= 0:
                    shut(depth, depth + 1)
                    if lines[-1].furniture and not furniture:
                        new_line()
            if not closing and not found[3].endswith("/"):
                opened(tag, found[3])
            continue
        if closing:
            depth = innermost(tag)
            if depth >= 0:
                shut(depth)
            new_line()
            continue
        if tag == "p":  # a paragraph ends the one before it
            depth = len(open_tags)
            while depth and open_tags[depth - 1].tag in _INLINE:
                depth -= 1
            while depth and open_tags[depth - 1].tag == "p":
                depth -= 1
                shut(depth)
        if tag not in _VOID and not found[3].endswith("/"):
            opened(tag, found[3])
        new_line()
    if at < len(html):
        text(html[at:])
    return lines, by_name, held


def _texts(lines: list[_Line]) -> list[tuple[str, _Line]]:
    texts = ((" ".join(unescape("".join(line.parts)).split()), line) for line in lines)
    return [(text, line) for text, line in texts if text]


def _weights(kept: list[tuple[str, _Line]]) -> np.ndarray:
    landmarks = [next((block for block in line.path if block.tag in _LANDMARKS), None) for _, line in kept]
    weights = np.array(
        [
            0 if line.furniture or line.links * 2 > len(text) or text[0] == "©" and not mark else len(text)
            for (text, line), mark in zip(kept, landmarks)
        ],
        dtype=np.int64,
    )
    marked = np.array([mark is not None for mark in landmarks], bool)
    articles = np.array([mark is not None and mark.tag == "article" for mark in landmarks], bool)
    several = len({id(mark) for (_, line), mark in zip(kept, landmarks) if mark and not line.furniture}) > 1
    if several and weights[~marked].sum() > weights[marked].sum():
        weights[marked] = 0  # cards beside the text
    else:
        weights[marked] *= 2
        weights[articles & np.array([not line.furniture for _, line in kept], bool)] += 1  # its links count too
    return weights


def _sums(weights: np.ndarray) -> np.ndarray:
    """Of each line and those after it."""
    return np.convolve(weights, np.ones(WINDOW, np.int64))[WINDOW - 1 :]


def _common(paths: list[tuple[_Block, ...]]) -> tuple[_Block, ...]:
    first, last = paths[0], min(map(len, paths))
    depth = 0
    while depth < last and all(path[depth] is first[depth] for path in paths):
        depth += 1
    return first[:depth]


def main_text(html: str) -> str:
    """The article's blocks, joined by line breaks; empty if there is none."""
    lines, by_name, held = _lines(html)
    kept = _texts(lines)
    weights = _weights(kept) if kept else np.zeros(0, np.int64)
    if by_name:
        # An element that holds most of the text is no furniture, whatever its names, if it has the
        # title or nothing outside reads like an article.
        surges = weights.any() and _sums(weights).max() >= SURGE
        spared = frozenset(
            n
            for n, block in by_name.items()
            if block.held >= SURGE and 2 * block.held > held and (block.title or not surges)
        )
        if spared:
            kept = _texts(_lines(html, spared)[0])
            weights = _weights(kept)
        if not weights.any():
            kept = _texts(_lines(html, None)[0])
            weights = _weights(kept) if kept else weights
    if not weights.any():
        return ""
    sums = _sums(weights)
    regions, start = [], None
    for i, (total, weight) in enumerate(zip(sums.tolist(), weights.tolist())):
        if start is None and total >= SURGE and weight:
            start = i
        elif start is not None and total == 0:  # dived
            regions.append((start, i))
            start = None
    if start is not None:
        regions.append((start, len(kept)))
    if not regions:
        regions = [(0, len(kept))]
    sizes = [int(weights[a:b].sum()) for a, b in regions]
    first, last = regions[sizes.index(max(sizes))]
    heavy = [i for i in range(first, last) if weights[i]]
    paths = [line.path for _, line in kept]
    home = _common([paths[i][:-1] for i in heavy])
    for i in heavy:  # a marked article that holds most of the region
        for depth, block in enumerate(paths[i], 1):
            if block.tag == "article" and depth > len(home):
                inside = [j for j in heavy if len(paths[j]) >= depth and paths[j][depth - 1] is block]
                if 2 * weights[inside].sum() > weights[heavy].sum():
                    home = paths[i][:depth]
                break
        if any(block.tag == "article" for block in home):
            break
    marked = any(block.tag == "article" for block in home)
    chosen = np.zeros(len(kept), bool)
    for (a, b), size in zip(regions, sizes):
        if not marked and size >= REGION_SHARE * max(sizes) or (a, b) == (first, last):
            chosen[a:b] = True
    on_page = not home or home[-1].tag in _PAGE
    kinds = {paths[i][-1].tag for i in heavy if paths[i]} | _HEADINGS
    for i, path in enumerate(paths):
        if not weights[i]:
            continue
        if on_page:  # what else is in the page as a whole may be anything
            chosen[i] |= len(path) == len(home) + 1 and path[: len(home)] == home and path[-1].tag in kinds
        elif path[: len(home)] == home:
            chosen[i] = True
        elif marked:
            chosen[i] = False
        elif len(path) >= len(home) > 1 and path[: len(home) - 1] == home[:-1]:
            one, other = home[-1], path[len(home) - 1]  # a section like the one that holds the region
            telling = one.tag != "div" or one.names or home[-2].tag not in _PAGE | {"main"}
            chosen[i] |= bool(telling) and (one.tag, one.names) == (other.tag, other.names)
    # Lines without weight belong to the article between others of it.
    inner = np.flatnonzero(chosen & (weights > 0))
    last = int(inner[-1]) + 1
    return "\n".join(
        text
        for i, (text, line) in enumerate(kept[:last])
        if chosen[i] and i >= inner[0] and not line.furniture and (not marked or line.path[: len(home)] == home)
    )


def extract_main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page has an empty text. Null ids and urls stay null, repeated rows
    give repeated rows, other columns are not read, and an empty table gives no rows.
    """

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in text_slices(batches, column="html"):
            texts = [main_text(page) for page in pages]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column(0),
                    "url": batch.column(1),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    rows = pages.select(
        named(id_column).cast("bigint").alias("page_id"),
        named(url_column).cast("string").alias("url"),
        F.coalesce(named(html_column), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(extract, SCHEMA)
