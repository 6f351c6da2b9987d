"""Repair of conversations by depth-first branch-and-bound over edits.

A conversation's turns, in order, become an optional system turn and pairs of a user and an
assistant turn. Spark finds each turn's faults and cuts conversations into segments. A first
pass runs backwards through the segments, and leaves what the rest costs from each state at
every segment's end. A second pass runs forwards with the texts, searches segment after
segment, and applies the edits as the texts go by. A task so holds one segment, however long
a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import named
from formlake.llm.written import written

SEGMENT_TURNS = 256
SEGMENT_BYTES = 4 << 20  # of text; one longer turn is a segment of its own
WINDOW = 16  # turns over which a lower bound follows the roles exactly

# The cost of an edit, and what an unfinished text adds unless its turn goes.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# A turn as one number: its role, and its faults as bits.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16

# What has been put out so far: nothing, or a turn of this role.
NOTHING, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)  # by an inserted or renamed turn
_ROLES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
_AT_END = (0, 2 * INSERT, INSERT, 0)  # inserts that complete a pair
_LEGAL = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def _kept_state(state: int, code: int) -> int | None:
    """The state after keeping a turn; None where that breaks the order."""
    role = code & 3
    if role == SYSTEM:
        return AFTER_SYSTEM if state == NOTHING else None
    if role == USER:
        return AFTER_USER if state != AFTER_USER else None
    return AFTER_ASSISTANT if role == ASSISTANT and state == AFTER_USER else None


def turn_edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """Edits of a turn in ASCII order: letter, state after it, cost."""
    edits = [("D", state, DELETE)]
    if not code & (BLANK | DUPLICATE):
        unfinished = UNFINISHED if code & TRUNCATED else 0
        kept = _kept_state(state, code)
        if kept is not None:
            edits.append(("K", kept, KEEP + unfinished))
        edits.append(("R", _NEXT[state], REROLE + unfinished))
    return edits


_EDITS = {(state, code): turn_edits(state, code) for state in range(4) for code in range(32)}


def costs_before(code: int, after: tuple[int, ...] | list[int]) -> list[int]:
    """Least cost to the end from each state before a turn, given those after it."""
    costs = [min(cost + after[then] for _, then, cost in _EDITS[state, code]) for state in range(4)]
    for _ in range(2):  # no more than two inserts help
        costs = [min(cost, INSERT + costs[_NEXT[state]]) for state, cost in enumerate(costs)]
    return costs


def suffix_bounds(codes: bytes, at_end: tuple[int, ...] | list[int]) -> list[list[int]]:
    """Lower bounds of the cost to the end, by turn and state.

    Within a window of turns the bound follows the roles; at a window's end any state may be
    the one to go on from.
    """
    bounds = [list(at_end)]
    for place in range(len(codes) - 1, -1, -1):
        after = bounds[-1]
        if (place + 1) % WINDOW == 0 and place + 1 < len(codes):
            after = [min(after)] * 4
        bounds.append(costs_before(codes[place], after))
    return bounds[::-1]


def best_edits(codes: bytes, state: int, at_end: tuple[int, ...] | list[int]) -> tuple[int, str]:
    """Least cost and, of the cheapest, the ASCII-least audit that takes a segment from ``state``.

    ``at_end`` is what the rest costs from each state. Inserts stand before the turn they
    precede; those behind the last turn are left to the next segment.
    """
    bounds = suffix_bounds(codes, at_end)
    turns = len(codes)
    reached: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(turns + 1)]
    best: tuple[int, str] | None = None
    stack = [(0, state, 0, "")]
    while stack:
        place, state, cost, audit = stack.pop()
        if best is not None:
            least = cost + bounds[place][state]
            if least > best[0] or (least == best[0] and audit > best[1][: len(audit)]):
                continue
        known = reached[place][state]
        if known is not None and known <= (cost, audit):
            continue  # a prefix at this node that nothing makes up for
        reached[place][state] = (cost, audit)
        if place == turns:
            found = (cost + at_end[state], audit)
            if best is None or found < best:
                best = found
            continue
        ways = [
            (cost + more + bounds[place + 1][then], letter, (place + 1, then, cost + more, audit + letter))
            for letter, then, more in _EDITS[state, codes[place]]
        ]
        then = _NEXT[state]
        ways.append((cost + INSERT + bounds[place][then], "I", (place, then, cost + INSERT, audit + "I")))
        ways.sort(reverse=True)  # the most promising is taken first, of equals the ASCII-least
        stack += [node for _, _, node in ways]
    return best


# --- faults of turns ---------------------------------------------------------------------


def _turns(conversations: DataFrame, columns: dict[str, str]) -> DataFrame:
    name = lambda key: named(columns.get(key, key))
    return conversations.select(
        name("conv_id").cast("bigint").alias("conv_id"),
        name("turn").cast("bigint").alias("turn"),
        F.coalesce(name("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(name("text").cast("string"), F.lit(" ")).alias("text"),
    )


def damaged(conversations: DataFrame, **columns: str) -> DataFrame:
    """Turns with faults made by the checksum of ``conv_id:turn``, modulo 20.

    0 drops a turn, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    turns = _turns(conversations, columns)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turns = turns.withColumn("fate", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20)
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.where("fate != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit(""))
        .when(F.col("fate") == 2, F.translate("text", "".join(ENDS), ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _code(role: Column, text: Column) -> Column:
    initial, body = F.substring(role, 1, 1), F.rtrim(text, F.lit(SPACE))
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    ended = F.substring(body, -1, 1).isin(*ENDS)
    return kind + F.when(body == "", BLANK).when(~ended, TRUNCATED).otherwise(0)


def _with_duplicates(turns: DataFrame) -> DataFrame:
    """conv_id, turn, tie, row_no, code and bytes, with the bit of turns seen earlier.

    The first of equal turns comes from an aggregation and meets the others in a join, which
    can be split, so that a turn repeated any number of times is no burden.
    """
    narrow = turns.select("conv_id", "turn", "tie", "row_no", "code", F.octet_length("text").alias("bytes"))
    first = narrow.groupBy("conv_id", "tie").agg(F.min(F.struct("turn", "row_no")).alias("first"))
    first = written(first, "first-turns").withColumnsRenamed({"conv_id": "first_conv", "tie": "first_tie"})
    met = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("tie") == F.col("first_tie")))
    again = (F.col("row_no") != F.col("first.row_no")) & (F.col("code").bitwiseAND(BLANK) == 0)
    # Its first fault counts: what is a duplicate is not counted as truncated.
    code = F.when(again, F.col("code").bitwiseAND(3) + DUPLICATE).otherwise(F.col("code")).cast("int")
    return met.select("conv_id", "turn", "tie", "row_no", code.alias("code"), "bytes")


# --- the two passes ----------------------------------------------------------------------

_SEGMENT = "conv_id bigint, turn bigint, tie binary, row_no bigint, codes binary, at_end array<bigint>, last boolean"


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _segments(batches: Iterable[pa.RecordBatch], turns_most: int, bytes_most: int) -> Iterator[tuple]:
    """Segments of conversations whose turns come backwards."""
    codes, held, key, at_end, last = bytearray(), 0, None, _AT_END, True

    def segment() -> tuple:
        return (*key, bytes(reversed(codes)), list(at_end), last)

    for conv_id, turn, tie, row_no, code, size in _rows(batches):
        if codes:
            other = conv_id != key[0]
            if other or len(codes) >= turns_most or held + size > bytes_most:
                yield segment()
                if other:
                    at_end, last = _AT_END, True
                else:
                    for c in codes:
                        at_end = costs_before(c, at_end)
                    last = False
                codes, held = bytearray(), 0
        codes.append(code)
        held += size
        key = (conv_id, turn, tie, row_no)
    if codes:
        yield segment()


def _cut(turns_most: int, bytes_most: int) -> Callable:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.bool_())
    names = ["conv_id", "turn", "tie", "row_no", "codes", "at_end", "last"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in _segments(batches, turns_most, bytes_most):
            rows.append(row)
            if len(rows) >= 2000:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)

    return cut


@dataclass
class Conversation:
    """What is known of a conversation while its turns go by."""

    conv_id: int | None
    least_turn: int | None = None
    most_turn: int | None = None
    distinct_turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    edits: list[str] = field(default_factory=list)
    put_out: int = 0
    state: int = NOTHING
    before: int | None = None  # role of the turn before
    last_turn: int | None = None

    def see(self, turn: int | None, code: int) -> None:
        """Turns come in order, nulls first."""
        if turn is not None:
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.distinct_turns += turn != self.last_turn
            self.most_turn = self.last_turn = turn
        self.blank += bool(code & BLANK)
        self.duplicate += bool(code & DUPLICATE)
        self.truncated += bool(code & TRUNCATED)
        if self.before is not None:
            self.illegal += (self.before, code & 3) not in _LEGAL
        self.before = code & 3

    @property
    def gaps(self) -> int:
        return 0 if self.least_turn is None else self.most_turn - self.least_turn + 1 - self.distinct_turns


Edited = tuple[Conversation, str, int | None, str | None, str | None]


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[Edited]:
    """(conversation, edit, turn, role, text) in order; an edit "" closes the conversation.

    Rows are turns and, before the first turn of each segment, the segment.
    """
    now: Conversation | None = None
    codes, audit, place, at, ending = b"", "", 0, 0, False

    def insert() -> Edited:
        now.state = _NEXT[now.state]
        return now, "I", None, _ROLES[now.state], ""

    for conv_id, turn, role, text, segment, at_end, last in _rows(batches):
        if segment is not None:
            first = now is None
            now = Conversation(conv_id) if first else now
            codes, ending, place, at = segment, last, 0, 0
            cost, audit = best_edits(codes, now.state, at_end)
            now.cost = cost if first else now.cost  # with all that comes after
            continue
        while audit[at] == "I":
            at += 1
            yield insert()
        code, edit = codes[place], audit[at]
        place, at = place + 1, at + 1
        now.see(turn, code)
        if edit == "K":
            now.state = _kept_state(now.state, code)
            yield now, "K", turn, role, text
        elif edit == "R":
            now.state = _NEXT[now.state]
            yield now, "R", turn, _ROLES[now.state], text
        else:
            yield now, "D", turn, role, text
        if ending and place == len(codes):
            while _AT_END[now.state]:
                yield insert()
            yield now, "", None, None, None
            now = None


_TURNS = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"
_REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


def _write_turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0

    def table() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
        names = ["conv_id", "place", "edit", "turn", "role", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for talk, edit, turn, role, text in _edited(batches):
        if edit in ("", "D"):
            continue
        rows.append((talk.conv_id, talk.put_out, edit, turn, role, text))
        talk.put_out += 1
        held += len(text)
        if held > SEGMENT_BYTES or len(rows) >= 10_000:
            yield table()
            rows, held = [], 0
    if rows:
        yield table()


def _report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _REPORT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    rows: list[tuple] = []

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    digest = hashlib.sha256()
    for talk, edit, _, role, text in _edited(batches):
        if edit:
            talk.edits.append(edit)
            if edit != "D":
                digest.update(f"{chr(10) if talk.put_out else ''}{role}:{text}".encode())
                talk.put_out += 1
            continue
        counts = (talk.gaps, talk.blank, talk.duplicate, talk.truncated, talk.illegal, talk.cost)
        rows.append((talk.conv_id, *counts, "".join(talk.edits), digest.hexdigest()))
        digest = hashlib.sha256()
        if len(rows) >= 2000:
            yield table()
            rows = []
    if rows:
        yield table()


@dataclass
class Repair:
    """The repaired conversations, and what was wrong with them."""

    _stream: DataFrame

    def turns(self) -> DataFrame:
        """conv_id, place (from 0), edit (K, R or I), turn, role and text of every repaired turn."""
        return self._stream.mapInArrow(_write_turns, _TURNS)

    def report(self) -> DataFrame:
        """A row for each conversation: faults, cost, audit and a digest of the repaired turns."""
        return self._stream.mapInArrow(_report, _REPORT)


def repair_conversations(
    conversations: DataFrame,
    segment_turns: int = SEGMENT_TURNS,
    segment_bytes: int = SEGMENT_BYTES,
    **columns: str,
) -> Repair:
    """Cheapest repair of each conversation to role initials ``(s?(ua)+)?``.

    Null roles and texts are one space; turns come in the order of ``turn``, nulls first, ties
    in the order of a hash of role and text, so that the order doesn't depend on files. Turns
    without an id are one conversation. A role without a first character can't be kept.
    Repeated rows are duplicate turns; other columns are not read; an empty table gives an
    empty result. A conversation passes through one task, as its digest demands, a segment at
    a time: the audit is the only thing that is held in full.
    """
    turns = _turns(conversations, columns).withColumn("code", _code(F.col("role"), F.col("text")).cast("int"))
    same = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    turns = turns.withColumn("tie", F.unhex(F.sha2(same.cast("binary"), 256)))
    turns = written(turns.withColumn("row_no", F.monotonically_increasing_id()), "turns")
    backwards = [F.desc_nulls_last(c) for c in ("conv_id", "turn", "tie", "row_no")]
    segments = written(
        _with_duplicates(turns)
        .repartition("conv_id")
        .sortWithinPartitions(*backwards)
        .mapInArrow(_cut(segment_turns, segment_bytes), _SEGMENT),
        "segments",
    )
    order = ["conv_id", "turn", "tie", "row_no", "is_turn"]
    said = turns.drop("code").withColumn("is_turn", F.lit(True))
    stream = said.unionByName(segments.withColumn("is_turn", F.lit(False)), allowMissingColumns=True)
    stream = stream.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in order])
    return Repair(stream.select("conv_id", "turn", "role", "text", "codes", "at_end", "last"))


def report_damage(conversations: DataFrame, **columns: str) -> DataFrame:
    """The report on damaged conversations, with zeros for those that lost every turn."""
    report = repair_conversations(damaged(conversations, **columns)).report()
    known = _turns(conversations, columns).select(F.col("conv_id").alias("known_id")).distinct()
    joined = known.join(report, F.col("known_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        F.col("known_id").alias("conv_id"),
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
