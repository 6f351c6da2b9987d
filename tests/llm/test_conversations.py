"""Conversation repair against SQL and against trying every edit."""

import hashlib
import itertools
import random
import re

import pytest
from compare import connect, mismatch

from formlake.llm.conversation_repair import (
    _AT_END,
    _NEXT,
    BLANK,
    DUPLICATE,
    TRUNCATED,
    best_edits,
    costs_before,
    damaged,
    repair_conversations,
    report_damage,
    turn_edits,
)
from formlake.llm.queries import ORACLES, QUERIES

KIND = "conv_id bigint, turn bigint, role string, text string, code int, tie string, edit string, `a.b` int"


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_equals_sql(spark, size):
    folder = f"/root/testdata/{size}"
    assert mismatch(QUERIES["op12_conversation_repair"](spark, folder), connect(folder), ORACLES["op12_conversation_repair"]) is None


LEGAL = re.compile("(s?(ua)+)?")


def every_repair(codes):
    """The least (cost, audit) among all edits with at most three inserts in a row."""
    best = None
    options = []
    for code in codes:
        ways = [("D", "", 3)]
        if not code & (BLANK | DUPLICATE):
            late = 1 if code & TRUNCATED else 0
            ways += [("K", "sua?"[code & 3], late), ("R", "u", 2 + late), ("R", "a", 2 + late)]
        options.append(ways)
    inserts = [("", 0)] + [("".join(w), 2 * n) for n in (1, 2) for w in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*options):
        for gaps in itertools.product(inserts, repeat=len(codes) + 1):
            roles = audit = ""
            cost = 0
            for (put, price), step in zip(gaps, (*chosen, ("", "", 0))):
                roles, audit, cost = roles + put + step[1], audit + "I" * len(put) + step[0], cost + price + step[2]
            if LEGAL.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def repaired(codes):
    state_cost, audit = best_edits(bytes(codes), 0, _AT_END)
    return state_cost, audit


@pytest.mark.parametrize("turns", [1, 2, 3])
def test_search_equals_trying_everything(turns):
    kinds = [0, 1, 2, 3, 1 + TRUNCATED, 2 + TRUNCATED, 1 + BLANK, 3 + TRUNCATED]
    pick = random.Random(turns)
    for _ in range(25 if turns == 3 else 60):
        codes = [pick.choice(kinds) for _ in range(turns)]
        cost, audit = repaired(codes)
        wanted = every_repair(codes)
        # Inserts behind the last turn are put there by the caller.
        assert cost == wanted[0] and wanted[1].rstrip("I") == audit.rstrip("I"), codes


def table(codes):
    """Least (cost, audit) by state, turn after turn."""
    edits = {0: (0, "")}

    def inserted(known):
        known = dict(known)
        for _ in range(3):
            for state, (cost, audit) in list(known.items()):
                then = {0: 2, 1: 2, 2: 3, 3: 2}[state]
                known[then] = min(known.get(then, (cost + 2, audit + "I")), (cost + 2, audit + "I"))
        return known

    for code in codes:
        after = {}
        for state, (cost, audit) in inserted(edits).items():
            ways = [("D", state, 3)]
            if not code & (BLANK | DUPLICATE):
                late = 1 if code & TRUNCATED else 0
                role = code & 3
                if (role == 0 and state == 0) or (role == 1 and state != 2) or (role == 2 and state == 2):
                    ways.append(("K", role + 1, late))
                ways.append(("R", 3 if state == 2 else 2, 2 + late))
            for letter, then, more in ways:
                found = (cost + more, audit + letter)
                after[then] = min(after.get(then, found), found)
        edits = after
    edits = inserted(edits)
    return min(edits[s] for s in (0, 3) if s in edits)


@pytest.mark.parametrize("segment", [1, 7, 256])
def test_segments_make_no_difference(spark, segment):
    pick = random.Random(4)
    rows, wanted = [], {}
    for conv in range(40):
        turns = pick.choice([1, 2, 5, 30, 120])
        codes = []
        for turn in range(turns):
            role = pick.choice(["system", "user", "assistant", "user", "assistant", "tool"])
            text = pick.choice([f"All {conv} {turn} said.", f"Not all {turn}", " \t"])
            rows.append((conv, turn, role, text, 0, "", "", 0))
            kind = {"s": 0, "u": 1, "a": 2, "t": 3}[role[0]]
            codes.append(kind + (BLANK if not text.strip() else 0 if text.endswith(".") else TRUNCATED))
        wanted[conv] = table(codes)
    got = repair_conversations(spark.createDataFrame(rows, KIND), segment_turns=segment)
    report = {r["conv_id"]: r for r in got.report().collect()}
    assert {c: (r["cost"], r["audit"]) for c, r in report.items()} == wanted
    said = {}
    for r in got.turns().orderBy("conv_id", "place").collect():
        said.setdefault(r["conv_id"], []).append(r)
    for conv, r in report.items():
        turns = said.get(conv, [])
        assert [t["place"] for t in turns] == list(range(len(turns)))
        assert LEGAL.fullmatch("".join(t["role"][0] for t in turns))
        text = "\n".join(f"{t['role']}:{t['text']}" for t in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]
        assert [t["edit"] for t in turns] == [e for e in r["audit"] if e != "D"]


def test_a_long_conversation_in_segments():
    pick = random.Random(1)
    codes = bytes(pick.choice([0, 1, 2, 1, 2, 3, 5, 17, 18]) for _ in range(20_000))
    at_end = {len(codes): list(_AT_END)}
    for place in range(len(codes) - 1, -1, -1):
        at_end[place] = costs_before(codes[place], at_end[place + 1])
    state, audit, total = 0, "", None
    for first in range(0, len(codes), 256):
        part = codes[first : first + 256]
        cost, edits = best_edits(part, state, at_end[first + len(part)])
        total, audit = total or cost, audit + edits
        turn = iter(part)
        for letter in edits:
            if letter == "I":
                state = _NEXT[state]
            else:
                state = next(s for e, s, _ in turn_edits(state, next(turn)) if e == letter)
    ending = {0: "", 1: "II", 2: "I", 3: ""}[state]
    assert (total, audit + ending) == table(codes)


def test_odd_rows(spark):
    long = "word " * 200_000
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."),
        (2, None, None, None), (2, None, "user", "Null turn."), (2, 5, "assistant", ""),
        (3, 0, "", "No role."), (3, 1, "user", long), (3, 2, "assistant", long + "!"),
        (None, 0, "user", "No id."), (None, 4, "assistant", "None."), (4, None, "system", None),
        (5, 9, "user", "Ending. "), (5, 12, "uncle", "Ending! \n"), (5, 2, "system", "s."),
    ]
    rows = [(*r, 1, "t", "e", 2) for r in rows]
    got = {r["conv_id"]: r for r in repair_conversations(spark.createDataFrame(rows, KIND)).report().collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    assert (got[1]["duplicate"], got[1]["cost"], got[1]["audit"]) == (1, 3, "KKD")
    assert (got[2]["blank"], got[2]["gaps"]) == (2, 0)
    assert (got[3]["truncated"], got[3]["audit"]) == (1, "DKK")
    assert (got[None]["gaps"], got[None]["cost"]) == (3, 0)
    assert (got[4]["blank"], got[4]["audit"], got[4]["repaired_sha256"]) == (1, "D", hashlib.sha256().hexdigest())
    assert (got[5]["gaps"], got[5]["truncated"], got[5]["illegal"]) == (8, 1, 1)


def test_null_and_odd_rows_equal_sql(spark, folder):
    rows = [(c, t, r, x, 0, "", "", 0) for c, t, r, x in [
        (None, None, None, None), (None, 1, "user", "a."), (7, None, "system", "x"), (7, 3, "user", "b c"),
        (7, 4, "assistant", "b c."), (8, 1, None, "z."), (8, 2, "user", None), (9, 0, "assistant", "?"),
    ]]
    spark.createDataFrame(rows, KIND).write.parquet(f"{folder}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    table_ = spark.read.parquet(f"{folder}/conversations.parquet")
    assert mismatch(report_damage(table_), con, ORACLES["op12_conversation_repair"]) is None


def test_empty_table(spark):
    none = spark.createDataFrame([], KIND)
    assert report_damage(none).count() == 0 and damaged(none).count() == 0
    assert repair_conversations(none).turns().count() == 0
