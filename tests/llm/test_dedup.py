"""Exact and near duplicates against SQL and brute force."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import connect, mismatch
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import ROWS, none, odd
from pyspark.sql import functions as F

from formlake.llm import golomb
from formlake.llm.components import connected
from formlake.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, suspects_by_part
from formlake.llm.queries import ORACLES, QUERIES
from formlake.llm.simhash import (
    Forest,
    build_tree,
    drop_near_duplicates,
    fingerprint,
    links,
    search,
    simhash_components,
    visits,
)

FOLDER = "/root/testdata/sf0.001"


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 2**40), min_size=1, max_size=300))
def test_golomb_round_trip(values):
    ordered = np.array(sorted(values), np.uint64)
    assert golomb.decode(len(ordered), *golomb.encode(ordered)).tolist() == ordered.tolist()


def test_exact_duplicates_equal_sql(spark):
    assert mismatch(QUERIES["op1_exact_dedup"](spark, FOLDER), connect(FOLDER), ORACLES["op1_exact_dedup"]) is None


def test_exact_duplicates_of_odd_rows(spark):
    got = exact_duplicates(odd(spark).repartition(3), "doc_id", "text").collect()
    bodies = [re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in ROWS]
    sizes = Counter(bodies)
    assert sorted(r["group_size"] for r in got) == sorted(sizes[b] for b in bodies)
    assert sum(r["kept"] for r in got) == len(sizes)
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["keep_id"] for i in (1, 2, 3)} == {2} and by_id[2]["kept"]
    assert by_id[4]["keep_id"] == 6 and by_id[4]["group_size"] == 4  # null and empty are one text; " \n\t" is longest
    kept = drop_exact_duplicates(odd(spark).repartition(3))
    assert kept.columns == odd(spark).columns and kept.count() == len(sizes)
    assert drop_exact_duplicates(none(spark)).count() == 0


def test_repeated_rows_leave_one(spark):
    rows = spark.createDataFrame([(1, "same text"), (1, "same text"), (1, "other")] * 40, "doc_id bigint, text string")
    got = exact_duplicates(rows.repartition(5)).collect()
    assert Counter((r["group_size"], r["kept"]) for r in got) == {(80, True): 1, (80, False): 79, (40, True): 1, (40, False): 39}


def test_only_suspects_are_marked(spark):
    thin = spark.range(4000).select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row_no"),
        F.xxhash64(F.when(F.col("id") >= 3990, F.lit(5)).otherwise(F.col("id"))).alias("fingerprint"),
    )
    words = suspects_by_part(thin, 4000).collect()
    marked = sum(bin(w & (2**64 - 1)).count("1") for r in words for w in r["words"])
    assert 11 <= marked <= 11 + 20  # a few more by chance


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, reach):
    """Root place of each row by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= reach:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprint():
    for text in ("", " \n", "one", "One two", "a b c d", "A b C d e f g h, i j", "é É x\x85y z w v", "a " * 50):
        assert fingerprint(text.encode()) & (2**64 - 1) == brute_print(text)


def test_components_of_all_documents(spark):
    rows = sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints, 4)
    got = {r["doc_id"]: r for r in QUERIES["op9_simhash"](spark, FOLDER).collect()}
    assert [got[i]["fingerprint"] for i, _ in rows] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i, _ in rows] == [rows[r][0] for r in roots]


@pytest.mark.parametrize("spread", [3, 12])
def test_shards_lose_no_link(spark, spread):
    pick = np.random.default_rng(spread)
    centres = pick.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [sum(1 << b for b in {*pick.integers(0, 64, pick.integers(0, spread)).tolist()}) for _ in range(900)]
    prints = sorted({int(centres[i % 40]) ^ f for i, f in enumerate(flips)} | {0, 2**64 - 1, 2**63})
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = connected(links(spark.createDataFrame([(p,) for p in signed], "fingerprint bigint"), 4)).collect()
    root = {r["node"]: r["root"] for r in found}
    groups, wanted = {}, {}
    for place, (p, r) in enumerate(zip(signed, brute_components(prints, 4))):
        groups.setdefault(root.get(p, p), set()).add(place)
        wanted.setdefault(r, set()).add(place)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_every_pair_meets_at_one_home():
    pick = np.random.default_rng(5)
    prints = pick.integers(0, 2**64, 3000, dtype=np.uint64)
    prints[1500:] = prints[:1500] ^ np.uint64(0b1011)
    tree, _ = build_tree(prints[:500], 32)
    homes, seen = {}, {}
    for shard, at, home in visits(tree, prints, 4):
        for i in at[home].tolist():
            assert homes.setdefault(i, shard) == shard
        seen[shard] = set(at.tolist())
    assert len(homes) == 3000
    assert all(i in seen[homes[i + 1500]] for i in range(1500))


def test_search_equals_brute_force():
    pick = np.random.default_rng(9)
    prints = np.unique(pick.integers(0, 2**20, 2000, dtype=np.uint64) << np.uint64(20))
    forest = Forest(len(prints))
    search(prints, np.arange(len(prints)), np.arange(len(prints)), 3, forest)
    assert forest.labels.tolist() == brute_components([int(p) for p in prints], 3)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i + 1, i) for i in range(60)]
    hub = [(1000 + i, 999) for i in range(1, 300)]
    got = connected(spark.createDataFrame(chain + hub, "u bigint, v bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(61)} | {i: 999 for i in [999, *range(1001, 1300)]}
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    got = simhash_components(odd(spark)).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r["component_id"] for r in got}
    assert by_id[3] == by_id[2] == 1
    assert by_id[4] == by_id[5] == by_id[6] == 4  # no words: fingerprint zero
    assert by_id[8] == 7
    kept = drop_near_duplicates(odd(spark))
    assert kept.columns == odd(spark).columns
    groups = {(r["fingerprint"], r["component_id"]) for r in got}
    assert kept.count() == len({c if c is not None else f for f, c in groups})
    assert drop_near_duplicates(none(spark)).count() == 0 and simhash_components(none(spark)).count() == 0
