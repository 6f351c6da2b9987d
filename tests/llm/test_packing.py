"""Packing against the bounds and the library."""

import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from odd_rows import none, odd
from tokenizers import Tokenizer

from formlake.llm.grouping_plan import Plan, best_plan, solve_configurations
from formlake.llm.packing import pack_documents
from formlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_plan(plan, histogram):
    """Every piece once, no bin over capacity, no gaps."""
    lengths = [n for n in sorted(histogram, reverse=True) for _ in range(histogram[n])]
    seen, bins = [0] * len(lengths), {}
    for first, last, bin_no, offset in plan.segments:
        for i in range(first, last):
            seen[i] += 1
            bins.setdefault(bin_no + i - first, []).append((offset, lengths[i]))
    assert all(n == 1 for n in seen)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= plan.capacity
    assert sorted(bins) == list(range(plan.bins))


@pytest.mark.parametrize("seed", range(12))
def test_plans_are_sound_and_tight(seed):
    pick = random.Random(seed)
    low, high = sorted(pick.choices(range(1, 257), k=2))
    histogram = Counter(pick.randint(low, high) for _ in range(pick.randint(1, 4000)))
    for small in (0.125, 0.25, 0.5):
        check_plan(Plan(dict(histogram), 256, 16, small), histogram)
    plan = best_plan(dict(histogram), 256)
    check_plan(plan, histogram)
    free, falling = [], 0  # best fit decreasing, piece by piece
    for length in sorted(histogram.elements(), reverse=True):
        room = min((r for r in free if r >= length), default=None)
        if room is None:
            falling += 1
            free.append(256 - length)
        else:
            free.remove(room)
            free.append(room - length)
    assert plan.bins <= falling * 1.02 + 2


def test_configurations_beat_greedy():
    # Thirds and halves: 6 of 170 and 4 of 128 fit six bins exactly as 3 x 85 would not.
    chosen = solve_configurations([128, 85], [200, 300], 256)
    assert sum(bins for bins, _ in chosen) == 200
    assert best_plan({}, 256).bins == 0 and best_plan({256: 3, 1: 2}, 256).bins == 4


def check_rows(rows, texts):
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    wanted = Counter()
    for doc_id, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            wanted[doc_id, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), -(-sum(r["length"] for r in rows) // 2048)


def test_all_documents(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    used, least = check_rows(QUERIES["op7_packing"](spark, FOLDER).collect(), texts)
    assert used <= least + 1


def test_odd_rows(spark):
    texts = odd(spark).select("doc_id", "text").collect()
    check_rows(pack_documents(odd(spark), WORDS).collect(), texts)
    assert pack_documents(none(spark), WORDS).count() == 0
