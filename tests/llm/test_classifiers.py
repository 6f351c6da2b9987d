"""Toxicity and quality: exact neighbours, held-out accuracy, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import ROWS, none, odd

from formlake.llm import additive_model
from formlake.llm.block_index import BlockMaxIndex
from formlake.llm.quality import FEATURES, drop_low_quality, features, score_quality
from formlake.llm.queries import QUERIES
from formlake.llm.toxicity import Terms, drop_toxic, monotone_fit, score_toxicity, word_terms

FOLDER = "/root/testdata/sf0.1"


def random_vectors(count, terms, seed):
    pick = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        t = np.sort(pick.choice(terms, pick.integers(1, 9), replace=False))
        w = pick.random(len(t)) + 0.01
        out.append((t.astype(np.int64), w / np.linalg.norm(w)))
    return out


@pytest.mark.parametrize("count", [1, 64, 700])
def test_neighbours_equal_brute_force(count):
    examples, terms = random_vectors(count, 60, 1), 60
    index = BlockMaxIndex(examples, terms)
    dense = np.zeros((count, terms))
    for row, (t, w) in zip(dense, examples):
        row[t] = w
    for n, (t, w) in enumerate(random_vectors(200, terms, 2)):
        likeness = dense[:, t] @ w
        without = n % count
        likeness[without] = 0
        order = np.lexsort((np.arange(count), -np.round(likeness, 12)))
        wanted = [i for i in order[:10].tolist() if likeness[i] > 0]
        found, similar = index.nearest(t, w, 10, without)
        assert found.tolist() == wanted and np.allclose(similar, likeness[wanted])
    assert len(index.nearest(np.zeros(0, np.int64), np.zeros(0), 5)[0]) == 0


def test_monotone_fit():
    steps, heights = monotone_fit(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1]))
    assert (np.diff(heights) >= 0).all() and len(steps) == 3


def test_word_terms():
    assert word_terms("abcd") == ["abcd", "abc*"] and word_terms("ab") == ["ab"]
    assert Terms(["abc*", "x"]).count("ABCD x y abc") == ([0, 1], [1, 1], 4)
    assert Terms(["abc*", "x"]).arrays("ABCD x y abc")[3] == 3  # words outside the vocabulary


def accuracy(rows, label):
    held = [r for r in rows if r["held_out"]]
    positive = [r for r in held if r[label] == 1]
    negative = [r for r in held if r[label] == 0]
    recall = sum(r["predicted"] for r in positive) / len(positive)
    return recall, sum(r["predicted"] for r in negative) / len(negative)


def test_toxicity_on_held_out_rows(spark):
    scored = QUERIES["op3_toxicity"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = scored.join(labels, "doc_id").collect()
    recall, alarms = accuracy(rows, "toxic")
    assert recall > 0.9 and alarms < 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    near = max(rows, key=lambda r: r["score"])["evidence"]
    assert near and all(0 < n["similarity"] <= 1 for n in near)
    calibrated = [r["score"] for r in rows if r["held_out"]]
    assert abs(np.mean(calibrated) - np.mean([r["toxic"] for r in rows if r["held_out"]])) < 0.03


def test_every_text_is_searched(spark):
    """No toxic row shares a word with three others, so none would be in a lexicon."""
    pick = np.random.default_rng(5)

    def text(i):
        return " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{w}" for w in pick.integers(1000, 9999, 30))

    texts = [text(i) for i in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (2000, "zz zz"), (2001, " ")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(docs, labels, folds=1000, fold=999).collect()}
    assert len(got) == 402
    for i in range(200):  # an exact copy rests on the example it is a copy of
        first = got[1000 + i]["evidence"][0]
        assert first["doc_id"] == i and abs(first["similarity"] - 1) < 1e-9
    assert not got[2000]["evidence"] and not got[2001]["evidence"]


def test_copies_of_toxic_examples_are_toxic(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    copies = docs.join(labels.where("toxic = 1"), "doc_id").selectExpr("-doc_id as doc_id", "text")
    rows = score_toxicity(docs.union(copies), labels).collect()
    scores = {r["doc_id"]: r for r in rows}
    trained = [r for r in rows if r["doc_id"] < 0 and not scores[-r["doc_id"]]["held_out"]]
    assert len(trained) == 37 and all(r["predicted"] for r in trained)
    assert all(r["evidence"] for r in rows if r["doc_id"] < 0)


def plain_toxicity(docs, labels):
    """Scores by dictionaries, every text against every example."""
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs}
    train = sorted((i, y) for i, y in labels.items() if i in docs and y in (0, 1) and not held[i])
    words_of = {i: Counter(re.findall(r"\w+", (t or "").lower())) for i, t in docs.items()}
    with_term = [Counter(), Counter()]
    for i, y in train:
        with_term[y].update({t for w in words_of[i] for t in word_terms(w)})
    toxic = sum(y for _, y in train)
    clean = len(train) - toxic
    everything = set(with_term[0]) | set(with_term[1])
    tie = {}
    for t in everything:
        a, b = with_term[1][t], with_term[0][t]
        seen = [(a, (a + b) * toxic / len(train)), (b, (a + b) * clean / len(train))]
        seen += [(toxic - a, (len(train) - a - b) * toxic / len(train)), (clean - b, (len(train) - a - b) * clean / len(train))]
        ratio = sum(2 * n * math.log(n / e) for n, e in seen if n > 0)
        tie[t] = min(1, max(0, ratio / (1.5 * math.log(len(everything))))) ** 2 if a > seen[0][1] else 0
    terms = {t for t in everything if not t.endswith("*") or tie[t] >= 0.25}
    found = {i: {t: sum(n for w, n in words.items() if t in word_terms(w)) for t in {t for w in words for t in word_terms(w)} & terms}
             for i, words in words_of.items()}
    seen_in = Counter(t for own in found.values() for t in own)
    idf = {t: math.log((2 + len(docs)) / (1 + seen_in[t])) for t in terms}
    vectors = {}
    for i, own in found.items():
        vector = {t: (1 + math.log(n)) * idf[t] * (0.05 + 0.95 * tie[t]) for t, n in own.items()}
        outside = sum(w not in terms for w in words_of[i]) * (0.05 * math.log(2 + len(docs))) ** 2
        length = math.sqrt(sum(x * x for x in vector.values()) + outside) or 1
        vectors[i] = {t: x / length for t, x in vector.items()}
    base = (toxic + 0.5) / (len(train) + 1)

    def vote(i, without=None):
        likeness = []
        for n, (j, y) in enumerate(train):
            own = vectors[j]
            s = sum(x * own[t] for t, x in vectors[i].items() if t in own)
            if words_of[j] and j != without and s > 0:
                likeness.append((-round(s, 12), n, min(s, 1), y))
        best = [(s * s / (1.02 - s * s), y) for _, _, s, y in sorted(likeness)[:10]]
        return (sum(w * y for w, y in best) + 0.2 * base / 2) / (sum(w for w, _ in best) + 0.2)

    voted = [(vote(i, i), y) for i, y in train if words_of[i]]
    steps, heights = monotone_fit(np.array([v for v, _ in voted]), np.array([y for _, y in voted]))
    plain = [y for i, y in train if not words_of[i]]
    unmarked = (sum(plain) + 0.5 * base) / (len(plain) + 0.5)
    return {i: float(np.interp(vote(i), steps, heights)) if words_of[i] else unmarked for i in docs}


def test_toxicity_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    wanted = plain_toxicity(docs, labels)
    got = QUERIES["op3_toxicity"](spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        assert abs(r["score"] - wanted[r["doc_id"]]) < 1e-6, r["doc_id"]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_quality_on_held_out_rows(spark):
    scored = QUERIES["op6_quality"](spark, FOLDER)
    rows = scored.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    recall, alarms = accuracy(rows, "quality")
    assert recall > 0.99 and alarms < 0.1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_additive_model_finds_an_interaction():
    x = np.random.default_rng(1).random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = additive_model.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95 and model.pairs[0][:2] == (0, 1)


def test_features():
    assert features("") == [0.0] * len(FEATURES)
    known = dict(zip(FEATURES, features("A a a |\nA a a |")))
    assert known["pipes"] == 2 / 15 and known["repeated_lines"] == 0.5 and known["stutter"] == 2 / 8


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 2, "extra") for i in range(1, 11)] + [(None, 1, 1, "x"), (5, None, None, "x"), (6, 7, 7, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string")


@pytest.mark.parametrize("score, drop", [(score_toxicity, drop_toxic), (score_quality, drop_low_quality)])
def test_odd_rows(spark, labels, score, drop):
    got = score(odd(spark), labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert all(not r["held_out"] for r in got if r["doc_id"] is None)
    kept = drop(odd(spark), labels)
    assert kept.columns == odd(spark).columns and kept.count() <= len(ROWS)
    assert score(none(spark), labels).count() == 0 and drop(none(spark), labels).count() == 0
    nothing = labels.limit(0)
    assert score(odd(spark), nothing).count() == len(ROWS)
    assert drop(odd(spark), nothing).count() == len(ROWS)  # without labels nothing is rejected


def test_few_examples_are_compared_in_full():
    rng = np.random.default_rng(5)
    def vector():
        found = np.unique(rng.integers(0, 300, 40))
        weights = rng.random(len(found))
        return found.astype(np.int32), weights / np.sqrt(weights @ weights)

    examples, queries = [vector() for _ in range(2000)], [vector() for _ in range(250)]
    dense = np.zeros((2, 2000, 300))
    for side, vectors in zip(dense, (examples, queries)):
        for row, (found, weights) in zip(side, vectors):
            row[found] = weights
    index = BlockMaxIndex(examples, 300)
    for query, (found, likeness) in zip(dense[1], index.nearest_many(queries, 10)):
        sums = dense[0] @ query
        assert np.allclose(likeness, np.sort(sums)[::-1][:10]) and np.allclose(likeness, sums[found])
    assert index.compared < 20 * len(queries)  # twice the neighbours were compared before any bound
