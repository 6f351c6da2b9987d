"""Language identification: held-out accuracy, the scoring against a plain loop, odd rows."""

import re

import numpy as np
import pytest
from odd_rows import ROWS, none, odd

from formlake.llm.language_id import (
    LONGEST,
    WIDTH,
    BUCKETS,
    LanguageModel,
    _softmax,
    fitted_temperature,
    predict_language,
    subwords,
    train,
    words_of,
)
from formlake.llm.queries import QUERIES


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, size):
    folder = f"/root/testdata/{size}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = QUERIES["op11_language_id"](spark, folder).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["lang"]]
    right = [r for r in held if r["lang_pred"] == r["lang"]]
    assert len(right) / len(held) > 0.98
    assert abs(np.mean([r["score"] for r in held]) - len(right) / len(held)) < 0.03
    accepted = [r for r in held if r["accepted"]]
    assert len(accepted) > 0.85 * len(held) and sum(r["lang_pred"] == r["lang"] for r in accepted) >= 0.99 * len(accepted)
    letter = re.compile(r"[^\W\d_]")
    for r in rows:
        assert (r["lang_pred"] == "und") == (not letter.search(r["text"] or "")) and 0 <= r["score"] <= 1


def model(languages=3):
    pick = np.random.default_rng(1)
    names = [f"l{i}" for i in range(languages)]
    table = pick.normal(size=(BUCKETS, WIDTH)).astype(np.float32)
    return LanguageModel(names, table, pick.normal(size=(WIDTH, languages)), pick.normal(size=languages), 1.5, 0.4)


def test_scores_equal_a_plain_loop():
    some = model()
    for text in ("one", "one two one", "naïve Über 漢字 ½ x² 12 don't", "a" * 1000, "ab" * 40 + " ab"):
        rows = [b for w, n in words_of(text).items() for _ in range(n) for b in subwords([w])[0].tolist()]
        wanted = some.table[rows].astype(float).mean(axis=0) @ some.layer + some.offset
        assert np.allclose(some.logits(text), wanted)
        shares = _softmax(wanted[None] / 1.5)[0]
        assert some.predict(text) == (some.languages[shares.argmax()], pytest.approx(shares.max()), shares.max() >= 0.4)


def test_a_word_has_the_same_subwords_in_any_company():
    words = ["a", "ab", "übermut", "漢字", "x" * LONGEST, "𝔘nicode", "a"]
    buckets, place = subwords(words)
    for i, word in enumerate(words):
        assert sorted(buckets[place == i].tolist()) == sorted(subwords([word])[0].tolist())


def test_words_hold_letters():
    assert words_of("½ 12 _ ٣ … 😀") == {} and words_of("") == {}
    assert words_of("Ab ab x½ " + "é" * 130) == {"ab": 2, "x½": 1, "é" * 64: 2, "éé": 1}


def test_memory_of_words_is_bounded():
    some = model()
    some.words.most = 5
    for i in range(40):
        text = " ".join(f"word{chr(97 + (i * 7 + j) % 26)}{chr(97 + j)}" for j in range(7))
        assert np.allclose(some.logits(text), model().logits(text))
        assert len(some.words) <= 5 + 7


def test_training_is_stable_and_repeatable():
    texts, answers = ["aa bb cc", "xx yy zz", "aa cc", "zz xx"] * 20, [0, 1, 0, 1] * 20
    one, two = train(texts, answers, 2), train(texts, answers, 2)
    assert all((a == b).all() for a, b in zip(one, two)) and np.isfinite(one[0]).all()
    taught = LanguageModel(["a", "x"], *one, 1.0, 0.0)
    assert taught.predict("bb aa")[0] == "a" and taught.predict("YY")[0] == "x"


def test_temperature_makes_sure_answers_less_sure():
    logits = np.array([[8.0, 0.0]] * 10)
    answers = np.array([0] * 7 + [1] * 3)
    assert abs(_softmax(logits / fitted_temperature(logits, answers))[0, 0] - 0.7) < 0.02


def test_odd_rows(spark):
    docs = odd(spark).selectExpr("*", "case when doc_id % 3 = 0 then null when doc_id % 2 = 0 then 'x' else 'y' end as lang")
    rows = predict_language(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows if r["doc_id"]) == sorted((False, i) for i, _ in ROWS if i)
    assert len(rows) == len(ROWS)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and not by_id[i]["accepted"] for i in (4, 5, 6))
    assert by_id[7]["lang_pred"] in ("x", "y")
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)


def test_nothing_to_learn_from(spark):
    docs = odd(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in predict_language(docs).collect()} == {"und"}
    assert predict_language(none(spark).selectExpr("*", "'x' as lang")).count() == 0
    one = odd(spark).selectExpr("doc_id", "text", "'only' as lang")
    assert {r["lang_pred"] for r in predict_language(one).collect()} == {"only", "und"}
