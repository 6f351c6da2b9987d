"""Token operators against the libraries they stand for."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import none, odd
from tokenizers import Tokenizer

from formlake.llm.byte_bpe import decode_documents, encode_and_decode, encode_documents, encoder, read_ranks
from formlake.llm.library_ids import byte_level_ids, word_end_ids
from formlake.llm.packed_ids import TokenFile, pack, unpack
from formlake.llm.queries import QUERIES
from formlake.llm.segments import BYTE_LEVEL, SegmentCache
from formlake.llm.token_counts import _segments, count_tokens, frequent_pretokens
from formlake.llm.token_files import read_token_files, write_token_files

FOLDER = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
CHARACTERS = [
    *"aabbettA  hnoiÀÖØöøÿß.,.,'s'treé́fi\n\t\r\x0b\x1c\x1f\x85\xa0 　😀漢12 3!?#&-_▁ΣςỊ̇ﬁ",
    "<|endoftext|>", "<s>", "'ll",
]


def library(path):
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(11)
    return ["".join(pick.choices(CHARACTERS, k=pick.randint(0, 24))) for _ in range(6000)]


@pytest.mark.parametrize("path, ids_of", [(BYTES, byte_level_ids), (WORDS, word_end_ids)])
def test_segments_give_the_library_ids(texts, path, ids_of):
    whole, cut = library(path), ids_of(path)
    for text in texts:
        assert np.frombuffer(cut(text), cut.kind).tolist() == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("path, ids_of", [(BYTES, byte_level_ids), (WORDS, word_end_ids)])
def test_added_tokens_get_their_ids_by_default(texts, path, ids_of):
    whole, cut = Tokenizer.from_file(path), ids_of(path, added=True)
    for text in [*texts, "a <|endoftext|> b", "<|startoftext|><|endoftext|>'s", "<|ENDOFTEXT|>"]:
        assert np.frombuffer(cut(text), cut.kind).tolist() == whole.encode(text, add_special_tokens=False).ids, text


SPECIAL = [(1, "a <|endoftext|> b"), (2, "<|startoftext|>x<|endoftext|>"), (3, "plain"), (4, None)]


def test_queries_keep_the_default_for_added_tokens(spark, folder):
    spark.createDataFrame(SPECIAL, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    whole, before = Tokenizer.from_file(BYTES), 0
    for row in sorted(QUERIES["op2_token_files"](spark, folder).collect(), key=lambda r: r["doc_id"]):
        ids = [*whole.encode(dict(SPECIAL)[row["doc_id"]] or "", add_special_tokens=False).ids, 0]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (before, len(ids), crc(ids))
        before += len(ids)
    words = Tokenizer.from_file(WORDS)
    rows = {r["doc_id"]: r for r in QUERIES["op7_packing"](spark, folder).collect()}
    assert len(rows) == len(SPECIAL)
    for doc_id, text in SPECIAL:
        ids = [*words.encode(text or "", add_special_tokens=False).ids, 0]
        assert (rows[doc_id]["length"], rows[doc_id]["ids_crc32"]) == (len(ids), crc(ids))


def test_segment_counts_add_up(texts):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in texts:
        assert sum(len(pieces.encode("\n" + s)) - 2 for s in _segments(text)) == len(pieces.encode(text)), text


def test_byte_bpe_is_the_exact_merge(texts):
    ranks = read_ranks(RANKS)
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = encoder(RANKS, public_tokenizers.PATTERN)
    for text in texts:
        ids = own.encode(text)
        assert ids == exact.encode_ordinary(text), text
        assert [i for s in BYTE_LEVEL.findall(text) for i in own.encode(s)] == ids
        assert own.decode(ids) == text.encode("utf-8")
    assert own.encode_piece(b"ab" * 3000) == exact.encode_ordinary("ab" * 3000)


def test_cache_keeps_the_earliest_half():
    cache = SegmentCache(len, limit=4, longest=3)
    assert [cache[k] for k in ("a", "bb", "ccc", "dddd")] == [1, 2, 3, 4]
    assert "dddd" not in cache
    for key in ("d", "e"):
        cache[key]
    assert list(cache) == ["a", "bb", "e"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700), st.floats(0.5, 1.0))
def test_packed_ids_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    assert unpack(pack(ids, percentile)).tolist() == ids.tolist()
    lengths = np.array([len(ids), 0], np.uint32)
    back = TokenFile.from_bytes(TokenFile(1, 2, 3, [7, None], lengths, ids).to_bytes(percentile) + b"\n")
    assert (back.range_no, back.file_no, back.first, back.doc_ids) == (1, 2, 3, [7, None])
    assert back.ids.tolist() == ids.tolist()


def test_few_large_ids_become_exceptions():
    ids = np.arange(128, dtype=np.uint32)
    ids[5] = 1 << 31
    blocks = pack(ids)
    assert blocks.widths.tolist() == [7] and blocks.places.tolist() == [5]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_files_of_all_documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, FOLDER).collect()}
    whole, before = library(BYTES), 0
    assert len(got) == len(rows)
    for doc_id, text in sorted(rows):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        row = got[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (before, len(ids), crc(ids))
        before += len(ids)


def test_token_files_of_odd_rows(spark, folder):
    write_token_files(odd(spark), f"{folder}/odd", BYTES, ranges=3)
    rows = read_token_files(spark, f"{folder}/odd").orderBy("start").collect()
    whole = library(BYTES)
    wanted = sorted(
        ((r["doc_id"] is not None, r["doc_id"] or 0, [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0]))
        for r in odd(spark).collect()
    )
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids"]) for r in rows) == wanted
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows] == [w[:2] for w in wanted]
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
    write_token_files(none(spark), f"{folder}/none", BYTES)
    assert read_token_files(spark, f"{folder}/none").count() == 0


def test_byte_bpe_of_all_documents(spark):
    whole = library(BYTES)  # the same vocabulary
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op4_byte_bpe"](spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_byte_bpe_of_odd_rows(spark):
    digests = encode_and_decode(odd(spark), RANKS, public_tokenizers.PATTERN).collect()
    texts = sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in odd(spark).collect())
    assert sorted(r["decoded_sha256"] for r in digests) == texts
    back = decode_documents(encode_documents(odd(spark), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in odd(spark).collect())
    assert encode_and_decode(none(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("entries", [1, 1000])
def test_token_counts(spark, entries):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (spark.read.parquet(f"{FOLDER}/documents.parquet"), odd(spark)):
        rows = docs.select("doc_id", "text").collect()
        wanted = sorted(
            (r["doc_id"] or 0, len((r["text"] or "").encode()), len(pieces.encode(r["text"] or ""))) for r in rows
        )
        got = count_tokens(docs, PIECES, entries=entries, sample_rows=50).collect()
        assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == wanted
        assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert count_tokens(none(spark), PIECES).count() == 0


def test_frequent_pretokens_come_from_all_rows(spark):
    # One word a row, word k in 1,000 - 3 k rows: 45,000 rows, which were halved by a hash before.
    words = [(f"w{k:02d}", 1000 - 3 * k) for k in range(50)]
    texts = spark.createDataFrame(words, "text string, n int").selectExpr("text", "explode(sequence(1, n)) AS doc_id")
    texts = texts.repartition(5)
    assert texts.count() > 45_000
    assert frequent_pretokens(texts, entries=64) == [" " + word for word, _ in words]

    # Rare words that come between must not push out what a task has counted so far.
    often = [f"{word} r{word}{i}" for word, n in (("a", 400), ("b", 200), ("c", 100), ("d", 50)) for i in range(n)]
    mixed = spark.createDataFrame([(i, t) for i, t in enumerate(often)], "doc_id bigint, text string")
    assert frequent_pretokens(mixed, entries=4) == [" a", " b", " c", " d"]
