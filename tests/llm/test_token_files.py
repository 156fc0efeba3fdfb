"""Token ids, Huffman blocks and token files against the tokenizer itself."""

import gc
import heapq
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from touchline.llm import huffman, queries, token_files, token_ids
from touchline.llm.rows import with_place
from touchline.llm.token_ids import Encoder, segments
from touchline.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("aAbzé'sStlIİK \t\n\x0b\x1c\x00\xa0.,<|>9٣中😀́ßΣ&")), max_size=5))
def test_word_by_word_equals_whole(texts, words, tokenizer):
    found = [[] for _ in texts]
    for number, ids, _ in words.encode_all([text.encode() for text in texts]):
        found[number].extend(ids.tolist())
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("mark", ["\u0308", "\u030a", "\u030c", "\u0331", "\u0344", "\u0316\u030c", "\u0307", "\u0301"])
def test_marks_are_composed_before_capitals_are_folded(mark, words, tokenizer):
    texts = [f"{letter}{mark}x A{letter}{mark}, Be" for letter in "HJTWYhjtwyIA"]
    found = [ids.tolist() for _, ids, _ in words.encode_all([text.encode() for text in texts])]
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_words_of_a_group_are_looked_up_together(tokenizer, monkeypatch):
    asked = {"words": [], "pieces": []}
    numbers = token_ids._Memo.numbers

    def counted(memo, keys, make):
        asked["words" if make.__name__ == "_encode_words" else "pieces"].extend(keys)
        return numbers(memo, keys, make)

    monkeypatch.setattr(token_ids._Memo, "numbers", counted)
    words, texts = Encoder(PATH), ["Word and thing, word 7é."] * 300 + ["", " thing "]
    found = [ids.tolist() for _, ids, _ in words.encode_all([text.encode() for text in texts])]
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert sorted(asked["words"]) == sorted({b"", *texts[0].lower().encode().split(), b"thing"})
    assert len(asked["pieces"]) < 20


def test_memos_turn_over(tokenizer, monkeypatch):
    for name, size in {"WORDS": 20, "PIECES": 10, "GROUP": 100, "GATHERED": 3, "SEGMENT": 50}.items():
        monkeypatch.setattr(token_ids, name, size)
    words, draw = Encoder(PATH), random.Random(4)
    texts = [" ".join("".join(draw.choices("a7é.Bσ,-", k=3)) for _ in range(9)) for _ in range(200)]
    found = [[] for _ in texts]
    for number, ids, _ in words.encode_all([text.encode() for text in texts]):
        found[number].extend(ids.tolist())
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(words.words) < 100


def test_forgotten_encoders_are_freed_at_once():
    kept = weakref.ref(token_ids.encoder(PATH))
    list(kept().encode_all([b"Word and thing"]))
    gc.disable()
    try:
        token_ids.forget()
        assert kept() is None
    finally:
        gc.enable()


def test_special_tokens_and_long_texts(words, tokenizer, monkeypatch):
    monkeypatch.setattr("touchline.llm.token_ids.SEGMENT", 50)
    for text in ("x<|endoftext|>Y", "<|EndOfText|> b", "lorem Ipsum " * 60, "y" * 300, ""):
        found = [i for ids in words.encode(text.encode()) for i in ids.tolist()]
        assert found == tokenizer.encode(text, add_special_tokens=False).ids
        whole = [i for _, ids, _ in words.encode_all([text.encode()]) for i in ids.tolist()]
        assert whole == found


def test_segments_lose_nothing():
    text = b"ab cde\nf " * 20
    assert b"".join(segments(text, 7)) == text
    assert list(segments(b"", 7)) == [b""]


def optimum(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    return total


@settings(max_examples=100, deadline=None)
@given(counts=st.lists(st.integers(1, 10_000), min_size=2, max_size=60))
def test_lengths_are_optimal_when_the_limit_is_wide(counts):
    lengths = huffman.code_lengths(np.array(counts), 30)
    assert int((lengths * counts).sum()) == optimum(counts)


def test_lengths_keep_the_limit():
    counts = np.array([2**i for i in range(20)])
    lengths = huffman.code_lengths(counts, 6)
    assert lengths.max() <= 6 and sum(2.0**-lengths) <= 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.integers(0, 400), max_size=700), seed=st.integers(0, 9))
def test_blocks_round_trip(ids, seed):
    ids = np.array(ids, np.uint32)
    known, counts = np.unique(ids, return_counts=True)
    book = huffman.Book(known, huffman.code_lengths(counts * (seed + 1)))
    bits, runs = book.encode(ids)
    assert book.decode(bits, runs, len(ids)).tolist() == ids.tolist()


def test_crc_of_parts():
    data = random.Random(3).randbytes(1000)
    for cuts in ([1000], [0, 10, 990], [500, 500]):
        parts, at = [], 0
        for size in cuts:
            parts.append(data[at : at + size])
            at += size
        assert token_files.combined_crc([zlib.crc32(p) for p in parts], cuts) == zlib.crc32(data)


def expected(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_files(spark, tokenizer, monkeypatch, rows):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    table = [(5, "Lorem ipsum dolor"), (3, None), (9, ""), (7, "word and thing " * 90), (4, "x"), (None, "no id"), (8, "x" * 64)]
    frame = spark.createDataFrame([(*row, 1, "clash") for row in table], "doc_id LONG, text STRING, start INT, ids STRING")
    path = scratch_path(spark, "tokens")
    token_files.write(with_place(frame.repartition(3)), path, PATH)
    assert rows(token_files.digests(spark, path)) == expected(table, tokenizer)
    assert spark.read.parquet(f"{path}/blocks").count() > 5


def test_long_documents_stay_in_one_part(spark, tokenizer, monkeypatch, rows):
    monkeypatch.setattr(token_files, "BLOCK", 16)
    table = [(i, f"word {i} and thing " * 30) for i in range(60)]
    held = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    usual = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        path = scratch_path(spark, "tokens")
        token_files.write(with_place(spark.createDataFrame(table, "doc_id LONG, text STRING")), path, PATH)
        assert token_files.read(spark, path).select("part").distinct().count() > 5
        assert rows(token_files.digests(spark, path)) == expected(table, tokenizer)
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)


def test_empty(spark):
    path = scratch_path(spark, "tokens")
    token_files.write(with_place(spark.createDataFrame([], "doc_id LONG, text STRING")), path, PATH)
    assert token_files.digests(spark, path).collect() == []


def test_query(spark, tokenizer, rows):
    sf = "/root/testdata/sf0.001"
    table = [tuple(row) for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op9_token_files(spark, sf)) == expected(table, tokenizer)
