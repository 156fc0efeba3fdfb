"""The positional index against plain scans."""

import hashlib
import random
import re

import pytest

from touchline.llm import decontamination, positional_index, queries
from touchline.llm.rows import with_place
from touchline.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(documents, items, size=13):
    phrases = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - size + 1)):
            if own:
                phrases.setdefault(tuple(own[i : i + size]), set()).add(item or "")
    sizes = {len(p) for p in phrases}
    out = []
    for doc_id, text in documents:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if names := phrases.get(tuple(own[i : i + n])):
                    found |= names
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_query(spark, rows):
    sf = "/root/testdata/sf0.001"
    tables = [
        [tuple(row) for row in spark.read.parquet(f"{sf}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    ]
    tables[1] = [(str(item), text) for item, text in tables[1]]
    found = rows(queries.op8_decontamination(spark, sf), *COLUMNS)
    assert found == expected(*tables)
    assert any(row[-1] for row in found) and not all(row[-1] for row in found)


def case(seed):
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice(["a", "b", "The", "é-x", "9."]) for _ in range(n))
    items = [(str(i), text(draw.choice([0, 1, 3, 6, 20]))) for i in range(8)] + [(None, "a b"), ("1", "b b b"), ("x", None)]
    documents = [(i % 9, text(draw.choice([0, 2, 30, 200]))) for i in range(14)] + [(None, "a b a b"), (3, None), (4, "")]
    return documents, items


@pytest.mark.parametrize("seed", range(3))
def test_small_shards_pieces_and_blocks(spark, rows, monkeypatch, seed):
    monkeypatch.setattr(positional_index, "SHARD", 64)
    monkeypatch.setattr(positional_index, "PIECE", 60)
    monkeypatch.setattr(positional_index, "OVERLAP", 8)
    monkeypatch.setattr(positional_index, "BLOCK", 10)
    documents, items = case(seed)
    frame = spark.createDataFrame([(*row, "c") for row in documents], "doc_id LONG, text STRING, n_hit STRING")
    bench = spark.createDataFrame([(*row, 1) for row in items], "item_id STRING, text STRING, doc_id INT")
    found = decontamination.report(with_place(frame), bench, window=5)
    assert rows(found, *COLUMNS) == expected(documents, items, 5)
    kept = decontamination.clean(frame, bench, window=5)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id", "text") == sorted(
        ((d, t) for d, t in documents if not expected([(d, t)], items, 5)[0][-1]), key=repr
    )


def test_near(spark, rows):
    frame = spark.createDataFrame([(1, "x one y z two three"), (2, "three two w one"), (3, "one two"), (4, "one q q q q q two three")], "doc_id LONG, text STRING")
    path = scratch_path(spark, "index")
    placed = with_place(frame)
    positional_index.build(placed, path)
    index = positional_index.open_index(spark, path)
    found = positional_index.search(index, iter([("i", (b"one", b"two", b"three"))]), slack=2)
    ids = positional_index.documents(index)
    assert rows(found.join(ids, ["_file", "_at"]), "doc_id", "low", "high") == [(1, 1, 6), (2, 0, 4)]
    with pytest.raises(ValueError):
        positional_index.search(index, iter([("i", (b"a",) * 300)]))


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id LONG, text STRING")
    bench = spark.createDataFrame([], "item_id LONG, text STRING")
    some = spark.createDataFrame([(1, "a b")], "doc_id LONG, text STRING")
    assert decontamination.report(with_place(none), bench).collect() == []
    assert decontamination.report(with_place(some), bench).select("n_words", "n_hit").collect() == [(2, 0)]
