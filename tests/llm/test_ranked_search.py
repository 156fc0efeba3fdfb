"""The Best Position Algorithm against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference

from touchline.llm import queries, ranked_search, sql
from touchline.session import scratch_path

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCUMENTS = "doc_id BIGINT, text STRING, term STRING, rank INT"
ITEMS = "item_id STRING, text STRING, score INT"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(documents, items, k=50):
    """(item_id, rank, doc_id, score), every item scored against every document."""
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in documents]
    counted = [(doc_id, found) for doc_id, found in counted if found]
    n, length = len(counted), sum(found.total() for _, found in counted)
    df = Counter(term for _, found in counted for term in found)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, found in counted:
            m = 100 - 50 + (50 * found.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * (10**9 * found[term] // (1000 * found[term] + 20 * m))
                for term in set(terms(text))
                if term in found
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        scores.sort()
        out += [(item_id, i + 1, None if unknown else doc, -score) for i, (score, unknown, doc) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def test_terms():
    text = "The É-x_9 ñA\x7fb\x00cあd ZZ~İ"
    assert [word.decode() for word in ranked_search.terms_of(text.encode())] == terms(text)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.op11_ranked_search(spark, sf)
    assert difference(found, connect(sf), sql.OP11) is None


def case(seed):
    draw = random.Random(seed)
    words = ["a", "B", "the", "é", "x9", "rare", "and", "of"]
    text = lambda n: " ".join(draw.choices(words, [8, 6, 5, 4, 3, 1, 2, 2], k=n))
    documents = [(i % 50, text(draw.choice([0, 1, 3, 9, 40]))) for i in range(120)]
    documents += [(None, "rare x9"), (None, "rare x9"), (7, None), (8, ""), (9, " -- "), (10, "a " * 3000)]
    items = [(str(i), text(draw.choice([1, 3, 8]))) for i in range(9)]
    items += [("1", "a B"), (None, "rare"), ("n", None), ("e", ""), ("u", "unknown words"), ("u", "rare rare the")]
    return documents, items


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("k", [1, 7, 200])
def test_against_all_scores(spark, rows, seed, k):
    """Ties, repeated rows, NULLs, empty and long texts; several shards and blocks."""
    documents, items = case(seed)
    path = scratch_path(spark, "test")
    ranked_search.build(
        spark.createDataFrame([(*row, "x", 3) for row in documents], DOCUMENTS).repartition(3), path, 20, 60
    )
    index = ranked_search.open_index(spark, path)
    assert index.where("term IS NULL").count() > 3
    found = ranked_search.search(index, spark.createDataFrame([(*row, 5) for row in items], ITEMS), k, block=4)
    assert rows(found) == expected(documents, items, k)


def test_empty_tables(spark):
    documents, items = (spark.createDataFrame([], some) for some in (DOCUMENTS, ITEMS))
    full = spark.createDataFrame([("1", "a", 2)], ITEMS), spark.createDataFrame([(1, "a", "b", 3)], DOCUMENTS)
    assert ranked_search.rank(documents, full[0]).count() == 0
    assert ranked_search.rank(full[1], items).count() == 0
    assert ranked_search.rank(full[1], full[0]).count() == 1  # df = N still weighs floor(1000 ln(4/3))


def test_stops_before_the_end_of_the_lists():
    """Few documents hold the rare term; the long lists are not read to their ends, and ties are whole."""
    draw = np.random.default_rng(3)
    n = 5000
    common = np.arange(n, dtype=np.int32)
    rare = np.sort(draw.choice(n, 30, replace=False)).astype(np.int32)
    lists = ranked_search.Lists(
        n,
        {"common": (common, draw.integers(1, 4, n).astype(np.int32)), "rare": (rare, np.full(30, 2, np.int32))},
        50 + draw.integers(0, 40, n),
    )
    docs, scores, accesses = lists.best([("common", 20), ("rare", 9000)], 10, common.astype(np.int64))
    assert len(docs) == 10 and accesses < n / 4
    assert set(docs.tolist()) <= set(rare.tolist())
    again = lists.best([("common", 20), ("rare", 9000)], n, common.astype(np.int64))
    assert docs.tolist() == again[0][:10].tolist() and scores.tolist() == again[1][:10].tolist()
