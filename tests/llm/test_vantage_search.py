"""Vantage-point search against all inner products."""

import math
import random

import pytest
from pyspark.sql import functions as F

from touchline.llm import queries, vantage_search

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, row STRING, score INT"


def score(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def expected(vectors, asked, k):
    """(query_id, rank, vec_id, score) by comparing every query with every row."""
    good = [
        (number, vec_id, v)
        for number, (vec_id, v) in enumerate(vectors)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for number, query_id, q in good:
        if query_id is not None and asked(query_id):
            near = [(-score(q, v), vec_id is None, vec_id or 0) for other, vec_id, v in good if other != number]
            near.sort()
            out += [(query_id, i + 1, None if unknown else vec_id, -s) for i, (s, unknown, vec_id) in enumerate(near[:k])]
    return sorted(out, key=repr)


def drawn(n, width, seed=0, centres=0):
    """Single-precision numbers, as a frame gives them back."""
    draw = random.Random(seed)
    middle = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(centres)]
    out = []
    for i in range(n):
        base = draw.choice(middle) if centres else [0] * width
        out.append((i, [round((x + draw.gauss(0, 0.15 if centres else 1)) * 1024) / 1024 for x in base]))
    return out


def frame(spark, vectors):
    return spark.createDataFrame([(vec_id, v, "r", 1) for vec_id, v in vectors], SCHEMA)


def test_query(spark, rows):
    """Exact on these tables, where no two vectors are near enough for the relaxed bounds to lose a neighbour."""
    sf = "/root/testdata/sf0.001"
    vectors = [tuple(row) for row in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert rows(queries.op12_vantage_search(spark, sf)) == expected(vectors, lambda i: i % 20 == 0, 20)


@pytest.mark.parametrize(("width", "centres"), [(3, 0), (24, 0), (8, 5)])
def test_factor_one_is_exact(spark, rows, width, centres):
    """Many small shards, lengths that differ, several cells."""
    vectors = drawn(900, width, 1, centres)
    found = vantage_search.nearest(frame(spark, vectors).repartition(3), F.col("vec_id") % 9 == 0, 7, 1.0, 100 * width)
    assert rows(found) == expected(vectors, lambda i: i % 9 == 0, 7)


@pytest.mark.parametrize(("width", "centres"), [(24, 0), (8, 12), (3, 40)])
def test_recall_of_the_default_factor(spark, width, centres):
    vectors = drawn(1500, width, 2, centres)
    want = {(q, v) for q, _, v, _ in expected(vectors, lambda i: i % 10 == 0, 20)}
    found = vantage_search.nearest(frame(spark, vectors), F.col("vec_id") % 10 == 0, numbers=200 * width)
    got = {(row["query_id"], row["vec_id"]) for row in found.collect()}
    assert len(want & got) >= 0.95 * len(want)


def test_hot_copies_odd_values_and_ties(spark, rows):
    """A third of the rows are one vector; NULL and repeated ids, unusable vectors and differing lengths."""
    vectors = drawn(200, 4, 3) + [(i % 40, [1.0, 0.5, -0.25, 2.0]) for i in range(100)]
    vectors += [(None, [1.0, 0.5, -0.25, 2.0]), (None, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None])]
    vectors += [(7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [2.0]), (10, [1.0, 1.0, 1.0, 1.0, 3.0, 1.0])]
    for factor, k in ((1.0, 5), (1.0, 400)):
        found = vantage_search.nearest(frame(spark, vectors).repartition(2), F.col("vec_id") % 10 == 0, k, factor, 240)
        assert rows(found) == expected(vectors, lambda i: i % 10 == 0, k)


def test_empty_tables(spark, rows):
    asked = F.col("vec_id") % 20 == 0
    assert rows(vantage_search.nearest(frame(spark, []), asked)) == []
    assert rows(vantage_search.nearest(frame(spark, [(1, None), (20, [0.0])]), asked)) == []
    assert rows(vantage_search.nearest(frame(spark, [(20, [1.0])]), asked)) == []
    assert rows(vantage_search.nearest(frame(spark, [(1, [1.0]), (2, [2.0])]), asked)) == []


def test_larger_factors_compare_less(monkeypatch):
    """On clustered points the bounds skip most comparisons, and a larger factor skips more."""
    import numpy as np
    import pyarrow as pa

    vectors = drawn(4000, 6, 4, 60)
    table = pa.table({"vector": [v for _, v in vectors], "row": range(4000), "vec_id": [i for i, _ in vectors]})
    shard = vantage_search.Shard(table, 6)
    longest = float(np.sqrt((shard.vectors**2).sum(1).max()))
    tree = vantage_search.Tree(vantage_search._on_sphere(shard.vectors, longest), longest, 16)
    compared = []
    compare = vantage_search.Queries.compare

    def counted(self, who, rows, some):
        compared[-1] += len(who) * len(rows)
        compare(self, who, rows, some)

    monkeypatch.setattr(vantage_search.Queries, "compare", counted)
    for factor in (1.0, 2.0, 4.0):
        compared.append(0)
        some = shard.vectors[:100]
        block = vantage_search.Queries(some, np.arange(100), np.full(100, -np.inf), longest, 5, factor)
        block.search(tree, shard)
    assert compared[2] < compared[1] < compared[0] < 400_000
