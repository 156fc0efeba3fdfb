"""The n-gram Jaccard join against all pairs, and components against union-find."""

import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import ngram_join, queries
from touchline.llm.components import components
from touchline.llm.rows import with_place


def grams(text, n):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [word for word in words.split(" ") if word]
    if not words:
        return set()
    size = min(n, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def roots(nodes, links):
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return {node: find(node) for node in nodes}


def expected(documents, n, threshold):
    sets = [grams(text, n) for _, text in documents]
    holders = {}
    for i, own in enumerate(sets):
        for gram in own:
            holders.setdefault(gram, []).append(i)
    pairs = {(a, b) for some in holders.values() for a in some for b in some if a < b}
    links = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    root = roots(range(len(documents)), links)
    least = {}
    for i, (doc_id, _) in enumerate(documents):
        known = least.get(root[i])
        least[root[i]] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    found = sorted(((d, len(sets[i]), least[root[i]]) for i, (d, _) in enumerate(documents)), key=repr)
    return found, len(set(root.values()))


def family(draw, size, edits, copies):
    base = [f"w{draw.randint(0, 400)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(draw.randint(0, edits)):
            own[draw.randrange(len(own))] = f"x{draw.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def corpus(seed):
    draw = random.Random(seed)
    texts = [None, "", " \n", "one", "One", "one two", "two one", "a a a a a a", "a a a"]
    for size in (8, 30, 60, 90, 200):
        texts += family(draw, size, 3, 25)
    texts += [" ".join(f"w{draw.randint(0, 400)}" for _ in range(draw.randint(1, 80))) for _ in range(60)]
    draw.shuffle(texts)
    return [(i % 180 if i % 50 else None, text) for i, text in enumerate(texts)]


@pytest.mark.parametrize("n, threshold, rows_of_a_part", [(3, Fraction(9, 10), 512), (5, Fraction(4, 5), 8)])
def test_against_all_pairs(spark, rows, monkeypatch, n, threshold, rows_of_a_part):
    monkeypatch.setattr(ngram_join, "PART_ROWS", rows_of_a_part)
    table = corpus(n)
    frame = spark.createDataFrame([(*row, "c", 3) for row in table], "doc_id LONG, text STRING, class STRING, n INT")
    placed = with_place(frame.repartition(3))
    found = ngram_join.jaccard_components(placed, n, threshold)
    want, groups = expected(table, n, threshold)
    assert rows(found, "doc_id", "n_shingles", "component_id") == want
    assert found.filter("first").count() == groups
    kept = ngram_join.one_of_each(frame, n, threshold)
    assert kept.columns == frame.columns and kept.count() == groups


def test_query(spark, rows):
    sf = "/root/testdata/sf0.01"
    table = [tuple(row) for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = rows(queries.op2_ngram_join(spark, sf))
    assert found == expected(table, 3, Fraction(9, 10))[0]


@settings(max_examples=200, deadline=None)
@given(data=st.data(), n=st.integers(1, 120), threshold=st.sampled_from([Fraction(3, 4), Fraction(4, 5), Fraction(9, 10)]))
def test_similar_sets_share_a_pair_of_prefix_grams(data, n, threshold):
    base = data.draw(st.sets(st.integers(0, 10**6), min_size=n, max_size=n))
    own = sorted(base)
    removed = data.draw(st.sets(st.sampled_from(own), max_size=n // 5))
    added = data.draw(st.sets(st.integers(0, 10**6), max_size=n // 5))
    other = sorted((base - removed) | added)
    if own == other or not other or len(set(own) & set(other)) < threshold * len(set(own) | set(other)):
        return
    pairs = [
        set(zip(one[: ngram_join.prefix(len(one), threshold)], one[1 : ngram_join.prefix(len(one), threshold)]))
        for one in (own, other)
    ]
    assert pairs[0] & pairs[1]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("sided", [False, True])
def test_similar(seed, sided):
    draw = np.random.default_rng(seed)
    threshold = Fraction(8, 10)
    sets = []
    for _ in range(12):
        base = draw.integers(0, 2**63, 40, dtype=np.uint64)
        for _ in range(4):
            own = base.copy()
            own[draw.integers(0, 40, draw.integers(0, 6))] = draw.integers(0, 2**63, dtype=np.uint64)
            sets.append(np.unique(own))
    side = draw.random(len(sets)) < 0.5 if sided else None
    links = ngram_join.similar(sets, side, threshold)
    want = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if (side is None or side[i] != side[j])
        and len(np.intersect1d(sets[i], sets[j])) >= threshold * len(np.union1d(sets[i], sets[j]))
    ]
    def partition(pairs):
        groups = {}
        for node, root in roots(range(len(sets)), pairs).items():
            groups.setdefault(root, []).append(node)
        return sorted(groups.values())
    assert partition(links) == partition(want)


def test_bounds():
    with pytest.raises(ValueError):
        ngram_join.jaccard_components(None, 3, Fraction(1, 2))


def test_empty(spark):
    none = with_place(spark.createDataFrame([], "doc_id LONG, text STRING"))
    assert ngram_join.jaccard_components(none, 3, Fraction(9, 10)).collect() == []


def test_components(spark, rows):
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100)] + [(200, i) for i in range(201, 230)]
    links += [tuple(draw.sample(range(300, 400), 2)) for _ in range(60)]
    frame = spark.createDataFrame(links, "u LONG, v LONG")
    root = roots({node for pair in links for node in pair}, links)
    least = {}
    for node, r in root.items():
        least[r] = min(least.get(r, node), node)
    assert rows(components(frame)) == sorted(((n, least[r]) for n, r in root.items()), key=repr)
