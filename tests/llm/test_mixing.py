"""The mixing schedule: fairness, whole results, order."""

import random
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import mixing, queries
from touchline.llm.rows import with_place
from touchline.session import cut_lineage


@settings(max_examples=200, deadline=None)
@given(slots=st.dictionaries(st.text(max_size=3), st.integers(1, 60), min_size=1, max_size=9))
def test_every_prefix_is_within_one_block(slots):
    plan = mixing.schedule(slots)
    period = sum(slots.values())
    assert sorted(slot for some in plan.values() for slot in some) == list(range(period))
    for name, share in slots.items():
        got = 0
        for slot in range(period):
            assert abs(got - Fraction(share * slot, period)) < 1
            got += slot in set(plan[name])
        for j, slot in enumerate(plan[name]):
            assert j * period // share <= slot < -(-(j + 1) * period // share)


@settings(max_examples=100, deadline=None)
@given(weights=st.dictionaries(st.text(max_size=3), st.floats(0.001, 1e6), min_size=1, max_size=30), period=st.integers(1, 500))
def test_shares(weights, period):
    found = mixing.shares(weights, period)
    assert min(found.values()) >= 1 and sum(found.values()) == max(period, 2 * len(weights))
    with pytest.raises(ValueError):
        mixing.shares({"a": 0.0})


def test_mixed(spark):
    draw = random.Random(4)
    sources = ["a"] * 200 + ["b"] * 100 + ["c"] * 20 + [None] * 60
    table = [(draw.choice([None, *range(150)]), source, None, "x", 3) for source in sources]
    frame = with_place(spark.createDataFrame(table, "doc_id LONG, source STRING, text STRING, slot STRING, position INT").repartition(3))
    weights = {"a": 5.0, "b": 3.0, "c": 1.0, None: 1.0}
    rows = mixing.mixed(frame, weights, block=4, period=20).orderBy("position").collect()
    assert [row["position"] for row in rows] == list(range(len(table)))
    assert Counter((row["doc_id"], row["source"]) for row in rows) == Counter(row[:2] for row in table)
    plan = mixing.schedule(mixing.shares(weights, 20))
    assert [row["slot"] for row in rows] == sorted(row["slot"] for row in rows)
    for row in rows:
        share = len(plan[row["source"]])
        assert row["slot"] == row["block"] // share * 20 + plan[row["source"]][row["block"] % share]
    blocks = Counter((row["source"], row["block"]) for row in rows)
    for source, n in Counter(sources).items():
        assert [blocks[source, i] for i in range(-(-n // 4))] == [min(4, n - 4 * i) for i in range(-(-n // 4))]
    # While all have blocks, each prefix of whole slots is fair.
    until = min(max(row["slot"] for row in rows if row["source"] == source) for source in weights)
    got = Counter()
    for slot in range(until):
        got.update({row["source"] for row in rows if row["slot"] == slot})
        for source in weights:
            assert abs(got[source] - (slot + 1) * len(plan[source]) / 20) < 1


@settings(max_examples=60, deadline=None)
@given(weights=st.lists(st.floats(0.001, 1e6), min_size=1, max_size=40))
def test_every_prefix_is_within_one_block_of_the_exact_weights(weights):
    exact = [Fraction(weight) for weight in weights]
    shares = [weight / sum(exact) for weight in exact]
    got = [0] * len(weights)
    for i, (source, block, slot) in enumerate(mixing.exact_schedule(weights, [600] * len(weights))):
        assert slot == i and block == got[source]
        got[source] += 1
        assert all(abs(n - share * (i + 1)) < 1 for n, share in zip(got, shares))
        if max(got) == 600 or i == 800:
            break


def test_all_blocks_are_placed_after_sources_run_out():
    found = list(mixing.exact_schedule([1e9, 1.0, 3.0], [2, 3, 0]))
    assert sorted(row[:2] for row in found) == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2)]
    assert [row[2] for row in found] == sorted({row[2] for row in found})


def test_mixed_follows_the_target_weights(spark):
    """Many sources beside a hot one: no least share and no rounding to whole slots of a period."""
    sizes = {"hot": 1500, **{f"s{i}": 4 for i in range(1200)}}
    table = [(i, source) for i, source in enumerate(name for name, n in sizes.items() for _ in range(n))]
    frame = with_place(spark.createDataFrame(table, "doc_id LONG, source STRING").repartition(3))
    weights = {name: n**0.5 for name, n in sizes.items()}
    rows = mixing.mixed(frame, weights, block=1).orderBy("position").collect()
    assert sorted(row["doc_id"] for row in rows) == list(range(len(table)))
    share, got = Fraction(weights["hot"]) / sum(map(Fraction, weights.values())), 0
    until = min(max(row["slot"] for row in rows if row["source"] == name) for name in ("hot", "s0", "s1"))
    for i, row in enumerate(rows[: until + 1]):
        got += row["source"] == "hot"
        assert row["slot"] == i and abs(got - share * (i + 1)) < 1


def test_missing_weight_and_empty(spark):
    frame = with_place(spark.createDataFrame([(1, "a", "t")], "doc_id LONG, source STRING, text STRING"))
    with pytest.raises(ValueError):
        mixing.mixed(frame, {"b": 1.0})
    assert mixing.mixed(frame.limit(0), mixing.tempered(frame.limit(0))).collect() == []


def test_files_hold_the_mix(spark):
    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    stored = with_place(cut_lineage(mixing.in_order(documents)))
    assert stored.columns[:-2] == documents.columns
    ids = [row["doc_id"] for row in stored.orderBy("_file", "_at").collect()]
    found = queries.op6_mixing(spark, sf).orderBy("position").collect()
    assert ids == [row["doc_id"] for row in found]
