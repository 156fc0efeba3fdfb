"""Numbering and paged lists against brute force, with one key holding most rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from touchline.operators.numbering import LOCAL_BITS, number_by_block, number_within
from touchline.operators.pages import _runs, ordered_text, paged_list


def skewed(spark, n=3000):
    """Two thirds of the rows have key 0; values repeat, so copies agree in every column."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 7).alias("k"),
        ((F.col("id") * 7919) % 101).alias("v"),
    )


def test_number_within_matches_brute_force(spark):
    df = skewed(spark)
    numbered = number_within(df, ["k"], ["v"], "n").collect()
    groups = defaultdict(list)
    for row in numbered:
        groups[row.k].append((row.n, row.v))
    assert sum(map(len, groups.values())) == 3000
    for entries in groups.values():
        entries.sort()
        assert [n for n, _ in entries] == list(range(len(entries)))
        assert [v for _, v in entries] == sorted(v for _, v in entries)


def test_hot_copies_are_spread_over_tasks(spark):
    """Rows equal in group and order still go to several range partitions."""
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit(1).alias("v"))
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(4, "k", "v", "_tie")
    assert placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2000
    numbered = number_within(df, ["k"], ["v"], "n")
    assert sorted(r.n for r in numbered.select("n").collect()) == list(range(4000))


def test_number_within_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "k string, v int")
    found = {(r.k, r.v): r.n for r in number_within(df, ["k"], ["v"], "n").collect()}
    assert found == {(None, 1): 0, (None, 2): 1, ("a", 5): 0}


def test_number_by_block(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") * 37).alias("v"))
    for block in (64, 1 << 20):
        found = number_by_block(df, ["k"], "v", "n", block).collect()
        for key in (0, 1):
            ordered = sorted((r.v, r.n) for r in found if r.k == key)
            assert [n for _, n in ordered] == list(range(250))


def test_paged_list_is_whole_and_bounded(spark):
    df = skewed(spark)
    expected = defaultdict(list)
    for row in df.collect():
        expected[row.k].append(row.v)
    pages = paged_list(df, ["k"], ["v"], "v", "values", page=100).collect()
    found = defaultdict(list)
    for row in sorted(pages, key=lambda r: (r.k, r.part)):
        assert len(row["values"]) <= 100 and row.n_rows == len(row["values"])
        found[row.k] += row["values"]
    assert found == {k: sorted(v) for k, v in expected.items()}
    assert max(r.part for r in pages if r.k == 0) >= 20


@pytest.mark.parametrize("page", [1, 7, 10_000])
@pytest.mark.parametrize("unique", [True, False])
def test_pages_against_brute_force(spark, page, unique):
    """NULL keys, orders and values, keys of one and of many rows; copies unless rows are said to be unique."""
    draw = random.Random(page)
    data = [
        (draw.choice([None, 1, 2, 3, *range(10, 60)]), draw.choice([None, *range(5)]), draw.choice([None, "a", "b", "c"]))
        for _ in range(800)
    ]
    data = list(set(data)) if unique else data + [(1, 2, "x")] * 300 + [(70, None, None)] * 20
    df = spark.createDataFrame(data, "k INT, o INT, v STRING").repartition(6)
    groups = defaultdict(list)
    for k, o, v in data:
        groups[k].append((o is not None, o, v is not None, v))
    expected = {}
    for k, entries in groups.items():
        entries.sort(key=lambda e: (e[0], e[1] or 0, e[2], e[3] or ""))
        for at in range(0, len(entries), page):
            some = entries[at : at + page]
            expected[k, at // page] = len(some), [v for *_, v in some if v is not None]
    found = paged_list(df, ["k"], ["o"], "v", "values", page=page, unique=unique).collect()
    assert len(found) == len(expected)
    assert {(row.k, row.part): (row.n_rows, row["values"]) for row in found} == expected


def test_hot_key_and_copies_are_spread_over_runs(spark):
    """One key, and copies of one row, fill several tasks; no run is longer than a page."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few rows are one task otherwise
    for column in (F.col("id"), F.lit(1)):
        df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), column.alias("v"))
        runs = _runs(df, ["k"], ["v"], "v", 1000, False).collect()
        tasks = defaultdict(int)
        for row in runs:
            assert row["_n"] <= 1000 and len(row["_values"]) == row["_n"]
            tasks[row["_from"] >> LOCAL_BITS] += row["_n"]
        assert sum(tasks.values()) == 40_000 and len(tasks) > 1 and max(tasks.values()) < 30_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ordered_text(spark, rows):
    goals = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 9, None)], "m int, id int, text string")
    assert rows(ordered_text(goals, ["m"], ["id"], "text", "text")) == [(1, 0, "a,b"), (2, 0, None)]


def test_ordered_text_is_not_truncated(spark):
    goals = spark.range(2000).select(F.lit(1).alias("m"), "id", F.lit("0123456789").alias("text"))
    assert len(ordered_text(goals, ["m"], ["id"], "text", "text").first()["text"]) == 2000 * 11 - 1


def test_unique_order_needs_no_tie(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    found = number_within(df, ["k"], ["id"], "n", unique=True).collect()
    assert all(r.n == r.id // 3 for r in found)
