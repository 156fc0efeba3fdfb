"""Exact dedup in batches against a dictionary."""

import hashlib
import random
import re
import subprocess
import sys
import uuid
from pathlib import Path

import pytest

from touchline.llm import queries
from touchline.llm.exact_dedup import DigestIndex
from touchline.session import scratch_path


@pytest.fixture
def index(spark):
    name = f"digests_{uuid.uuid4().hex}"
    yield DigestIndex(spark, name, buckets=4, path=scratch_path(spark, "digests"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def expected(batch, known):
    """Decisions on a batch, and what is known after it."""
    groups = {}
    for doc_id, text in batch:
        groups.setdefault(digest(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out, after = [], dict(known)
    for key, rows in groups.items():
        best = min(rows)
        fresh = key not in known
        keep = best[3] if fresh else known[key]
        after.setdefault(key, keep)
        left = fresh
        for row in sorted(rows):
            out.append((row[3], keep, len(rows), left and row == best, key))
            left = left and row != best
    return sorted(out, key=repr), after


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def frame(spark, batch):
    rows = [(*row, "d", 1) for row in batch]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, digest STRING, n_chars INT")


def test_batches(spark, index, rows):
    draw = random.Random(1)
    texts = [None, "", " \n", "a b", "ab", "a\tb ", " ab", "é", "long " * 2000, *(f"t{i}" for i in range(9))]
    known = {}
    for size in (40, 0, 25, 25):
        batch = [(draw.choice([None, *range(30)]), draw.choice(texts)) for _ in range(size)]
        want, known = expected(batch, known)
        assert rows(index.ingest(frame(spark, batch)), *COLUMNS) == want
        assert {row["digest"]: row["keep_id"] for row in index.rows().collect()} == known
    assert index.rows().count() == len(known)


def test_index_is_bucketed_and_joined_without_a_shuffle(spark, index):
    index.ingest(frame(spark, [(1, "a"), (2, "b")])).collect()
    details = {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {index.table}").collect()}
    assert details["Num Buckets"] == "4" and "digest" in details["Bucket Columns"] and "digest" in details["Sort Columns"]
    plan = index.unseen(index.rows())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_repeated_batch_keeps_nothing(spark, index, rows):
    batch = [(1, "a"), (2, "a"), (3, "b")]
    assert [row[3] for row in rows(index.ingest(frame(spark, batch)), *COLUMNS)] == [True, False, True]
    again = rows(index.ingest(frame(spark, batch)), *COLUMNS)
    assert [row[:2] for row in again] == [(1, 1), (2, 1), (3, 3)] and not any(row[3] for row in again)


def test_a_named_batch_decides_again_as_before(spark, index, rows, monkeypatch):
    """After a crash behind the append, or before it, and when all went well; other batches still find its digests."""
    first, second = [(1, "a"), (2, "a"), (3, "b")], [(4, "b"), (5, "c"), (None, "c"), (6, "d")]
    want = rows(index.ingest(frame(spark, first), "one"), *COLUMNS)
    assert [row[3] for row in want] == [True, False, True]
    with monkeypatch.context() as patch:
        patch.setattr(DigestIndex, "append", lambda self, new, batch: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.ingest(frame(spark, second), "two")
    decided = rows(index.ingest(frame(spark, second), "two"), *COLUMNS)
    assert sorted(row[0] for row in decided if row[3]) == [5, 6]
    for batch, name, before in ((first, "one", want), (second, "two", decided), (first, "one", want)):
        assert rows(index.ingest(frame(spark, batch), name), *COLUMNS) == before
    assert index.rows().count() == 4
    grown = rows(index.ingest(frame(spark, [*first, (9, "e")]), "one"), "doc_id", "kept")  # what the crash left out
    assert grown == [(1, True), (2, False), (3, True), (9, True)] and index.rows().count() == 5


OTHER = """
import sys
from touchline.llm.exact_dedup import DigestIndex
from touchline.session import build_session
spark = build_session("other", "local[2]", spark__sql__warehouse__dir=sys.argv[2], spark__sql__shuffle__partitions="2")
frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id LONG, text STRING")
assert DigestIndex(spark, "mine", buckets=4, path=sys.argv[1]).ingest(frame).filter("kept").count() == 3
"""


def test_another_session_finds_the_index(spark, index, rows, tmp_path):
    root = Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", OTHER, index.path, str(tmp_path)], cwd=root, check=True, timeout=120)
    with pytest.raises(ValueError):
        DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=3, path=index.path).rows()
    found = rows(index.ingest(frame(spark, [(7, "a"), (8, "d"), (9, " b")])), "doc_id", "keep_id", "kept")
    assert found == [(7, 1, False), (8, 8, True), (9, 2, False)]
    assert index.rows().count() == 4


def test_query_decides_rows_by_the_index(spark, rows, tmp_path, monkeypatch):
    batch = [(5, "a b"), (2, "ab"), (1, "ab"), (4, "a  b"), (3, "a  b"), (6, None), (7, "longer text"), (8, "long text")]
    frame(spark, batch).write.parquet(f"{tmp_path}/documents.parquet")
    unseen, left = DigestIndex.unseen, []

    def counted(self, found, known=None):
        out = unseen(self, found, known)
        left.append((found.count(), out.count()))
        return out

    monkeypatch.setattr(DigestIndex, "unseen", counted)
    assert rows(queries.op1_exact_dedup(spark, str(tmp_path)), *COLUMNS) == expected(batch, {})[0]
    assert left and left[0][0] > left[0][1] > 0


def test_names(spark):
    with pytest.raises(ValueError):
        DigestIndex(spark, "x; DROP TABLE y")
