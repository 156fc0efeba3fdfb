"""Token rollups against sums over the documents that are left."""

import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import connect, difference
from touchline.llm import queries, sql, token_counts
from touchline.session import scratch_path

TEXTS = [(1, "a", "en", "two words"), (2, "a", "en", ""), (3, None, "de", None), (4, "b", None, " é \n\t x"), (4, "b", None, "again")]


@pytest.fixture
def frame(spark):
    rows = [(*row, 5, "z") for row in TEXTS]
    return spark.createDataFrame(rows, "doc_id LONG, source STRING, lang STRING, text STRING, n_tokens INT, version STRING")


def expected(texts):
    out = {}
    for _, source, lang, text in texts:
        for version, n in (("words-1", len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))), ("bytes-1", len((text or "").encode()))):
            docs, tokens = out.get((source, lang, version), (0, 0))
            out[source, lang, version] = docs + 1, tokens + n
    return sorted(((*key, *value) for key, value in out.items()), key=repr)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_token_counts"])
def test_queries_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert difference(queries.queries()[name](spark, sf), connect(sf), sql.oracle_sql()[name]) is None


def test_batches(spark, rows, frame):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    assert rollup.totals().collect() == []
    counts = token_counts.counted(frame)
    assert rollup.commit("load", token_counts.inserts(counts))
    assert rows(rollup.totals()) == expected(TEXTS)
    assert not rollup.commit("load", token_counts.inserts(counts))
    assert rows(rollup.totals()) == expected(TEXTS)
    gone = counts.filter("doc_id IN (2, 3)")
    assert rollup.commit("gone", token_counts.deletes(gone))
    left = [row for row in TEXTS if row[0] not in (2, 3)]
    assert rows(rollup.totals()) == expected(left)
    old = counts.filter("doc_id = 1")
    new = token_counts.counted(frame.filter("doc_id = 1").withColumn("source", F.lit("c")).withColumn("text", F.lit("x y z")))
    assert rollup.commit("new", token_counts.revisions(old, new))
    assert rows(rollup.totals()) == expected([(1, "c", "en", "x y z"), *left[1:]])
    assert rollup.commit("none", token_counts.inserts(counts.limit(0)))
    assert rows(rollup.totals()) == expected([(1, "c", "en", "x y z"), *left[1:]])


def test_unfinished_batches_do_not_count(spark, frame, monkeypatch):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    counts = token_counts.inserts(token_counts.counted(frame))
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", None)
        broken.setattr(rollup, "commits", lambda: counts.limit(0).select(F.lit("").alias("batch")))
        with pytest.raises(TypeError):
            rollup.commit("load", counts)
    assert rollup.totals().collect() == []
    assert rollup.commit("load", counts)
    assert rollup.totals().count() == 6


def test_tokenizer_of_a_file(spark, frame):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = token_counts.counted_by_file(frame, "word_bpe_49k", path).collect()
    want = Counter((row[0], len(tokenizer.encode(row[3] or "", add_special_tokens=False).ids)) for row in TEXTS)
    assert Counter((row["doc_id"], row["n_tokens"]) for row in rows) == want


def test_query_with_null_and_repeated_ids(spark, tmp_path):
    """As its SQL: documents without an id count, a row that repeats with its id is a copy like any other."""
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    documents = [
        (None, "a b", "en", "s"), (None, "c", "en", "s"), (1, "d e#", "en", "s"), (1, "d e#", "en", "s"), (2, "a b", "en", "s"),
        (None, None, None, None), (3, "", None, None),
    ]
    spark.createDataFrame([(*row, 0) for row in documents], schema).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(queries.op4_token_counts(spark, str(tmp_path)), connection, sql.OP4) is None
