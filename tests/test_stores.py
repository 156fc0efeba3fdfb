"""Stream stores: versions of the latest state, merged batches, and writers that die at any point."""

from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from touchline.sinks.commits import CommitLog
from touchline.streaming import games as live
from touchline.streaming import stores
from touchline.streaming.stores import BatchStore, StateStore

SCHEMA = "id BIGINT, score STRING, seq BIGINT"


class Killed(Exception):
    pass


def newest(rows):
    return live.latest_games(rows, ["seq"])


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def die_at(monkeypatch, call):
    """Let the given commit, counted from now, fail before anything of it is written."""
    publish, calls = CommitLog.publish, []

    def dying(self, content):
        calls.append(content)
        if len(calls) == call:
            raise Killed
        return publish(self, content)

    monkeypatch.setattr(CommitLog, "publish", dying)


def test_state_is_that_before_a_batch_until_its_commit(spark, tmp_path, rows, monkeypatch):
    store = StateStore(spark, str(tmp_path), SCHEMA, buckets=4)
    store.merge(batch(spark, *[(i, "0:0", 0) for i in range(20)]), 0, newest)
    before = rows(store.read())
    with monkeypatch.context() as patch:
        die_at(patch, 1)
        with pytest.raises(Killed):
            store.merge(batch(spark, (3, "1:0", 5), (21, "0:0", 5)), 1, newest)
    assert rows(store.read()) == before and len(list((tmp_path / "data").iterdir())) == 2
    # The batch is repeated, from the version before it; what the dead writer left is removed.
    store.merge(batch(spark, (3, "1:0", 5), (21, "0:0", 5)), 1, newest)
    assert rows(store.read()) == sorted([*(r for r in before if r[0] != 3), (3, "1:0", 5), (21, "0:0", 5)], key=repr)
    assert len(list((tmp_path / "data").iterdir())) == 2


def test_committed_batch_is_not_merged_again(spark, tmp_path, rows):
    store = StateStore(spark, str(tmp_path), SCHEMA)
    for number in (0, 1, 1, 0):
        store.merge(batch(spark, (1, f"{number}:0", number)), number, newest)
    assert rows(store.read()) == [(1, "1:0", 1)] and store.log.numbers() == [0, 1]


def test_only_touched_buckets_are_written_and_old_versions_stay_a_while(spark, tmp_path, rows):
    store = StateStore(spark, str(tmp_path), SCHEMA, buckets=8)
    store.merge(batch(spark, *[(i, "0:0", 0) for i in range(50)]), 0, newest)
    first = store.version()
    for number in range(1, 6):
        store.merge(batch(spark, (7, f"{number}:0", number)), number, newest)
    changed = {bucket for bucket, folder in store.version().items() if folder != first[bucket]}
    assert len(changed) == 1 and store.read().count() == 50
    assert rows(store.read(4).where("id = 7")) == [(7, "4:0", 4)]  # one of the last versions
    assert store.log.numbers() == [3, 4, 5]
    folders = {path.name for path in (tmp_path / "data").iterdir()}
    assert len(folders) == 1 + stores.KEEP


def test_number_of_buckets_is_fixed(spark, tmp_path):
    StateStore(spark, str(tmp_path), SCHEMA, buckets=4).merge(batch(spark, (1, "", 0)), 0, newest)
    with pytest.raises(ValueError, match="4 buckets"):
        StateStore(spark, str(tmp_path), SCHEMA, buckets=8).merge(batch(spark, (1, "", 0)), 1, newest)


@pytest.fixture
def feed(spark, tmp_path):
    """Six files; every file changes half of the games of the one before."""
    path = tmp_path / "feed"
    for number in range(6):
        games = batch(spark, *[(number * 5 + i, f"{number}:{i}", number) for i in range(10)])
        games.coalesce(1).write.mode("append").json(str(path))
    return live.file_source(spark, str(path), SCHEMA, "json", files_per_batch=1)


@pytest.mark.parametrize("call", [1, 3, 6])
def test_killed_stream_loses_no_game(spark, feed, tmp_path, rows, monkeypatch, call):
    target, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")

    def run():
        live.keep_latest(feed, target, checkpoint, ["seq"], buckets=4).awaitTermination()

    with monkeypatch.context() as patch:
        die_at(patch, call)
        with pytest.raises(StreamingQueryException):
            run()
    seen = rows(live.read_state(spark, target, SCHEMA))
    assert len(seen) == (0 if call == 1 else 5 * call)  # all games of the batches before, each once
    run()
    live.forget_commit(spark, checkpoint, 5)  # as if it had died between its commit and the stream's
    run()
    assert rows(live.read_state(spark, target, SCHEMA)) == sorted(
        [(i, f"{n}:{i - 5 * n}", n) for n in range(6) for i in range(5 * n, 5 * n + (10 if n == 5 else 5))], key=repr
    )


def test_hundred_batches_are_few_files(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path), SCHEMA)
    for number in range(100):
        store.add(spark.range(3).select("id", F.lit("0:0").alias("score"), F.lit(number).cast("bigint").alias("seq")), number)
    assert len(store.pieces()) <= 2 * stores.FAN and len(store.read().inputFiles()) <= 3 * stores.FAN
    assert len(list(Path(tmp_path).rglob("*.parquet"))) < 100
    counted = {row["batch_id"]: row["count"] for row in store.read().groupBy("batch_id").count().collect()}
    assert counted == {number: 3 for number in range(100)}
    assert store.read().where("batch_id <> seq").count() == 0
    before = store.pieces()
    for number in (0, 50, 99):
        store.add(spark.range(7).selectExpr("id", "'' AS score", "id AS seq"), number)
    assert store.pieces() == before and store.read().count() == 300


@pytest.mark.parametrize("call", [8, 9])
def test_killed_before_or_in_a_merge(spark, tmp_path, monkeypatch, call):
    """Commit 8 is that of the eighth batch, commit 9 that of the pieces merged after it."""
    store = BatchStore(spark, str(tmp_path), SCHEMA)
    with monkeypatch.context() as patch:
        die_at(patch, call)
        with pytest.raises(Killed):
            for number in range(8):
                store.add(batch(spark, (number, "", 0)), number)
    assert store.read().count() == call - 1
    for number in (7, 8):  # the stream repeats the batch it could not commit
        store.add(batch(spark, (number, "", 0)), number)
    assert sorted(row.id for row in store.read().collect()) == list(range(9))
    assert [piece["level"] for piece in store.pieces()] == [1, 0]


def test_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.newest() is None and log.numbers() == []
    assert [log.publish({"a": i}) for i in range(12)] == list(range(12))
    assert log.newest() == {"a": 11, "number": 11}
    assert log.forget(2) == [{"a": 10}, {"a": 11}] and log.numbers() == [10, 11]
    with pytest.raises(FileExistsError):
        log.files.create("_commits/11.json", "{}")
