import json

import pytest

from touchline.schemas import GAME_MESSAGE, as_struct
from touchline.streaming import games as live

RAW = "id BIGINT, team1 STRING, team2 STRING, score STRING, venue STRING, seq BIGINT"


def land(spark, folder, name, rows):
    """One landed JSON file."""
    path = folder / name
    path.write_text("\n".join(json.dumps(dict(zip([f.name for f in as_struct(RAW)], r))) for r in rows))


@pytest.fixture
def feed(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    land(spark, folder, "1.json", [(1, "A", "B", "0:0", "S1", 1), (2, "C", "D", "1:0", "S2", 2)])
    land(spark, folder, "2.json", [(1, "A", "B", "1:0", "S1", 3)])
    return folder


def source(spark, feed):
    return live.file_source(spark, str(feed), RAW, "json", files_per_batch=1)


def run(stream, tmp_path, mode="append"):
    live.write_batches(
        stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), output_mode=mode
    ).awaitTermination()


def test_messages(spark, feed, tmp_path, rows):
    messages = live.to_messages(source(spark, feed))
    run(messages, tmp_path)
    stored = live.read_batches(spark, str(tmp_path / "out"), messages.schema)
    assert json.loads(stored.orderBy("value").first().value) == {"id": 1, "team1": "A", "team2": "B", "score": "0:0"}
    assert rows(live.read_messages(stored, GAME_MESSAGE)) == [
        (1, "A", "B", "0:0"), (1, "A", "B", "1:0"), (2, "C", "D", "1:0"),
    ]


def test_envelopes_decode_bytes(spark, rows):
    messages = spark.createDataFrame([(bytearray("Köln".encode()),)], "value BINARY")
    assert rows(live.envelopes(messages)) == [("Köln",)]


def test_restart_adds_nothing_twice(spark, feed, tmp_path, rows):
    projected = live.project_games(source(spark, feed))
    for _ in range(2):
        run(projected, tmp_path)
    stored = live.read_batches(spark, str(tmp_path / "out"), projected.schema)
    assert stored.count() == 3
    land(spark, feed, "3.json", [(3, "E", "F", "0:0", "S3", 4)])
    run(projected, tmp_path)
    again = live.read_batches(spark, str(tmp_path / "out"), projected.schema)
    assert rows(again, "id") == [(1,), (1,), (2,), (3,)]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = live._batch_writer(str(tmp_path / "out"), "parquet")
    for _ in range(2):
        write(spark.range(5), 7)
    assert live.read_batches(spark, str(tmp_path / "out"), "id BIGINT").count() == 5


def test_latest_state(spark, feed, tmp_path, rows):
    latest = live.latest_games(source(spark, feed), ["seq"])
    run(latest, tmp_path, "update")
    updates = live.read_batches(spark, str(tmp_path / "out"), latest.schema)
    assert rows(live.newest_state(updates), "id", "score") == [(1, "1:0"), (2, "1:0")]
    land(spark, feed, "3.json", [(2, "C", "D", "1:1", "S2", 9), (1, "A", "B", "9:9", "S1", 2)])  # the second is late
    run(latest, tmp_path, "update")
    updates = live.read_batches(spark, str(tmp_path / "out"), latest.schema)
    assert rows(live.newest_state(updates), "id", "score") == [(1, "1:0"), (2, "1:1")]


def test_kept_state(spark, feed, tmp_path, rows):
    stream, target = source(spark, feed), str(tmp_path / "state")
    assert live.read_state(spark, target, RAW).count() == 0
    live.keep_latest(stream, target, str(tmp_path / "checkpoint"), ["seq"]).awaitTermination()
    assert rows(live.read_state(spark, target, RAW), "id", "score") == [(1, "1:0"), (2, "1:0")]
    land(spark, feed, "3.json", [(2, "C", "D", "1:1", "S2", 9), (1, "A", "B", "9:9", "S1", 2)])  # the second is late
    for _ in range(2):  # the second time as after a run that ended before its commit
        live.keep_latest(stream, target, str(tmp_path / "checkpoint"), ["seq"]).awaitTermination()
        assert rows(live.read_state(spark, target, RAW), "id", "score") == [(1, "1:0"), (2, "1:1")]
        live.forget_commit(spark, str(tmp_path / "checkpoint"), 2)


def test_uncommitted_batch_is_repeated(spark, feed, tmp_path):
    projected = live.project_games(source(spark, feed))
    run(projected, tmp_path)
    live.forget_commit(spark, str(tmp_path / "checkpoint"), 1)
    assert not (tmp_path / "checkpoint" / "commits" / "1").exists()
    run(projected, tmp_path)
    assert (tmp_path / "checkpoint" / "commits" / "1").exists()
    assert live.read_batches(spark, str(tmp_path / "out"), projected.schema).count() == 3


def test_stream_equals_batch(spark, feed, tmp_path, rows):
    batch = spark.read.schema(RAW).json(str(feed))
    projected = live.project_games(source(spark, feed))
    run(projected, tmp_path)
    stored = live.read_batches(spark, str(tmp_path / "out"), projected.schema).drop("batch_id")
    assert rows(stored) == rows(live.project_games(batch))
    state = live.latest_games(batch, ["seq"])
    assert rows(state, "id", "score") == [(1, "1:0"), (2, "1:0")]


def test_kafka_options():
    assert live.kafka_source_options("host:9092", group="g") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "sports_games", "startingOffsets": "earliest",
        "kafka.group.id": "g",
    }


def test_missing_connector_is_reported(spark):
    with pytest.raises(Exception, match="kafka"):
        live.kafka_source(spark, "host:9092")


def test_documents_as_json_lines(spark, feed, tmp_path, rows):
    documents = live.envelopes(live.to_messages(source(spark, feed)))
    live.write_batches(
        documents, str(tmp_path / "docs"), str(tmp_path / "checkpoint"), file_format="json"
    ).awaitTermination()
    stored = live.read_batches(spark, str(tmp_path / "docs"), "value STRING", "json")
    assert stored.count() == 3 and '"team1":"C"' in stored.orderBy("value").collect()[-1].value
