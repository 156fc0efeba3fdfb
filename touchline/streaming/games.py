"""Live games: source stream → projected messages → documents and latest game state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.streaming.stores import BatchStore, StateStore

TOPIC = "sports_games"
MESSAGE_FIELDS = ("id", "team1", "team2", "score")


def kafka_source_options(servers: str, topic: str = TOPIC, group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_source(
    spark: SparkSession, servers: str, topic: str = TOPIC, group: str | None = None, **options: str
) -> DataFrame:
    """Messages of a topic from the earliest offset; the checkpoint remembers what was read."""
    settings = kafka_source_options(servers, topic, group) | options
    return spark.readStream.format("kafka").options(**settings).load()


def file_source(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Landed files as a stream."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def project_games(games: DataFrame) -> DataFrame:
    """The four fields of a game message."""
    return games.select(*MESSAGE_FIELDS)


def to_messages(games: DataFrame) -> DataFrame:
    """Projected games as JSON text in ``value``, the shape a topic takes."""
    return project_games(games).select(F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value"))


def envelopes(messages: DataFrame) -> DataFrame:
    """Message bytes as UTF-8 text documents {value}."""
    return messages.select(F.col("value").cast("string").alias("value"))


def read_messages(messages: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Message text parsed back into game columns."""
    return envelopes(messages).select(F.from_json("value", schema).alias("g")).select("g.*")


def latest_games(games: DataFrame, order: Sequence[str], key: str = "id") -> DataFrame:
    """The newest row of each game; state is one row per game and updates merge before the shuffle."""
    newest = F.max_by(F.struct(*games.columns), F.struct(*order)).alias("latest")
    return games.groupBy(F.col(key).alias("_game")).agg(newest).select("latest.*")


def _batch_writer(target: str, file_format: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        BatchStore(batch.sparkSession, target, batch.schema, file_format).add(batch, batch_id)

    return write


def write_batches(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    file_format: str = "parquet",
    output_mode: str = "append",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start adding each batch to the batch store at ``target``; a repeated batch adds nothing.

    ``target`` and ``checkpoint`` belong together: batch numbers restart with a new checkpoint.
    """
    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(_batch_writer(target, file_format))
        .start()
    )


def read_batches(spark: SparkSession, target: str, schema: str | T.StructType, file_format: str = "parquet") -> DataFrame:
    """All rows committed so far, with their ``batch_id``; empty before the first batch."""
    return BatchStore(spark, target, schema, file_format).read()


def newest_state(updates: DataFrame, key: str = "id") -> DataFrame:
    """The state after the last batch out of per-batch updates."""
    columns = [c for c in updates.columns if c != "batch_id"]
    newest = F.max_by(F.struct(*columns), F.col("batch_id")).alias("latest")
    return updates.groupBy(F.col(key).alias("_key")).agg(newest).select("latest.*")


def _merger(target: str, key: str, order: Sequence[str], buckets: int) -> Callable[[DataFrame, int], None]:
    def merge(batch: DataFrame, batch_id: int) -> None:
        store = StateStore(batch.sparkSession, target, batch.schema, key, buckets)
        store.merge(batch, batch_id, lambda rows: latest_games(rows, order, key))

    return merge


def keep_latest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    order: Sequence[str],
    key: str = "id",
    buckets: int = 16,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start keeping the newest row of each game in the state store at ``target``: one row per game, in buckets by key.

    Each batch is merged into the buckets its games are in and committed as a new version; readers see the newest
    version alone, not the updates before it. ``target`` and ``checkpoint`` belong together.
    """
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(_merger(target, key, order, buckets))
        .start()
    )


def read_state(spark: SparkSession, target: str, schema: str | T.StructType) -> DataFrame:
    """The newest committed state; empty before the first batch."""
    return StateStore(spark, target, schema).read()


def forget_commit(spark: SparkSession, checkpoint: str, batch_id: int) -> None:
    """Take back the commit of a batch, as if the run had ended after writing it: the next start repeats it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{batch_id}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def kafka_sink(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Start sending ``value`` rows to a topic."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
