"""Tables a stream writes batch by batch: all batches, or the latest row of each key.

Both keep their files in folders of ``data`` that are written once and never changed, and a commit log that says which
of them are in force. Batches come in the order of their numbers; one that is committed already is not written again, so
a stream that was stopped anywhere can be started again. Folders of the last few commits stay for readers that are
still at them; what no such commit names is removed, leftovers of writers that died included.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import as_struct
from touchline.sinks.commits import CommitLog

DATA = "data"
KEEP = 3  # commits whose files stay
FAN = 8  # pieces of one level that are merged into one of the next

Schema = str | T.StructType


class _Store:
    def __init__(self, spark: SparkSession, target: str, schema: Schema, file_format: str = "parquet"):
        self.spark, self.target, self.schema, self.file_format = spark, target.rstrip("/"), as_struct(schema), file_format
        self.log = CommitLog(spark, self.target)

    def _folder(self, label: object) -> str:
        return f"{DATA}/{label}-{uuid.uuid4().hex}"

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).format(self.file_format)
        return reader.load([f"{self.target}/{folder}" for folder in folders])

    def last_batch(self) -> int | None:
        newest = self.log.newest()
        return newest and newest["batch"]

    def _clean(self, named: Callable[[dict], Sequence[str]]) -> None:
        """Remove the data folders that none of the last commits names."""
        kept = {folder.split("/")[1] for commit in self.log.forget(KEEP) for folder in named(commit)}
        gone = [name for name in self.log.files.names(DATA) if name not in kept]
        self.log.files.delete(f"{DATA}/{name}" for name in gone)


class BatchStore(_Store):
    """The rows of all batches, with the number of the batch each came in.

    A batch is one piece. Once ``FAN`` pieces of a level are there, they are merged into one of the next, rows and batch
    numbers unchanged: n batches are some FAN · log n pieces, and a row is written log n times.
    """

    def __init__(self, spark: SparkSession, target: str, schema: Schema, file_format: str = "parquet"):
        fields = [field for field in as_struct(schema).fields if field.name != "batch_id"]
        super().__init__(spark, target, T.StructType([*fields, T.StructField("batch_id", T.LongType())]), file_format)

    def pieces(self) -> list[dict]:
        newest = self.log.newest()
        return newest["pieces"] if newest else []

    def read(self) -> DataFrame:
        return self._read([piece["folder"] for piece in self.pieces()])

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Write and commit a batch, unless it is there, and merge pieces that have become many."""
        last = self.last_batch()
        if last is None or batch_id > last:
            folder = self._folder(batch_id)
            rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            rows.write.format(self.file_format).save(f"{self.target}/{folder}")
            self._publish(batch_id, [*self.pieces(), {"folder": folder, "from": batch_id, "to": batch_id, "level": 0}])
        self._merge()
        self._clean(lambda commit: [piece["folder"] for piece in commit["pieces"]])

    def _publish(self, batch_id: int, pieces: list[dict]) -> None:
        self.log.publish({"batch": batch_id, "pieces": pieces})

    def _merge(self) -> None:
        while True:
            pieces = self.pieces()
            # Levels fall from the oldest piece to the newest, so pieces of one level are neighbours.
            full = [level for level in {p["level"] for p in pieces} if sum(p["level"] == level for p in pieces) >= FAN]
            if not full:
                return
            level = min(full)
            some = [piece for piece in pieces if piece["level"] == level]
            folder = self._folder(f"{some[0]['from']}-{some[-1]['to']}")
            rows = self._read([piece["folder"] for piece in some]).hint("rebalance")  # files of the advisory size
            rows.write.format(self.file_format).save(f"{self.target}/{folder}")
            merged = {"folder": folder, "from": some[0]["from"], "to": some[-1]["to"], "level": level + 1}
            at = pieces.index(some[0])
            self._publish(pieces[-1]["to"], [*pieces[:at], merged, *pieces[at + len(some) :]])


_BUCKET = "bucket"


class StateStore(_Store):
    """One row per key, in buckets by key; each commit is a version of the whole state.

    A batch writes the buckets its keys are in anew, beside the files in force, and its commit names the folder of every
    bucket. Until then readers see the version before; a batch that is repeated starts from that version too.
    """

    def __init__(self, spark: SparkSession, target: str, schema: Schema, key: str = "id", buckets: int = 16):
        super().__init__(spark, target, schema)
        self.key, self.buckets = key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def version(self, number: int | None = None) -> dict[str, str]:
        """The folder of each bucket in the newest version, or in one of the last few by its commit number."""
        commit = self.log.newest() if number is None else self.log.read(number)
        return commit["folders"] if commit else {}

    def read(self, number: int | None = None) -> DataFrame:
        return self._read(list(self.version(number).values()))

    def merge(self, batch: DataFrame, batch_id: int, newest: Callable[[DataFrame], DataFrame]) -> None:
        """Commit the state after a batch: ``newest`` keeps one row per key of old and new rows."""
        last = self.log.newest()
        if last and last["buckets"] != self.buckets:
            raise ValueError(f"{self.target} has {last['buckets']} buckets")
        if last is None or batch_id > last["batch"]:
            folders = last["folders"] if last else {}
            touched = [str(row[0]) for row in batch.select(self._bucket()).distinct().collect()]  # at most all buckets
            kept = self._read([folders[bucket] for bucket in touched if bucket in folders])
            rows = newest(batch.select(*kept.columns).unionByName(kept)).withColumn(_BUCKET, self._bucket())
            folder = self._folder(batch_id)
            rows.hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.target}/{folder}")
            written = {bucket: f"{folder}/{_BUCKET}={bucket}" for bucket in touched}
            self.log.publish({"batch": batch_id, "buckets": self.buckets, "folders": {**folders, **written}})
        self._clean(lambda commit: list(commit["folders"].values()))
