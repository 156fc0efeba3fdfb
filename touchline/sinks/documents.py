"""Published sets of JSON documents, each whole or not there.

A set is all blocks with one key value, a season say. Its blocks are written to a new folder first; a manifest, written
last, names the folder of every set with the number of its blocks and entries and a checksum of its text. Readers go by
the manifest: a set that was being written when its writer died isn't in it, and one whose files don't agree with it is
refused. Publishing some sets leaves the others as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sinks.commits import CommitLog
from touchline.sources.lake import partition_folder

_DATA = "data"
_KEEP = 3  # manifests whose files stay for readers


class BrokenSetError(ValueError):
    """A published set whose files aren't those that were published."""


def _sums(rows: DataFrame) -> DataFrame:
    """(set, blocks, entries, checksum) of written blocks; the checksum doesn't depend on their order."""
    text = F.concat_ws("\u0001", F.col("entries").cast("string"), "value")
    return rows.groupBy("set").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.sum("entries").alias("entries"),
        F.sum(F.xxhash64(text).cast("decimal(38,0)")).cast("string").alias("checksum"),
    )


class DocumentSets:
    """The published sets below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, self.path)

    def manifest(self) -> dict[str, dict]:
        """Set to folder, blocks, entries and checksum."""
        newest = self.log.newest()
        return newest["sets"] if newest else {}

    def _blocks(self, folders: Sequence[str]) -> DataFrame:
        schema = "entries BIGINT, value STRING, set STRING"
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{_DATA}")
        return reader.json([f"{self.path}/{folder}" for folder in folders])

    def publish(self, documents: DataFrame, key: str, column: str = "document", entries: str = "n_entries") -> list[str]:
        """Put the sets ``documents`` has blocks of in place of those with the same key; returns their names.

        What is counted and summed is what was read back from the written files.
        """
        folder = f"{_DATA}/run={uuid.uuid4().hex}"
        blocks = documents.select(
            F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("set"), F.col(entries).cast("bigint").alias("entries"), F.col(column).alias("value")
        )
        blocks.hint("rebalance", F.col("set")).write.partitionBy("set").json(f"{self.path}/{folder}")
        written = [row.asDict() for row in _sums(self._blocks([folder])).collect()]  # a row per set
        new = {row.pop("set"): row for row in written}
        for name, row in new.items():
            row["folder"] = f"{folder}/{partition_folder([('set', name)])}"
        sets = self.manifest() | new
        self.log.publish({"sets": sets})
        kept = {entry["folder"].split("/")[1] for commit in self.log.forget(_KEEP) for entry in commit["sets"].values()}
        self.log.files.delete(f"{_DATA}/{name}" for name in self.log.files.names(_DATA) if name not in kept)
        return sorted(new)

    def read(self, *names: object, verify: bool = True) -> DataFrame:
        """(set, value): the blocks of the named sets, or of all; sets that aren't published are a KeyError."""
        manifest = self.manifest()
        wanted = {str(name): manifest[str(name)] for name in names} if names else manifest
        rows = self._blocks([entry["folder"] for entry in wanted.values()])
        if verify:
            found = {row["set"]: row.asDict() for row in _sums(rows).collect()}
            for name, entry in wanted.items():
                sums = found.get(name, {})
                if any(sums.get(field) != entry[field] for field in ("blocks", "entries", "checksum")):
                    raise BrokenSetError(f"set {name} of {self.path} is not the one that was published")
        return rows.select("set", "value")
