"""Lake writers.

Rows are rebalanced by their partition columns: a partition's rows meet in few tasks, which keeps files
few, while the adaptive rebalance splits a partition too large for one task.

A write adds its files to their folders under final names; on shared storage tasks put them there, so the driver moves
nothing however many folders there are. All files of a write start with the name of its set. Three small commits lead through it: ``open``
before the first file, ``published`` when all are there, which is the moment the set takes the place of older files in
its folders, and ``clean`` once those are removed. Scans of ``touchline.sources.lake`` hide files of an open set and
files a published one has replaced, so they see the lake before a write or after it, also when its writer has died; the
next writer then finishes or undoes what it finds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import batched

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.sinks.commits import CommitLog
from touchline.sources.lake import (
    MATCH_PARTITION_COLUMNS, PARTITION_COLUMNS, files_of_set, partition_folder, replaced_files,
)

RATING_PARTITION_COLUMNS = ("year", "country", "club", "date", "entity")
MAX_RECORDS_PER_FILE = 10_000_000
_SEEN_LEVELS = 2  # leading partition columns whose folders are looked through for replaced files
_REMOVED_AT_ONCE = 10_000
_KEPT_COMMITS = 3


def write_entity(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One unpartitioned gzip Parquet entity."""
    df.write.mode(mode).option("compression", "gzip").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = PARTITION_COLUMNS,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    sort_by: Sequence[str] = (),
    covers: str | None = None,
) -> None:
    """Gzip Parquet in hive folders; partitions present in ``df`` are replaced, others stay.

    With ``covers``, an SQL condition on the partition columns as text, all partitions it holds for are replaced, those
    without rows in ``df`` by nothing. With ``sort_by``, files are sorted by these columns, which lets readers skip row
    groups. A lake has one writer at a time.
    """
    spark = df.sparkSession
    settle(spark, path)
    log = CommitLog(spark, path)
    first = all(name.startswith(("_", ".")) for name in log.files.names(""))
    name = f"set-{uuid.uuid4().hex}"
    log.publish({"state": "open", "set": name})
    seen = Observation()
    leading = F.struct(*[F.col(column).cast("string") for column in columns[:_SEEN_LEVELS]])
    placed = df.observe(seen, F.collect_set(leading).alias("folders")).hint("rebalance", *map(F.col, columns))
    if sort_by:
        placed = placed.sortWithinPartitions(*columns, *sort_by)
    (
        placed.write.mode("append")
        .partitionBy(*columns)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "gzip")
        .options(**_committing(log.files.local()), **{"mapreduce.output.basename": name})
        .parquet(path)
    )
    if first:
        log.publish({"state": "clean"})
    else:
        below = None if covers else [partition_folder(zip(columns, row)) for row in _observed(seen)]
        log.publish({"state": "published", "set": name, "columns": list(columns), "covers": covers, "below": below})
        settle(spark, path)
    log.forget(_KEPT_COMMITS)


def _committing(local: bool) -> dict[str, str]:
    """How files get to their folders: by the tasks that wrote them.

    On a local disk each new file, checksum file and folder starts a process that sets its mode, which takes longer than
    all the rest: there, folders are made once and moved as a tree, and checksum files are left out.
    """
    settings = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    if local:
        return settings | {
            "mapreduce.fileoutputcommitter.algorithm.version": "1",
            "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
            "fs.file.impl.disable.cache": "true",
        }
    return settings | {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _observed(seen: Observation) -> list:
    try:
        return seen.get["folders"]
    except Py4JJavaError:  # a plan found to be empty has nothing that observes
        return []


def settle(spark: SparkSession, path: str) -> None:
    """Finish a published set by removing what it replaced; undo one that was left open."""
    log = CommitLog(spark, path)
    newest = log.newest()
    if newest is None or newest["state"] == "clean":
        return
    found = files_of_set if newest["state"] == "open" else replaced_files
    gone = found(spark, path, newest).toLocalIterator()
    for some in batched((row["file"] for row in gone), _REMOVED_AT_ONCE):
        log.files.delete(some)
    log.publish({"state": "clean"})


def write_partitioned_by_match(df: DataFrame, path: str) -> None:
    """As :func:`write_partitioned` with one folder per match. Only for modest numbers of matches."""
    write_partitioned(df, path, MATCH_PARTITION_COLUMNS)


def write_ratings(df: DataFrame, path: str) -> None:
    """Ratings by year, country, club, date and entity; a new date keeps the older ones."""
    write_partitioned(df, path, RATING_PARTITION_COLUMNS)
