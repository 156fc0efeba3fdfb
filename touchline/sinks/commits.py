"""Numbered commits: small files that name the data files in force.

Data files are written first, under names nothing refers to yet. A commit then names, in one small JSON file that
appears whole or not at all, everything readers are to open. A writer that dies before it leaves files without a
commit, which the next writer removes; one that dies after it leaves replaced files, which are no longer named.
A target has one writer at a time and any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

FOLDER = "_commits"  # readers of the data skip names that start with an underscore
_DELETERS = 32  # threads that wait for the file system


class Files:
    """The files below a path, on whatever file system it is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._system = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def local(self) -> bool:
        return self._system.getUri().getScheme() == "file"

    def exists(self, name: str) -> bool:
        return self._system.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """The names directly below a folder, empty if there is no such folder."""
        path = self._path(folder)
        if not self._system.exists(path):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(path)]

    def read(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file that appears under its name with all of its content."""
        if self.exists(name):
            raise FileExistsError(f"{self.root}/{name}")
        folder, _, last = name.rpartition("/")
        aside = f"{folder}/.{last}-{uuid.uuid4().hex}"
        stream = self._system.create(self._path(aside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._system.rename(self._path(aside), self._path(name)):
            raise OSError(f"{self.root}/{name} can't be written")

    def delete(self, names: Iterable[str]) -> None:
        """Remove files or folders, many side by side."""
        with ThreadPoolExecutor(_DELETERS) as pool:
            list(pool.map(lambda name: self._system.delete(self._path(name), True), names))


class CommitLog:
    """The commits of a target, numbered from 0; the newest one is in force."""

    def __init__(self, spark: SparkSession, target: str):
        self.files = Files(spark, target)

    def numbers(self) -> list[int]:
        return sorted(int(name.removesuffix(".json")) for name in self.files.names(FOLDER) if name.endswith(".json"))

    def read(self, number: int) -> dict:
        return json.loads(self.files.read(f"{FOLDER}/{number}.json"))

    def newest(self) -> dict | None:
        """The content of the newest commit, with its ``number``."""
        numbers = self.numbers()
        return {**self.read(numbers[-1]), "number": numbers[-1]} if numbers else None

    def publish(self, content: dict) -> int:
        """Add a commit; returns its number."""
        numbers = self.numbers()
        number = numbers[-1] + 1 if numbers else 0
        self.files.create(f"{FOLDER}/{number}.json", json.dumps(content))
        return number

    def forget(self, keep: int) -> list[dict]:
        """Remove all but the newest ``keep`` commits; returns the content of these."""
        numbers = self.numbers()
        self.files.delete(f"{FOLDER}/{number}.json" for number in numbers[:-keep])
        return [self.read(number) for number in numbers[-keep:]]
