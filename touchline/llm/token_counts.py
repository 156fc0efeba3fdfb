"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of inserts, deletes and revised counts is summed up per key, with the sign of each change, before it is
written; totals are the sums over all committed batches. A batch is committed by one small row that names the folder
of its deltas. Until that row is there, nothing of the batch counts; once it is, the batch is not written again,
however often a job repeats it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
TOTALS = ("n_docs", "n_tokens")
_COMMIT = "batch STRING, folder STRING"


def n_words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def n_bytes(text: Column) -> Column:
    """Bytes in UTF-8, the tokens of a byte-level model without merges."""
    return F.octet_length(text).cast("long")


# Tokenizers that are an expression over the text; the version names what is counted and how.
EXPRESSIONS = {"words-1": n_words, "bytes-1": n_bytes}


def counted(documents: DataFrame, versions: Mapping[str, object] = EXPRESSIONS) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens): the tokens of each document under each version; NULL text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = [
        F.struct(F.lit(name).alias("version"), count(text).alias("n_tokens")) for name, count in versions.items()
    ]
    return documents.select("doc_id", "source", "lang", F.inline(F.array(*each)))


def counted_by_file(documents: DataFrame, version: str, path: str) -> DataFrame:
    """The same with the tokenizer of a file, such as a byte-pair encoding; special tokens aren't added."""

    def run(batches):
        from touchline.llm.token_ids import encoder

        words = encoder(path)
        for batch in batches:
            for start in range(0, len(batch), 500):
                some = batch.slice(start, 500)
                sizes = np.zeros(len(some), np.int64)
                for number, ids, _ in words.encode_all([text or b"" for text in some["text"].to_pylist()]):
                    sizes[number] += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], some["source"], some["lang"], pa.array([version] * len(some)), pa.array(sizes)],
                    names=["doc_id", *KEYS, "n_tokens"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), "source", "lang", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id BIGINT, source STRING, lang STRING, version STRING, n_tokens BIGINT")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).alias("n_docs"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Documents counted anew, perhaps under another key: the old counts go, the new ones come."""
    return deletes(old).unionByName(inserts(new))


class TokenRollup:
    """Totals in a folder that all executors can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> DataFrame:
        """(batch, folder), one row per batch: of two writers that raced, the folder that sorts first counts."""
        try:
            rows = self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], _COMMIT)
        return rows.groupBy("batch").agg(F.min("folder").alias("folder"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add the signed ``changes`` (source, lang, version, n_docs, n_tokens); False if the batch was there already."""
        if self.commits().filter(F.col("batch") == batch).limit(1).count():
            return False
        folder = uuid.uuid4().hex
        sums = changes.groupBy(*KEYS).agg(*(F.sum(F.col(name).cast("long")).alias(name) for name in TOTALS))
        placed = sums.withColumn("folder", F.lit(folder))
        placed.write.partitionBy("folder").mode("append").parquet(f"{self.path}/deltas")
        row = self.spark.createDataFrame([(batch, folder)], _COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) over the committed batches; keys that sum to nothing are left out.

        NULL sources and languages are keys of their own.
        """
        fields = "source STRING, lang STRING, version STRING, n_docs BIGINT, n_tokens BIGINT, folder STRING"
        try:
            deltas = self.spark.read.schema(fields).parquet(f"{self.path}/deltas")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            deltas = self.spark.createDataFrame([], fields)
        kept = deltas.join(self.commits().select("folder"), "folder", "left_semi")
        sums = kept.groupBy(*KEYS).agg(*(F.sum(name).alias(name) for name in TOTALS))
        return sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))
