"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch is reduced to one row per digest with a hash
aggregation (copies meet in the map tasks already, so a group of any size is no hot spot), the winners are
anti-joined with the index bucket by bucket, and what is new is appended. Digests that the index already knows keep
the row they have there.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import cut_lineage, exists

BUCKETS = 32


def normalised(text: Column) -> Column:
    """The text without blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def digests(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, the digest of its normalised text and its length, written to the shared folder.

    NULL text counts as empty. ``_row`` tells rows apart that agree in everything else.
    """
    return cut_lineage(
        documents.select(
            F.col(id_column).alias("doc_id"),
            F.sha2(normalised(F.col(text_column)).cast("binary"), 256).alias("digest"),
            F.char_length(F.coalesce(F.col(text_column), F.lit(""))).cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )


def winners(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays: most code points, then the smallest id (NULL last), then the first row."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "digest",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best._row").alias("keep_row"),
            "group_size",
        )
    )


class DigestIndex:
    """A table of the digests seen so far, with the id of the row that stays for each."""

    def __init__(self, spark: SparkSession, table: str, buckets: int = BUCKETS, path: str | None = None):
        """``table`` in the session's catalog, at ``path`` if given, else below the warehouse.

        Files that are there already are the index, also if this session's catalog doesn't know them.
        """
        if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?", table):
            raise ValueError(f"not a table name: {table}")
        self.spark, self.table, self.buckets, self.path = spark, table, buckets, path

    def location(self) -> str:
        """Where the files are, or will be."""
        if self.path:
            return self.path
        state = self.spark._jsparkSession.sessionState()
        return state.catalog().defaultTablePath(state.sqlParser().parseTableIdentifier(self.table)).toString()

    def register(self) -> bool:
        """Whether there is an index. Files that another session has left at the path are entered in the catalog.

        A file that isn't of the bucket its name says would be missed by joins, so the rows are read once to check it.
        """
        if self.spark.catalog.tableExists(self.table):
            return True
        path = self.location()
        if not exists(self.spark, path):
            return False
        try:
            found = self.spark.read.parquet(path)
        except AnalysisException as error:
            if "UNABLE_TO_INFER_SCHEMA" in str(error):  # a folder without rows
                return False
            raise
        bucket = F.regexp_extract("_metadata.file_name", r"_(\d+)(?:\..*)?$", 1).try_cast("int")
        if found.filter(~bucket.eqNullSafe(F.expr(f"pmod(hash(digest), {self.buckets})"))).take(1):
            raise ValueError(f"the files at {path} are not in {self.buckets} buckets by digest")
        kinds = [found.schema[name].dataType.simpleString() for name in ("digest", "keep_id")]
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest {kinds[0]}, keep_id {kinds[1]}, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{quoted}'"
        )
        return True

    def rows(self) -> DataFrame | None:
        return self.spark.table(self.table) if self.register() else None

    def unseen(self, found: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """The rows of ``found`` whose digest is not in the index: a sort-merge anti-join, the index side unshuffled.

        ``known`` may be some rows of the index instead of all.
        """
        known = self.rows() if known is None else known
        if known is None:
            return found
        return found.join(known.select("digest").hint("merge"), "digest", "left_anti")

    def append(self, new: DataFrame, batch: str | None = None) -> None:
        """Add rows of (digest, keep_id), one file per bucket, under the name of their batch."""
        self.register()
        name = F.lit(batch).cast("string").alias("batch")
        placed = new.select("digest", "keep_id", name).repartition(self.buckets, "digest")
        writer = placed.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.table)

    def ingest(
        self, documents: DataFrame, batch: str | None = None, id_column: str = "doc_id", text_column: str = "text"
    ) -> DataFrame:
        """Dedup a batch within itself and against the index, append what is new and return the decisions.

        Returns one row per document of the batch: doc_id, keep_id, group_size (rows of the batch with the digest),
        kept, text_sha256. ``kept`` is true for one row per digest that is new to the index and false for all others;
        ``keep_id`` then is the id of the row kept before. A batch with an id and text that repeat keeps one of the
        repeated rows. An empty batch appends nothing. Extra columns are ignored.

        Append adds all rows or none, and the index remembers the ``batch`` a digest came with: a named batch that is
        run again, after a crash at any point, decides as it did the first time. One without a name finds its own
        digests in the index and keeps nothing.
        """
        rows = digests(documents, id_column, text_column)
        best = cut_lineage(winners(rows))
        known = self.rows()
        if known is None:
            decided = best.withColumn("fresh", F.lit(True))
            self.append(best, batch)
        else:
            of_batch = F.lit(False) if batch is None else F.col("batch").eqNullSafe(F.lit(batch))
            mine, others = known.filter(of_batch), known.filter(~of_batch)
            new = cut_lineage(self.unseen(best, others))
            old = best.select("digest", "group_size").join(others.hint("merge"), "digest")
            decided = cut_lineage(
                new.withColumn("fresh", F.lit(True)).unionByName(
                    old.select("digest", "keep_id", F.lit(None).cast("long").alias("keep_row"), "group_size",
                               F.lit(False).alias("fresh"))
                )
            )
            self.append(new if mine.isEmpty() else self.unseen(new, mine), batch)
        return rows.join(decided, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("fresh") & F.coalesce(F.col("_row") == F.col("keep_row"), F.lit(False))).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
