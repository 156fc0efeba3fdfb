"""Benchmark decontamination by exact windows of benchmark words, found in a positional inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import positional_index as index
from touchline.llm.rows import joined_by_place, places, stored
from touchline.session import cut_lineage, scratch_path

WINDOW = 13
SHARE = 20  # a document is contaminated if one in so many of its words, at least, is hit


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """What of each document occurs in the benchmark, one row per row of ``documents``.

    Returns _file, _at, doc_id, n_words, n_hit, n_items, items_sha256, contaminated. NULL or empty texts have no words
    and are not contaminated; items without words match nothing; a NULL item_id counts as the empty id, and rows with
    the same item_id as one item. Extra columns are ignored; an empty benchmark hits nothing.
    """
    path = scratch_path(documents.sparkSession, "index")
    index.build(documents, path)
    rows = index.open_index(documents.sparkSession, path)
    hits = index.covered(index.search(rows, index.windows(benchmark, window)))
    return (
        index.documents(rows)
        .join(hits, ["_file", "_at"], "left")
        .select(
            "_file",
            "_at",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, all their columns unchanged."""
    rows = stored(documents)
    found = report(places(rows, "doc_id", "text"), benchmark, window)
    return joined_by_place(rows, cut_lineage(found.filter("contaminated").select("_file", "_at")), "left_anti")
