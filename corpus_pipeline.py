"""From documents to token files: drop toxic texts, near copies and benchmark leaks, mix the sources, write token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of ``documents``. A stage finds its documents by their
place in the files, so NULL or repeated ids, empty texts and extra columns pass through unharmed; an empty table stays
empty.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontamination, mixing, ngram_join, token_files, toxicity
from touchline.llm.rows import places, read, stored
from touchline.session import scratch_path

WORDS, SIMILARITY = 5, Fraction(8, 10)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# SQL has neither the learned weights nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return ngram_join.one_of_each(docs, WORDS, SIMILARITY)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with benchmark passages."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def in_mix_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mix: files by name, rows inside a file as they come."""
    return mixing.in_order(docs)


def as_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from token files written in the order of the stored mix."""
    path = scratch_path(spark, "tokens")
    token_files.write(places(stored(docs), "doc_id", "text"), path, TOKENIZER, order=("_file", "_at"))
    return token_files.digests(spark, path)


STAGES = [
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", not_in_benchmark),
    ("mixing sources to target weights", in_mix_order),
    ("token-ID output", as_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
