"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import conversation_repair, decontamination, exact_dedup, html_text, language_model, mixing
from touchline.llm import ngram_join, pii, ranked_search, token_counts, token_files, toxicity, vantage_search
from touchline.llm.rows import id_hash, read, whole, with_place
from touchline.session import cut_lineage, scratch_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions after two batches, the longer half of the texts first: then what the index keeps is the best row of all.

    Copies that differ in blanks may be in both batches, so group sizes are counted over both.
    """
    path = scratch_path(spark, "digests")
    index = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", path=path)
    documents = read(spark, sf_dir, "documents")
    length = F.char_length(whole())
    middle = documents.agg(F.percentile_approx(length, 0.5)).first()[0] or 0
    halves = {"longer": length >= middle, "shorter": length < middle}
    batches = [index.ingest(documents.filter(some), name) for name, some in halves.items()]
    decided = cut_lineage(batches[0].unionByName(batches[1]))
    sizes = cut_lineage(decided.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size")))
    columns = decided.columns
    return decided.drop("group_size").join(sizes, "text_sha256").select(*columns)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_place(read(spark, sf_dir, "documents"))
    found = ngram_join.jaccard_components(documents, 3, Fraction(90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents come in, copies of a text go, the rest is counted without junk signs."""
    documents = read(spark, sf_dir, "documents")
    clean = F.regexp_replace("text", "[#$%&*]+", "")
    rows = cut_lineage(
        documents.select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            "source",
            "lang",
            F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"),
            *(
                count(F.coalesce(text, F.lit(""))).alias(f"{name}{state}")
                for name, count in token_counts.EXPRESSIONS.items()
                for state, text in (("", F.col("text")), ("+", clean))
            ),
        )
    )
    # Rows are told apart by number: ids may be NULL or repeat.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")).getField("_row").alias("_row")
    best = rows.groupBy("digest").agg(first).select("_row")
    kept, copies = (rows.join(best, "_row", how) for how in ("left_semi", "left_anti"))

    def counts(some: DataFrame, state: str) -> DataFrame:
        each = [
            F.struct(F.lit(name).alias("version"), F.col(f"`{name}{state}`").alias("n_tokens"))
            for name in token_counts.EXPRESSIONS
        ]
        return some.select("doc_id", "source", "lang", F.inline(F.array(*each)))

    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    for _ in range(2):  # the second turn is a replay and changes nothing
        rollup.commit("load", token_counts.inserts(counts(rows, "")))
        rollup.commit("dedup", token_counts.deletes(counts(copies, "")))
        rollup.commit("recount", token_counts.revisions(counts(kept, ""), counts(kept, "+")))
    return rollup.totals()


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_place(read(spark, sf_dir, "documents"))
    return mixing.mixed(documents, mixing.tempered(documents)).drop("_file", "_at")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_place(read(spark, sf_dir, "documents"))
    return decontamination.report(documents, read(spark, sf_dir, "benchmark")).drop("_file", "_at")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    documents = with_place(read(spark, sf_dir, "documents"))
    token_files.write(documents, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digests(spark, path)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = id_hash() % 10
    role = F.when(rest == 0, language_model.UNSEEN).when(rest == 1, language_model.DELETED)
    role = role.otherwise(language_model.KEPT)
    return language_model.score(read(spark, sf_dir, "documents"), role, order=2)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_search.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of their id and turn; dropped rows have ``present`` false."""
    key = [F.coalesce(F.col(column).cast("string"), F.lit(" ")) for column in ("conv_id", "turn")]
    damage = F.crc32(F.concat_ws(":", *key).cast("binary")) % 20
    text, role = (F.coalesce(F.col(column), F.lit(" ")) for column in ("text", "role"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (damage != 0).alias("present"),
        F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(damaged(read(spark, sf_dir, "conversations")), F.col("present"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_exact_dedup,
        op2_ngram_join,
        op3_pii,
        op4_token_counts,
        op5_toxicity,
        op6_mixing,
        op7_html_text,
        op8_decontamination,
        op9_token_files,
        op10_language_model,
        op11_ranked_search,
        op12_vantage_search,
        op13_conversation_repair,
    )
    return {query.__name__: query for query in found}
