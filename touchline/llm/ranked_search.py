"""Ranked lexical search by the Best Position Algorithm over impact lists.

The index holds shards of documents; inside a shard, each term has its documents and counts. A search joins the terms
of the queries with the index, and a task gets one shard and one block of queries. There, each query term is a list of
the shard's documents by falling impact. The search reads each list directly at the first position nobody has seen,
looks a new document up in all lists of the query, which marks its positions there as seen too, and moves the list's
best position, the end of its run of seen positions. No unseen document can score more than the sum of the impacts
after the best positions; once that is strictly below the k-th score found, nothing is missing, ties included. The best
k of the shards are merged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.rows import small_batches
from touchline.session import cut_lineage, scratch_path

# A shard ends with this many documents, or postings, whichever comes first; a document is never cut.
SHARD_DOCS, SHARD_POSTINGS = 4096, 1 << 20
BLOCK = 256  # queries of a task
FIRST_READS = 16  # direct accesses a list gets in the first round; each round doubles them

# Bytes of UTF-8 that belong to a term keep their place, capitals become small, all others separate.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

_INDEX = pa.schema(
    [
        ("shard", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("total", pa.int64()),
        ("docs", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64())),
    ]
)
_INDEX_SQL = "shard BIGINT, term STRING, n BIGINT, total BIGINT, docs BINARY, counts BINARY, ids ARRAY<BIGINT>"
_FOUND = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split()


def _slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive runs of a numpy array as binary values."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _shard_rows(shard: int, ids: list, lengths: list, vocabulary: dict, terms: list, counts: list) -> Iterator[pa.RecordBatch]:
    """One row with term NULL for the documents, and one per term with its documents, numbered in the shard."""
    sizes = np.array([len(some) for some in terms])
    term = np.array([number for some in terms for number in some], np.int32)
    docs = np.repeat(np.arange(len(ids), dtype="<i4"), sizes)
    count = np.array([number for some in counts for number in some], "<i4")
    order = np.argsort(term, kind="stable")
    held = np.bincount(term, minlength=len(vocabulary))
    ends = np.cumsum(held)
    lengths = np.array(lengths, "<i8")
    yield pa.RecordBatch.from_pylist(
        [{"shard": shard, "n": len(ids), "total": int(lengths.sum()), "counts": lengths.tobytes(), "ids": ids}],
        schema=_INDEX,
    )
    words = pa.array([word.decode() for word in vocabulary], pa.string())
    nothing = pa.nulls(len(held))
    rows = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(held), shard)), words, pa.array(held), nothing.cast(pa.int64()),
            _slices(docs[order], ends), _slices(count[order], ends), nothing.cast(pa.list_(pa.int64())),
        ],
        schema=_INDEX,
    )
    for start in range(0, len(held), 1 << 14):
        yield rows.slice(start, 1 << 14)


def build(documents: DataFrame, path: str, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> None:
    """Write the index of ``documents`` (doc_id, text) below ``path``; documents without terms aren't in it."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        ids, lengths, vocabulary, terms, counts, held = [], [], {}, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = terms_of(text.as_py() or b"")
                if not words:
                    continue
                counted = Counter(words)
                ids.append(doc_id)
                lengths.append(len(words))
                terms.append([vocabulary.setdefault(word, len(vocabulary)) for word in counted])
                counts.append(list(counted.values()))
                held += len(counted)
                if len(ids) >= shard_docs or held >= shard_postings:
                    yield from _shard_rows(shard, ids, lengths, vocabulary, terms, counts)
                    shard += 1
                    ids, lengths, vocabulary, terms, counts, held = [], [], {}, [], [], 0
        if ids:
            yield from _shard_rows(shard, ids, lengths, vocabulary, terms, counts)

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    texts.mapInArrow(run, _INDEX_SQL).write.parquet(path)


def open_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX_SQL).parquet(path)


def number_queries(items: DataFrame) -> DataFrame:
    """(query, item_id, terms) of ``items`` (item_id, text), written: a number per row and its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({word.decode() for word in terms_of(text.as_py() or b"")}) for text in batch["text"]]
            yield batch.drop_columns(["text"]).append_column("terms", pa.array(found, pa.list_(pa.string())))

    rows = items.select(
        F.monotonically_increasing_id().alias("query"), "item_id", F.col("text").cast("binary").alias("text")
    )
    kind = items.schema["item_id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(run, f"query BIGINT, item_id {kind}, terms ARRAY<STRING>"))


class Lists:
    """The impact lists of one shard for a block of queries."""

    def __init__(self, n_docs: int, postings: dict[str, tuple[np.ndarray, np.ndarray]], m: np.ndarray):
        self.number = {term: i for i, term in enumerate(postings)}
        sizes = [len(docs) for docs, _ in postings.values()]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        # Sorted access: documents and impacts of each list by falling impact; before a query's weights are known
        # they are per unit of weight, which doesn't change the order.
        self.docs = np.zeros(self.starts[-1], np.int32)
        self.impact = np.zeros(self.starts[-1], np.int64)
        for i, (docs, counts) in enumerate(postings.values()):
            tf = counts.astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[docs])
            order = np.argsort(-impact, kind="stable")
            span = slice(self.starts[i], self.starts[i + 1])
            self.docs[span], self.impact[span] = docs[order], impact[order]
        # Random access: for each document, where it stands in which list.
        by_doc = np.argsort(self.docs, kind="stable")
        self.at = by_doc
        self.list_of = np.repeat(np.arange(len(sizes)), sizes)[by_doc]
        self.doc_ends = np.cumsum(np.bincount(self.docs, minlength=n_docs))

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, row): the rows of all list entries of some documents, and which of the documents each is of."""
        starts = np.where(docs > 0, self.doc_ends[docs - 1], 0)
        sizes = self.doc_ends[docs] - starts
        owner = np.repeat(np.arange(len(docs)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return owner, starts[owner] + inside

    def best(self, weights: Sequence[tuple[str, int]], k: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, accesses): at least the k best of a query; ``rank`` orders equal scores."""
        weight = np.zeros(len(self.number), np.int64)
        for term, value in weights:
            if term in self.number:
                weight[self.number[term]] = value
        lists = np.flatnonzero(weight)
        seen = np.zeros(len(self.docs), bool)
        known = np.zeros(len(self.doc_ends), bool)
        best_position = {i: int(self.starts[i]) for i in lists}
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        reads, accesses = FIRST_READS, 0
        while True:
            bound, fresh = 0, []
            for i in lists:
                at, end = best_position[i], int(self.starts[i + 1])
                unseen = np.flatnonzero(~seen[at:end])
                at = at + int(unseen[0]) if len(unseen) else end
                best_position[i] = at
                if at < end:
                    bound += int(weight[i] * self.impact[at])
                    fresh.append(self.docs[best_position[i] + unseen[:reads] - unseen[0]])
            if len(scores) > k:
                # Keep what can still be among the k best.
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                docs, scores = docs[scores >= least], scores[scores >= least]
            if not bound or len(scores) >= k and bound < scores.min():
                break
            new = np.unique(np.concatenate(fresh))
            accesses += sum(map(len, fresh))
            new = new[~known[new]]
            known[new] = True
            owner, rows = self.entries(new)
            of, where = self.list_of[rows], self.at[rows]
            mine = weight[of] > 0
            owner, of, where = owner[mine], of[mine], where[mine]
            seen[where] = True
            totals = np.zeros(len(new), np.int64)
            np.add.at(totals, owner, weight[of] * self.impact[where])
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, totals])
            reads *= 2
        order = np.lexsort((rank[docs], -scores))[:k]
        order = order[scores[order] > 0]
        return docs[order], scores[order], accesses


def _search_tile(index: pa.Table, queries: pa.Table, n: int, length: int, k: int) -> pa.Table:
    """The best k documents of one shard for each query of a block."""
    postings, ids, lengths = {}, None, None
    for row in index.select(["term", "docs", "counts", "ids"]).to_pylist():
        if row["term"] is None:
            ids, lengths = row["ids"], np.frombuffer(row["counts"], "<i8")
        else:
            postings[row["term"]] = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["counts"], "<i4")
    found = {"query": [], "doc_id": [], "score": []}
    if postings and queries.num_rows:
        unknown = np.array([value is None for value in ids])
        key = np.array([0 if value is None else value for value in ids], np.int64)
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((key, unknown))] = np.arange(len(ids))
        lists = Lists(len(ids), postings, 100 - 50 + (50 * lengths * n) // length)
        for query in queries.select(["query", "weights"]).to_pylist():
            docs, scores, _ = lists.best([(w["term"], w["weight"]) for w in query["weights"]], k, rank)
            found["query"] += [query["query"]] * len(docs)
            found["doc_id"] += [ids[doc] for doc in docs.tolist()]
            found["score"] += scores.tolist()
    return pa.Table.from_pydict(found, schema=_FOUND)


def search(index: DataFrame, items: DataFrame, k: int = 50, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of the index for each row of ``items``.

    A term weighs floor(1000 ln((2N+2)/(2df+1))) for N documents with terms, df of them with the term; a document's
    impact is weight · ((10^9 tf) div (1000 tf + 20 m)) with m = 50 + (50 n N) div L, where n is its number of terms
    and L that of all documents. Scores are whole numbers, summed over the distinct terms of the item; only scores
    above 0 are returned, equal ones by ascending doc_id with NULL ids last.

    Each row is a query of its own, also where ids or texts repeat. NULL and empty texts match nothing, an empty index
    or no items give no rows, other columns are ignored.
    """
    terms = F.col("term").isNotNull()
    n, length = (value or 0 for value in index.where(~terms).agg(F.sum("n"), F.sum("total")).first())
    numbered = number_queries(items)
    n_blocks = max(1, -(-numbered.count() // block))
    queries = numbered.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(n_blocks)).cast("int"))
    wanted = queries.select("query", "block", F.explode("terms").alias("term"))
    wanted = wanted.withColumnRenamed("term", "_wanted")
    frequency = index.where(terms).groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).alias("weight")
    weighted = cut_lineage(
        wanted.join(frequency, F.col("_wanted") == F.col("term")).select("query", "block", "term", weight)
    )
    # One row per term and block of queries that holds it, and one per shard and block for the documents themselves.
    places = weighted.select(F.col("term").alias("_term"), "block").distinct()
    lists = index.where(terms).join(places, F.col("term") == F.col("_term")).drop("_term")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    documents = index.where(~terms).select("*", blocks)
    shards = index.where(~terms).select(F.col("shard").alias("_shard"), blocks.alias("_block"))
    whole = weighted.groupBy("query", "block").agg(F.collect_list(F.struct("term", "weight")).alias("weights"))
    tiles = shards.join(whole, F.col("block") == F.col("_block")).select("_shard", "_block", "query", "weights")

    def run(postings: pa.Table, some: pa.Table) -> pa.Table:
        return _search_tile(postings, some, n, length, k)

    best = (
        lists.unionByName(documents)
        .groupBy("shard", "block")
        .cogroup(tiles.groupBy("_shard", "_block"))
        .applyInArrow(run, "query BIGINT, doc_id BIGINT, score BIGINT")
    )
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = numbered.select(F.col("query").alias("_query"), "item_id")
    return ranked.join(names, F.col("query") == F.col("_query")).select("item_id", "rank", "doc_id", "score")


def rank(documents: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """:func:`search` over an index of ``documents`` built for it."""
    path = scratch_path(documents.sparkSession, "impacts")
    build(documents, path)
    return search(open_index(documents.sparkSession, path), items, k)
