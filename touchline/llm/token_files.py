"""Token files: documents as Huffman-coded token ids in ascending document order.

A file set is a folder with two Parquet tables. ``codes`` holds the code length of each id, computed from the counts
of the whole corpus; ``blocks`` holds blocks of at most ``BLOCK`` ids that can be decoded alone, with the documents
they hold. Blocks are numbered by (part, block) in document order. A document longer than a block goes on in the next.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.huffman import Book, code_lengths
from touchline.llm.token_ids import GROUP, encoder, forget
from touchline.session import cut_lineage

BLOCK = 1 << 15  # ids
ROWS = 1 << 14  # texts encoded together
END = 1
# A code book of more ids than this would no longer be a small thing to send to every task.
MAX_IDS = 1 << 18

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("_file", pa.string()),
        ("_at", pa.int64()),
        ("piece", pa.int32()),
        ("last", pa.bool_()),
        ("ids", pa.binary()),
    ]
)
_DOC = pa.struct([("doc_id", pa.int64()), ("n", pa.int32()), ("ends", pa.bool_())])
_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("n_tokens", pa.int32()),
        ("docs", pa.list_(_DOC)),
        ("runs", pa.binary()),
        ("bits", pa.binary()),
    ]
)


class _Packer:
    """Little-endian ids with equal bytes together, compressed."""

    def __init__(self):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=1).compress
        self.decompress = zstandard.ZstdDecompressor().decompress

    def pack(self, ids: np.ndarray) -> bytes:
        planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        return self.compress(planes.tobytes())

    def unpack(self, packed: bytes) -> np.ndarray:
        planes = np.frombuffer(self.decompress(packed), np.uint8).reshape(4, -1)
        return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[tuple]]]:
    """(texts, places) of several batches, which the encoder can look up together."""
    texts: list[bytes] = []
    places: list[tuple] = []
    size = 0
    for batch in batches:
        more = [text or b"" for text in batch["text"].to_pylist()]
        texts += more
        places += zip(*(batch[name].to_pylist() for name in ("doc_id", "_file", "_at")))
        size += sum(map(len, more))
        if size > GROUP or len(texts) > ROWS:
            yield texts, places
            texts, places, size = [], [], 0
    if texts:
        yield texts, places


def token_rows(documents: DataFrame, tokenizer: str, end_id: int | None = END) -> DataFrame:
    """(doc_id, _file, _at, piece, last, ids) per document: its packed ids, in pieces of at most a block if it is long.

    ``documents`` has doc_id, text and the place columns; ``end_id`` is appended to each document. NULL text has no
    ids but the end. Every task adds a row with piece -1: the ids it has seen, then how often.
    """
    tail = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)

    def pieces(words, pack, texts, places, seen):
        held, size, piece = [], 0, 0
        for number, ids, ends in words.encode_all(texts):
            held += [ids, tail] if ends else [ids]
            seen += [ids, tail] if ends else [ids]
            size += len(ids) + (len(tail) if ends else 0)
            while size > BLOCK:
                joined = np.concatenate(held)
                yield (*places[number], piece, False, pack(joined[:BLOCK]))
                held, size, piece = [joined[BLOCK:]], size - BLOCK, piece + 1
            if ends:
                yield (*places[number], piece, True, pack(np.concatenate(held)))
                held, size, piece = [], 0, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pack, counts = encoder(tokenizer), _Packer().pack, np.zeros(0, np.int64)
        for texts, places in _groups(batches):
            seen: list[np.ndarray] = []
            rows = pieces(words, pack, texts, places, seen)
            while columns := list(zip(*islice(rows, 500))):
                more = np.bincount(np.concatenate(seen), minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
                seen.clear()
                arrays = [pa.array(values, field.type) for values, field in zip(columns, _PIECES)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PIECES)
        found = np.flatnonzero(counts)
        row = {"piece": -1, "ids": found.astype("<i8").tobytes() + counts[found].astype("<i8").tobytes()}
        yield pa.RecordBatch.from_pylist([row], schema=_PIECES)

    return documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), "_file", "_at"
    ).mapInArrow(run, "doc_id BIGINT, _file STRING, _at BIGINT, piece INT, last BOOLEAN, ids BINARY")


def token_counts(pieces: DataFrame) -> DataFrame:
    """(id, n) over all documents, from what each task has counted."""

    def run(batches):
        for batch in batches:
            for packed in batch["ids"].to_pylist():
                found, counts = np.frombuffer(packed, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], names=["id", "n"])

    counts = pieces.filter("piece < 0").select("ids").mapInArrow(run, "id BIGINT, n BIGINT")
    return counts.groupBy("id").agg(F.sum("n").alias("n"))


def code_book(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and code lengths; there is one row per id of the tokenizer at most, so they may go through the driver."""
    rows = counts.orderBy("id").limit(MAX_IDS + 1).collect()
    if len(rows) > MAX_IDS:
        raise ValueError(f"more than {MAX_IDS} different ids")
    ids = np.array([row["id"] for row in rows], np.uint32)
    return ids, code_lengths(np.array([row["n"] for row in rows], np.int64))


def _blocks(book: Book, placed: DataFrame) -> DataFrame:
    """Code the rows of each task, which are in document order, block by block."""

    def run(batches):
        from pyspark import TaskContext

        forget()
        part, block, unpack = TaskContext.get().partitionId(), 0, _Packer().unpack

        def coded(held, docs):
            ids = np.concatenate(held)
            bits, runs = book.encode(ids)
            row = {"part": part, "block": block, "n_tokens": len(ids), "docs": docs, "runs": runs, "bits": bits}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        held, docs, size = [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["ids"])
                if docs and size + len(ids) > BLOCK:
                    yield coded(held, docs)
                    held, docs, size, block = [], [], 0, block + 1
                held.append(ids)
                docs.append({"doc_id": row["doc_id"], "n": len(ids), "ends": row["last"]})
                size += len(ids)
        if docs:
            yield coded(held, docs)

    return placed.select("doc_id", "ids", "last").mapInArrow(
        run,
        "part INT, block INT, n_tokens INT, docs ARRAY<STRUCT<doc_id: BIGINT, n: INT, ends: BOOLEAN>>, "
        "runs BINARY, bits BINARY",
    )


def write(
    documents: DataFrame, path: str, tokenizer: str, end_id: int | None = END, order: tuple[str, ...] = ("doc_id",)
) -> None:
    """Write the token files of ``documents`` (doc_id, text and the place columns) below ``path``.

    Documents come in the order of ``order``, which names doc_id or the place columns (NULL first); equal ones by
    place, so that repeated ids keep a fixed order. Rows with NULL or empty text are documents of the end id alone. An
    empty table makes empty files. Extra columns are ignored.
    """
    spark = documents.sparkSession
    pieces = cut_lineage(token_rows(documents, tokenizer, end_id))
    ids, lengths = code_book(token_counts(pieces))
    codes = spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist())), "id BIGINT, length INT")
    codes.coalesce(1).write.parquet(f"{path}/codes")
    # A document's pieces share these keys, so no part ends inside a document.
    keys = list(dict.fromkeys([*order, "_file", "_at"]))
    placed = pieces.filter("piece >= 0").repartitionByRange(*keys).sortWithinPartitions(*keys, "piece")
    _blocks(Book(ids, lengths), placed).write.option("compression", "none").parquet(f"{path}/blocks")


def _decoded(spark: SparkSession, path: str, make, name: str, kind: str) -> DataFrame:
    """(part, block, slot, doc_id, ends, n) per piece of a document, and what ``make`` makes of its ids' bytes."""
    rows = spark.read.parquet(f"{path}/codes").limit(MAX_IDS).collect()
    ids = np.array([row["id"] for row in rows], np.uint32)
    lengths = np.array([row["length"] for row in rows], np.int64)

    def run(batches):
        forget()
        book = Book(ids, lengths)
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                tokens = book.decode(row["bits"], row["runs"], row["n_tokens"]).astype("<u4")
                docs = row["docs"]
                ends = np.cumsum([doc["n"] for doc in docs])
                made = [make(tokens[end - doc["n"] : end].tobytes()) for doc, end in zip(docs, ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(docs), pa.int32()),
                        pa.array([row["block"]] * len(docs), pa.int32()),
                        pa.array(range(len(docs)), pa.int32()),
                        pa.array([doc["doc_id"] for doc in docs], pa.int64()),
                        pa.array([doc["ends"] for doc in docs], pa.bool_()),
                        pa.array([doc["n"] for doc in docs], pa.int32()),
                        pa.array(made),
                    ],
                    names=["part", "block", "slot", "doc_id", "ends", "n", name],
                )

    columns = f"part INT, block INT, slot INT, doc_id BIGINT, ends BOOLEAN, n INT, {name} {kind}"
    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, columns)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: (part, block, slot, doc_id, ends, n, ids) per piece of a document, ids as bytes."""
    return _decoded(spark, path, bytes, "ids", "BINARY")


def combined_crc(crcs: list[int], sizes: list[int]) -> int:
    """crc32 of byte strings put together, from the crc32 and size of each."""

    def times(matrix, vector):
        out = 0
        for bit, row in enumerate(matrix):
            if vector >> bit & 1:
                out ^= row
        return out

    crc = 0
    for more, size in zip(crcs, sizes):
        step = [0xEDB88320] + [1 << bit for bit in range(31)]  # one zero bit of the reflected polynomial
        bits = 8 * size
        while bits:
            if bits & 1:
                crc = times(step, crc)
            step = [times(step, row) for row in step]
            bits >>= 1
        crc ^= more
    return crc


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files alone.

    ``start`` counts the ids of all documents before it in the order of the files. One row per task of the writer is
    summed up to know where each part starts; inside a part, blocks are summed up by a window over that part's rows.
    """
    pieces = cut_lineage(_decoded(spark, path, zlib.crc32, "crc", "BIGINT"))
    totals = spark.read.parquet(f"{path}/blocks").select("part", "block", F.col("n_tokens").cast("long").alias("n"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.withColumn("_in_part", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of the writer
    parts = parts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    starts = blocks.join(parts, "part").withColumn("_start", F.col("_in_part") + F.col("_before"))
    inside = Window.partitionBy("part", "block").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        pieces.withColumn("_at", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(starts.select("part", "block", "_start"), ["part", "block"])
        .withColumn("start", F.col("_start") + F.col("_at"))
    )
    # Pieces of long documents fill blocks of their own, so few rows meet here: a piece and those before it share the
    # number of documents that ended earlier in the part.
    ended = Window.partitionBy("part").orderBy("block", "slot").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("_doc", F.coalesce(F.sum(F.col("ends").cast("int")).over(ended), F.lit(0)))
    whole = numbered.groupBy("part", "_doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").cast("long").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "slot", "n", "crc"))).alias("all"),
    )

    @F.pandas_udf(T.LongType())
    def crc_of(pieces_of_doc):
        return pieces_of_doc.map(lambda some: combined_crc([p["crc"] for p in some], [4 * p["n"] for p in some]))

    several = whole.filter(F.size("all") > 1).withColumn("ids_crc32", crc_of("all"))
    single = whole.filter(F.size("all") == 1).withColumn("ids_crc32", F.col("all")[0]["crc"])
    return single.unionByName(several).select("doc_id", "start", "n_tokens", "ids_crc32")
