"""Distributed positional inverted index over whole documents, with phrase and proximity search.

The index is split by document: a shard holds the postings of about ``SHARD`` words of consecutive documents, with
positions counted through the shard and a gap between documents. Its terms lie in ``BUCKETS`` rows by hash, so a
search reads the rows its terms can be in. A document of more words than ``PIECE`` bytes of text hold goes on in the
next piece, which repeats the last ``OVERLAP`` words. Shards have a bounded size, whatever the corpus looks like, and
frequent terms are spread over all shards.

A search takes its phrases in blocks of bounded size. In each shard, the list of a phrase's rarest term there is
shifted by the term's offset and intersected with the lists of the next rarer ones until it is empty or confirmed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.token_ids import segments
from touchline.session import cut_lineage

SHARD = 1 << 19
PIECE = 1 << 20
OVERLAP = 256  # a phrase, or the span of a proximity match, has no more words than this
BUCKETS = 32
BLOCK = 1 << 17  # words of the phrases that one search job takes along

_WORD = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 32
    for byte in range(256)
)
_DOCS = "ARRAY<STRUCT<file: STRING, at: BIGINT, doc_id: BIGINT, base: BIGINT, first: BIGINT, n: INT, fresh: INT>>"
_DOC = pa.struct(
    [
        ("file", pa.string()),
        ("at", pa.int64()),
        ("doc_id", pa.int64()),
        ("base", pa.int64()),  # number of the piece's first word in its document
        ("first", pa.int64()),  # position of that word in the shard
        ("n", pa.int32()),
        ("fresh", pa.int32()),  # words that no earlier piece has
    ]
)
_ROWS = pa.schema(
    [
        ("shard", pa.int64()),
        ("bucket", pa.int32()),
        ("terms", pa.binary()),
        ("sizes", pa.binary()),
        ("gaps", pa.binary()),
        ("docs", pa.list_(_DOC)),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_WORD).split()


def _bucket(term: bytes) -> int:
    return zlib.crc32(term) % BUCKETS


def _pieces(text: bytes) -> Iterator[tuple[int, list[bytes], int]]:
    """(number of the first word, words, how many of them are new) of a text's pieces; at least one."""
    tail, base = [], 0
    for segment in segments(text, PIECE):
        fresh = words_of(segment)
        yield base, tail + fresh, len(fresh)
        base += len(tail) + len(fresh)
        tail = (tail + fresh)[-OVERLAP:]
        base -= len(tail)


class _Terms(dict):
    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def _shard_rows(shard: int, words: list[bytes], positions: np.ndarray, docs: list[dict]) -> pa.RecordBatch:
    terms = _Terms()
    codes = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
    names = list(terms)
    buckets = np.fromiter(map(_bucket, names), np.int64, len(names))
    order = np.argsort(buckets, kind="stable")
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    codes = rank[codes]
    placed = np.argsort(codes, kind="stable")
    positions, sizes = positions[placed], np.bincount(codes, minlength=len(names))
    starts = np.cumsum(sizes) - sizes
    gaps = np.diff(positions, prepend=0)
    gaps[starts] = positions[starts]
    ends = np.cumsum(np.bincount(buckets, minlength=BUCKETS))
    rows = [{"shard": shard, "bucket": -1, "docs": docs}]
    for bucket in range(BUCKETS):
        low, high = int(ends[bucket - 1]) if bucket else 0, int(ends[bucket])
        if low < high:
            span = slice(int(starts[low]), int(starts[high - 1] + sizes[high - 1]))
            rows.append(
                {
                    "shard": shard,
                    "bucket": bucket,
                    "terms": b"\n".join(names[i] for i in order[low:high].tolist()),
                    "sizes": sizes[low:high].astype("<u4").tobytes(),
                    "gaps": gaps[span].astype("<u4").tobytes(),
                }
            )
    return pa.RecordBatch.from_pylist(rows, schema=_ROWS)


def build(documents: DataFrame, path: str) -> None:
    """Write the index of ``documents`` (doc_id, text and the place columns) below ``path``.

    NULL and empty texts are documents without words. Rows are told apart by place, so ids may repeat or be NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        words, places, docs, end = [], [], [], 0
        for batch in batches:
            columns = (batch[name] for name in ("_file", "_at", "doc_id", "text"))
            for file, at, doc_id, text in zip(*columns):
                for base, some, fresh in _pieces(text.as_py() or b""):
                    docs.append({"file": file.as_py(), "at": at.as_py(), "doc_id": doc_id.as_py(), "base": base,
                                 "first": end, "n": len(some), "fresh": fresh})
                    words.extend(some)
                    places.append(np.arange(end, end + len(some)))
                    end += len(some) + OVERLAP
                    if len(words) >= SHARD or len(docs) >= SHARD // 16:
                        yield _shard_rows(shard, words, np.concatenate(places), docs)
                        words, places, docs, end, shard = [], [], [], 0, shard + 1
        if docs:
            yield _shard_rows(shard, words, np.concatenate(places), docs)

    rows = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), "_file", "_at"
    ).mapInArrow(run, f"shard BIGINT, bucket INT, terms BINARY, sizes BINARY, gaps BINARY, docs {_DOCS}")
    rows.write.parquet(path)


def documents(index: DataFrame) -> DataFrame:
    """(_file, _at, doc_id, n_words) of every document in the index."""
    pieces = index.filter("bucket = -1").select(F.explode("docs").alias("d"))
    return pieces.groupBy(F.col("d.file").alias("_file"), F.col("d.at").alias("_at"), F.col("d.doc_id")).agg(
        F.sum("d.fresh").cast("long").alias("n_words")
    )


def _found(lists: dict[int, np.ndarray], phrase: Sequence[int]) -> np.ndarray:
    """Positions where the phrase starts: offset-adjusted lists intersected from the rarest term on."""
    if any(term not in lists for term in phrase):
        return np.zeros(0, np.int64)
    order = sorted(range(len(phrase)), key=lambda offset: len(lists[phrase[offset]]))
    starts = lists[phrase[order[0]]] - order[0]
    for offset in order[1:]:
        if not len(starts):
            break
        held = lists[phrase[offset]]
        at = np.searchsorted(held, starts + offset)
        starts = starts[held[np.minimum(at, len(held) - 1)] == starts + offset]
    return starts


def _near(lists: dict[int, np.ndarray], phrase: Sequence[int], span: int) -> np.ndarray:
    """Positions from which ``span`` words hold every term of the phrase, each starting at one of its terms."""
    terms = set(phrase)
    if any(term not in lists for term in terms):
        return np.zeros(0, np.int64)
    rarest = min(terms, key=lambda term: len(lists[term]))
    every = np.unique(np.concatenate([lists[term] for term in terms]))
    # A match holds the rarest term within its span: only starts that near are looked at.
    at = np.searchsorted(lists[rarest], every)
    after = lists[rarest][np.minimum(at, len(lists[rarest]) - 1)]
    starts = every[(after >= every) & (after < every + span)]
    for term in sorted(terms, key=lambda term: len(lists[term])):
        held = lists[term]
        at = np.searchsorted(held, starts)
        after = held[np.minimum(at, len(held) - 1)]
        starts = starts[(after >= starts) & (after < starts + span)]
    return starts


def _search_block(index: DataFrame, phrases: list[tuple[str, tuple[bytes, ...]]], slack: int | None) -> DataFrame:
    """(_file, _at, item, low, high) of the matches of some phrases; word numbers from low to before high."""
    numbers = _Terms()
    coded = [(item, tuple(numbers[term] for term in phrase)) for item, phrase in phrases]
    known = dict(numbers)
    buckets = sorted({_bucket(term) for term in known})

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    yield pa.RecordBatch.from_pylist(
                        [{"shard": row["shard"], "term": -1, "gaps": b"", "docs": row["docs"]}], schema=picked
                    )
                    continue
                sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                out = [
                    {"shard": row["shard"], "term": known[term],
                     "gaps": row["gaps"][4 * int(ends[i] - sizes[i]) : 4 * int(ends[i])]}
                    for i, term in enumerate(row["terms"].split(b"\n"))
                    if term in known
                ]
                yield pa.RecordBatch.from_pylist(out, schema=picked)

    def match(shard: pa.Table) -> pa.Table:
        lists, docs = {}, []
        for row in shard.to_pylist():
            if row["term"] < 0:
                docs = row["docs"]
            else:
                lists[row["term"]] = np.cumsum(np.frombuffer(row["gaps"], "<u4").astype(np.int64))
        firsts = np.array([doc["first"] for doc in docs], np.int64)
        out = []
        for item, phrase in coded:
            size = len(phrase) if slack is None else len(phrase) + slack
            for start in (_found(lists, phrase) if slack is None else _near(lists, phrase, size)).tolist():
                doc = docs[int(np.searchsorted(firsts, start, side="right")) - 1]
                low = doc["base"] + start - doc["first"]
                high = min(low + size, doc["base"] + doc["n"])
                # Runs of overlapping matches of an item are one row.
                if out and out[-1]["item"] == item and (out[-1]["_file"], out[-1]["_at"]) == (doc["file"], doc["at"]) \
                        and out[-1]["low"] <= low <= out[-1]["high"]:
                    out[-1]["high"] = max(out[-1]["high"], high)
                else:
                    out.append({"_file": doc["file"], "_at": doc["at"], "item": item, "low": low, "high": high})
        return pa.Table.from_pylist(out, schema=matched)

    picked = pa.schema([("shard", pa.int64()), ("term", pa.int32()), ("gaps", pa.binary()), ("docs", pa.list_(_DOC))])
    matched = pa.schema(
        [("_file", pa.string()), ("_at", pa.int64()), ("item", pa.string()), ("low", pa.int64()), ("high", pa.int64())]
    )
    lists = index.filter(F.col("bucket").isin([-1, *buckets])).mapInArrow(
        pick, f"shard BIGINT, term INT, gaps BINARY, docs {_DOCS}"
    )
    return lists.groupBy("shard").applyInArrow(match, "_file STRING, _at BIGINT, item STRING, low BIGINT, high BIGINT")


def search(
    index: DataFrame, phrases: Iterator[tuple[str, tuple[bytes, ...]]], slack: int | None = None, block: int = BLOCK
) -> DataFrame:
    """Matches of (item, words) phrases as (_file, _at, item, low, high) with word numbers of the document.

    Without ``slack``, a match is the exact phrase. With it, a match is a stretch of at most that many words more than
    the phrase that holds all its terms, in any order and starting with one of them. Phrases are taken from the
    iterator in blocks of ``block`` words, one job each; overlapping matches of an item may come as one row.
    """
    found, some, size = None, [], 0

    def flush(found, some):
        more = cut_lineage(_search_block(index, some, slack))
        return more if found is None else found.unionByName(more)

    for item, phrase in phrases:
        if len(phrase) + (slack or 0) > OVERLAP:
            raise ValueError(f"phrases of more than {OVERLAP} words, slack included, can't be searched")
        some.append((item, phrase))
        size += len(phrase)
        if size >= block:
            found, some, size = flush(found, some), [], 0
    return flush(found, some) if some or found is None else found


def windows(items: DataFrame, size: int) -> Iterator[tuple[str, tuple[bytes, ...]]]:
    """The windows of ``size`` words of each item, one partition of items after the other; shorter items are one."""
    texts = items.select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text"))
    for row in texts.toLocalIterator():
        words = words_of(bytes(row["text"] or b""))
        seen = {tuple(words[i : i + size]): None for i in range(max(1, len(words) - size + 1)) if words}
        for window in seen:
            yield row["item_id"] or "", window


def open_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def covered(matches: DataFrame) -> DataFrame:
    """(_file, _at, n_hit, items): words inside any match, and the sorted distinct items."""
    order = Window.partitionBy("_file", "_at").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("high") - F.greatest(F.col("low"), F.coalesce(F.max("high").over(order), F.lit(0)))
    return (
        matches.withColumn("_new", F.greatest(new, F.lit(0)))
        .groupBy("_file", "_at")
        .agg(F.sum("_new").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
    )
