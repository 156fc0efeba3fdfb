"""Similarity self-join of documents on their sets of word n-grams: Jaccard, exact.

1. A fixed number of counters holds how many documents have an n-gram of each hash slot. Ordered by (counter, hash),
   rare n-grams come first; the order is the same for all documents, so how exact the counters are changes the work
   but not the result.
2. Documents with equal sets form a class. If two different sets of n and m n-grams are similar, then in that order
   some two n-grams that follow each other in one also follow each other in the other, and do so within the first
   2 n (1 - t) + 2 of either (``prefix``). These pairs of prefix n-grams are the join key: rarer than single n-grams,
   and found by a hash aggregation that gives each key its least class as a leader.
3. Classes connected through leaders can be similar, others can't. Each such group is cut into parts by set size and
   hash; two parts whose sizes are compatible meet in one task. There, candidates come from prefix n-grams in order of
   their rarity in the group, pass the length, positional and suffix filters, and are verified once.

No task gets more than two parts, and pairs live inside a task only: what leaves it is a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.rows import joined_by_place, places, small_side, stored
from touchline.llm.token_ids import segments
from touchline.session import cut_lineage, release

SLOT_BITS = 18
SUFFIX_BITS = 6
PART_ROWS = 512
PART_GRAMS = 1 << 20
WORDS = 150_000  # word hashes kept by a task


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


class Grams:
    """Sorted arrays of the 64-bit hashes of a text's distinct n-grams."""

    def __init__(self, n: int):
        self.n, self.known = n, _Hashes()

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > WORDS:
            self.known = _Hashes()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def _rolled(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the runs of n words, the number of words included."""
        out = np.full(len(hashes) - n + 1, n, np.uint64)
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i]
            out ^= out >> np.uint64(32)
        return out * np.uint64(0xD6E8FEB86659FD93)

    def of_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sets of the texts; a text of fewer than n words, but not none, has its whole sequence as one n-gram."""
        words = [[word for some in segments(text) for word in some.lower().split()] for text in texts]
        hashes = self._hashes([word for some in words for word in some])
        sets, start = [], 0
        for some in words:
            own = hashes[start : start + len(some)]
            start += len(some)
            sets.append(np.unique(self._rolled(own, min(self.n, len(own)))) if len(own) else own)
        return sets


def _texts(batch: pa.RecordBatch, rows: int = 200) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for start in range(0, len(batch), rows):
        some = batch.slice(start, rows)
        yield some, [text or b"" for text in some["text"].to_pylist()]


def slot_counts(documents: DataFrame, n: int) -> np.ndarray:
    """How many documents have n-grams of each of the 2^SLOT_BITS hash slots: a fixed number of counters."""
    chunk = 1 << 12

    def run(batches):
        grams, counts = Grams(n), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for _, texts in _texts(batch):
                slots = np.concatenate(grams.of_all(texts)) >> np.uint64(64 - SLOT_BITS)
                counts += np.bincount(slots.view(np.int64), minlength=len(counts))
        parts = counts.reshape(-1, chunk).astype("<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([part.tobytes() for part in parts], pa.binary())],
            names=["chunk", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(part, "<i8") for part in table["counts"].to_pylist())
        return pa.Table.from_pydict({"chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    texts = documents.select(F.col("text").cast("binary").alias("text"))
    columns = "chunk INT, counts BINARY"
    rows = texts.mapInArrow(run, columns).groupBy("chunk").applyInArrow(add, columns)
    found = np.zeros((1 << SLOT_BITS >> 12, chunk), np.int64)
    for row in rows.collect():
        found[row["chunk"]] = np.frombuffer(row["counts"], "<i8")
    return np.minimum(found.reshape(-1), (1 << 31) - 1).astype(np.uint32)


def prefix(n: int, threshold: Fraction) -> int:
    """How many n-grams of a set, rarest first, are looked at for pairs that similar sets share."""
    return min(n, int(2 * n * (1 - threshold)) + 2)


def overlap(n, m, threshold: Fraction):
    """The least intersection of similar sets of n and m elements; for arrays too."""
    num, den = threshold.numerator, threshold.denominator
    return -(-num * (n + m) // (num + den))


def _fingerprint(grams: np.ndarray) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(grams.tobytes())


def signatures(documents: DataFrame, n: int, threshold: Fraction, counts: np.ndarray) -> DataFrame:
    """Per document its place, set size, class (a 128-bit hash of the set, NULL for the empty one) and join keys."""

    def run(batches):
        grams = Grams(n)
        for batch in batches:
            for some, texts in _texts(batch):
                sets = grams.of_all(texts)
                keys = []
                for own in sets:
                    order = np.argsort(counts[own >> np.uint64(64 - SLOT_BITS)], kind="stable")
                    first = own[order[: prefix(len(own), threshold)]]
                    pairs = first[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + first[1:]
                    keys.append((pairs ^ (pairs >> np.uint64(29))).view(np.int64))
                offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int64), *keys])
                yield pa.RecordBatch.from_arrays(
                    [
                        some["doc_id"],
                        some["_file"],
                        some["_at"],
                        pa.array(map(len, sets), pa.int64()),
                        pa.array([_fingerprint(own) if len(own) else None for own in sets], pa.string()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=["doc_id", "_file", "_at", "n_shingles", "class", "keys"],
                )

    return documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), "_file", "_at"
    ).mapInArrow(run, "doc_id BIGINT, _file STRING, _at BIGINT, n_shingles BIGINT, class STRING, keys ARRAY<BIGINT>")


def _related(signed: DataFrame) -> DataFrame:
    """(node, component): short class numbers connected through shared join keys.

    Copies give a key the same class number, so they are summed up before the shuffle and link nothing.
    """
    number = F.conv(F.substring("class", 1, 15), 16, 10).cast("long")
    keyed = signed.select(number.alias("u"), F.explode("keys").alias("key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("u").alias("v"), F.max("u").alias("_last"))
        .filter("v < _last")
        .select(F.col("key").alias("_key"), "v")
    )
    shared = cut_lineage(shared)
    release(signed.sparkSession)
    links = keyed.join(shared.hint("merge"), F.col("key") == F.col("_key")).select("u", "v").filter("u <> v")
    return components(links)


def _gathered(documents: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """The n-gram sets of the member classes, from the text of one document of each."""

    def run(batches):
        grams = Grams(n)
        for batch in batches:
            for some, texts in _texts(batch):
                sets = [own.tobytes() for own in grams.of_all(texts)]
                columns = [some[name] for name in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], names=[*names, "grams"])

    names = ["class", "group", "band", "part"]
    texts = documents.select(F.col("text").cast("binary").alias("text"), "_file", "_at")
    joined = texts.join(small_side(members), ["_file", "_at"]).select(*names, "text")
    return joined.mapInArrow(run, "class STRING, group BIGINT, band INT, part INT, grams BINARY")


def similar(own: list[np.ndarray], side: np.ndarray | None, threshold: Fraction) -> list[tuple[int, int]]:
    """Links between sets, as a spanning forest; with ``side``, only between sets of different sides."""
    sizes = np.array([len(one) for one in own], np.int64)
    every, codes = np.unique(np.concatenate(own), return_inverse=True)
    ends = np.cumsum(sizes)
    rarity = np.argsort(np.argsort(np.bincount(codes), kind="stable"), kind="stable")[codes]
    coded = [codes[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist())]
    needed = overlap(sizes[:, None], sizes[None, :], threshold)
    num, den = threshold.numerator, threshold.denominator
    fits = den * np.minimum.outer(sizes, sizes) >= num * np.maximum.outer(sizes, sizes)  # length filter
    if side is not None:
        fits &= side[:, None] != side[None, :]
    fits &= np.tri(len(own), k=-1, dtype=bool).T
    tokens, members, rest = [], [], []
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
        length = size - int(overlap(size, size * threshold, threshold)) + 1
        first = np.sort(rarity[end - size : end])[: max(1, length)]
        tokens.append(first)
        members.append(np.full(len(first), i))
        rest.append(size - np.arange(len(first)))
    token, member, left = np.concatenate(tokens), np.concatenate(members), np.concatenate(rest)
    order = np.argsort(token, kind="stable")
    token, member, left = token[order], member[order], left[order]
    bounds = np.flatnonzero(np.diff(token, prepend=-1))
    candidate = np.zeros(fits.shape, bool)
    for start, end in zip(bounds.tolist(), [*bounds[1:].tolist(), len(token)]):
        if end - start > 1:
            at, open_ = member[start:end], left[start:end]
            box = np.ix_(at, at)
            # Positional filter: what is left of both sets from their first common n-gram on must suffice.
            candidate[box] |= np.minimum.outer(open_, open_) >= needed[box]
    a, b = np.nonzero(candidate & fits)
    # Suffix filter: no more can be common than the smaller share in each range of hashes.
    drop = np.uint64(64 - SUFFIX_BITS)
    ranges = np.stack([np.bincount((one >> drop).view(np.int64), minlength=1 << SUFFIX_BITS) for one in own])
    keep = np.zeros(len(a), bool)
    for start in range(0, len(a), 1 << 14):
        some = slice(start, start + (1 << 14))
        keep[some] = np.minimum(ranges[a[some]], ranges[b[some]]).sum(axis=1) >= needed[a[some], b[some]]
    a, b = a[keep], b[keep]
    root = list(range(len(own)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, marked = [], np.zeros(len(every), bool)
    firsts, starts = np.unique(a, return_index=True)
    for i, start, end in zip(firsts.tolist(), starts.tolist(), [*starts[1:].tolist(), len(a)]):
        marked[coded[i]] = True
        for j in b[start:end].tolist():
            if find(i) != find(j) and int(marked[coded[j]].sum()) >= needed[i, j]:
                root[find(j)] = find(i)
                links.append((i, j))
        marked[coded[i]] = False
    return links


def _links(gathered: DataFrame, parts: DataFrame, threshold: Fraction) -> DataFrame:
    """(u, v): similar classes, found in one task for each two parts of a group whose sizes are compatible."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        names = table["class"].to_pylist()
        own = [np.frombuffer(grams, np.uint64) for grams in table["grams"].to_pylist()]
        here = table["here"].to_numpy(zero_copy_only=False)
        side = None if here.all() or not here.any() else here
        pairs = similar(own, side, threshold) if len(own) > 1 else []
        return pa.Table.from_pydict(
            {"u": [names[i] for i, _ in pairs], "v": [names[j] for _, j in pairs]},
            schema=pa.schema([("u", pa.string()), ("v", pa.string())]),
        )

    # Each part meets itself and the parts after it of its own and the next band.
    each = parts.select("group", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    mine, other = each.alias("a"), each.alias("b")
    meets = mine.join(
        other,
        (F.col("a.group") == F.col("b.group"))
        & (F.col("b.band") - F.col("a.band")).between(0, 1)
        & ((F.col("a.band") < F.col("b.band")) | (F.col("a.part") <= F.col("b.part"))),
    ).select(
        F.col("a.group").alias("group"),
        F.struct(F.col("a.band").alias("band"), F.col("a.part").alias("part")).alias("one"),
        F.struct(F.col("b.band").alias("band"), F.col("b.part").alias("part")).alias("two"),
    )
    tasks = meets.withColumn("task", F.xxhash64("group", "one", "two"))
    seats = tasks.select("group", "task", "one.band", "one.part", F.lit(True).alias("here")).union(
        tasks.filter("one <> two").select("group", "task", "two.band", "two.part", F.lit(False))
    )
    dealt = gathered.join(seats, ["group", "band", "part"]).select("group", "task", "class", "here", "grams")
    return dealt.groupBy("group", "task").applyInArrow(run, "u STRING, v STRING")


def jaccard_components(documents: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """Classes and components of similar documents: one row per row of ``documents`` (doc_id, text, place).

    Words are runs of anything but ASCII white space, A-Z in lower case. A document's set has its distinct n-grams of
    words, or its whole sequence if it is shorter. Two documents link when intersection / union >= ``threshold``,
    0.75 at least. Returns _file, _at, doc_id, n_shingles, class, component_id (the smallest doc_id reachable by links,
    itself included; NULL ids count last) and ``first``, true for one row per component: the one with that id, of
    repeated ids the first by place. Documents without words (NULL, empty, blank) are alone. Extra columns are
    ignored.
    """
    if threshold < Fraction(3, 4) or threshold > 1:
        raise ValueError("similarities from 0.75 to 1 can be joined")
    counts = slot_counts(documents, n)
    signed = cut_lineage(signatures(documents, n, threshold, counts))
    worded = signed.filter("class IS NOT NULL")
    related = cut_lineage(_related(worded))
    release(documents.sparkSession)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_file", "_at")
    classes = cut_lineage(
        worded.groupBy("class").agg(F.min(place).alias("best"), F.first("n_shingles").alias("n"))
    )
    number = F.conv(F.substring("class", 1, 15), 16, 10).cast("long")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(1.0001 * math.log(1 / threshold) if threshold < 1 else 1.0))
    members = cut_lineage(
        classes.withColumn("_number", number)
        .join(related.select(F.col("node").alias("_number"), F.col("component").alias("group")), "_number")
        .select("class", "group", "n", band.cast("int").alias("band"), "best._file", "best._at")
    )
    # A group is one part if it is small, else a band of sizes gets as many parts as its rows and n-grams need.
    totals = members.groupBy("group").agg(F.count(F.lit(1)).alias("_rows"), F.sum("n").alias("_grams"))
    sized = members.join(totals, "group").withColumn(
        "band", F.when((F.col("_rows") <= PART_ROWS) & (F.col("_grams") <= PART_GRAMS), 0).otherwise(F.col("band"))
    )
    fill = F.greatest(F.count(F.lit(1)) / PART_ROWS, F.sum("n") / PART_GRAMS)
    parts = cut_lineage(sized.groupBy("group", "band").agg(F.ceil(fill).cast("int").alias("parts")))
    placed = cut_lineage(
        sized.join(parts, ["group", "band"])
        .withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
        .select("class", "group", "band", "part", "_file", "_at")
    )
    linked = components(_links(_gathered(documents, placed, n), parts, threshold))
    labelled = classes.join(
        linked.select(F.col("node").alias("class"), "component"), "class", "left"
    ).withColumn("component", F.coalesce("component", "class"))
    firsts = labelled.groupBy("component").agg(F.min("best").alias("first"))
    named = cut_lineage(labelled.join(firsts, "component").select("class", "component", "first"))
    rows = signed.select("_file", "_at", "doc_id", "n_shingles", "class")
    own = F.struct(F.col("_file").alias("_file"), F.col("_at").alias("_at"))
    found = rows.filter("class IS NOT NULL").join(named.hint("merge"), "class")
    alone = rows.filter("class IS NULL").withColumn("component_id", F.col("doc_id")).withColumn("first", F.lit(True))
    return found.select(
        *rows.columns,
        F.col("first.doc_id").alias("component_id"),
        (own == F.struct("first._file", "first._at")).alias("first"),
    ).unionByName(alone)


def one_of_each(documents: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """The documents without those that are similar to another that stays: one per component, with all columns."""
    rows = stored(documents)
    found = jaccard_components(places(rows, "doc_id", "text"), n, threshold)
    drop = cut_lineage(found.filter(~F.col("first")).select("_file", "_at"))
    return joined_by_place(rows, drop, "left_anti")
