"""An n-gram language model with deleted interpolation, trained and applied by hashed counts.

The corpus is laid out in units of about ``UNIT`` bytes of text, written to the shared folder. Each unit names the
distinct n-grams of its tokens with their counts; they meet by hash range, where the counts of all training units are
summed up, and an n-gram that more than one unit has goes back to each of them with its total. So a frequent n-gram
is moved once per unit, not once per occurrence, and no task holds more than a unit or a range of n-grams.

The probability of a token mixes the add-0.1 estimate of single tokens with the maximum-likelihood estimates of
growing order. The weights depend on a bucket of the context: the longest one seen, and the logarithm of its count.
They are learned by expectation-maximisation: one part of the training texts is deleted from the counts, and the
weights make it most probable. Then all training texts are counted.

Tokens are words (runs of anything but ASCII white space, A-Z in lower case) and one end per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.token_ids import segments
from touchline.session import cut_lineage, release

UNIT = 1 << 21
WORDS = 150_000  # word hashes kept by a task
RANGE = 2  # units per hash range: about as many n-grams as two units have
ADDED = 0.1
ROUNDS = 12
KEPT, DELETED, UNSEEN = 0, 1, 2
_ORDER = np.uint64(3)  # the lowest two bits of a key tell the order, so models have at most order 4
_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)

_PIECE = pa.struct(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("size", pa.int64()),  # bytes
        ("begins", pa.bool_()),
        ("ends", pa.bool_()),
        ("before", pa.binary()),  # the words in front of a piece that goes on
    ]
)
_PIECES = "ARRAY<STRUCT<row: BIGINT, doc_id: BIGINT, size: BIGINT, begins: BOOLEAN, ends: BOOLEAN, before: BINARY>>"
_UNIT = pa.schema([("unit", pa.int64()), ("role", pa.int32()), ("pieces", pa.list_(_PIECE)), ("text", pa.binary())])


def lay_out(documents: DataFrame, role: Column, order: int) -> DataFrame:
    """Units of texts of one role, written to the shared folder; long texts are cut at blanks, NULL is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        compress = zstandard.ZstdCompressor(level=1).compress
        first = TaskContext.get().partitionId() << 36
        unit, row = first, first
        open_ = {kind: ([], [], 0) for kind in (KEPT, DELETED, UNSEEN)}

        def closed(kind):
            nonlocal unit
            pieces, texts, _ = open_[kind]
            open_[kind] = ([], [], 0)
            unit += 1
            packed = compress(b"".join(texts))
            return pa.RecordBatch.from_pylist(
                [{"unit": unit, "role": kind, "pieces": pieces, "text": packed}], schema=_UNIT
            )

        for batch in batches:
            for doc_id, kind, text in zip(*(batch[name].to_pylist() for name in ("doc_id", "role", "text"))):
                row, before = row + 1, b""
                parts = list(segments(text or b"", UNIT))
                for number, part in enumerate(parts):
                    pieces, texts, size = open_[kind]
                    ends = number == len(parts) - 1
                    pieces.append({"row": row, "doc_id": doc_id, "size": len(part), "begins": number == 0,
                                   "ends": ends, "before": before})
                    texts.append(part)
                    if not ends:
                        before = b" ".join([*before.split(), *part.split()[-order:]][-order:])
                    open_[kind] = (pieces, texts, size + len(part) + 64)
                    if open_[kind][2] >= UNIT:
                        yield closed(kind)
        for kind in open_:
            if open_[kind][0]:
                yield closed(kind)

    rows = documents.select(
        F.col("doc_id").cast("long"), role.cast("int").alias("role"), F.col("text").cast("binary").alias("text")
    )
    return cut_lineage(rows.mapInArrow(run, f"unit BIGINT, role INT, pieces {_PIECES}, text BINARY"))


class _Hashes(dict):
    def __init__(self):
        import xxhash

        super().__init__()
        self.digest = xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.digest(word)
        return number


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers with bytes of equal weight together, compressed: small ones take little room."""
    import zstandard

    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _keys(line: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """56-bit keys of the n-grams of order 1 to ``order`` that end at the places; the order is in the lowest bits."""
    keys, rolled = [], np.zeros(len(place), np.uint64)
    for n in range(order):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + line[place - n]
        rolled ^= rolled >> np.uint64(31)
        mixed = (rolled * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(8)
        keys.append((mixed & ~_ORDER) | np.uint64(n))
    return keys


class Tokens:
    """The tokens of a unit as n-gram keys.

    ``piece`` has the piece of each token and ``heads`` the first token of each piece. The context of any other token
    is the n-gram that ends at the token before; that of a head is in ``lead``, by order. Heads that follow the start
    of a text are ``fresh``: their contexts, made of starts only, are counted once per text.
    """

    def __init__(self, pieces: list[dict], packed: bytes, order: int, known: _Hashes):
        import zstandard

        text = zstandard.ZstdDecompressor().decompress(packed)
        words, spans, at = [], [], 0
        for piece in pieces:
            own = text[at : at + piece["size"]].lower().split()
            at += piece["size"]
            before = piece["before"].lower().split()[-(order - 1) :] if order > 1 else []
            words += before
            words += own
            spans.append((len(before), len(own)))
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        lines, at = [np.zeros(0, np.uint64)], 0
        for piece, (n_before, n_own) in zip(pieces, spans):
            lines.append(np.full(order - n_before, _START, np.uint64))
            lines.append(hashes[at : at + n_before + n_own])
            lines.append(np.full(int(piece["ends"]), _END, np.uint64))
            at += n_before + n_own
        line = np.concatenate(lines)
        sizes = np.array([n_own + piece["ends"] for piece, (_, n_own) in zip(pieces, spans)], np.int64)
        firsts = np.cumsum(sizes + order) - sizes
        ends = np.cumsum(sizes)
        place = np.arange(sizes.sum()) + np.repeat(firsts - (ends - sizes), sizes)
        self.sizes, self.piece = sizes, np.repeat(np.arange(len(pieces)), sizes)
        self.heads = (ends - sizes)[sizes > 0]
        self.keys = _keys(line, place, order)
        before = place[self.heads] - 1
        self.lead = _keys(line, before, order - 1)
        self.fresh = line[before] == _START if order > 1 else np.zeros(0, bool)
        found = np.concatenate([*self.keys, *(lead[self.fresh] for lead in self.lead)])
        self.names, inverse, self.counts = np.unique(found, return_inverse=True, return_counts=True)
        self.at = np.split(inverse[: order * len(place)], order)
        # The leads are few and the names sorted: looked up, not made distinct with all names once more.
        leads = np.unique(np.concatenate([found[:0], *self.lead]))
        near = np.searchsorted(self.names, leads)
        near[near == len(self.names)] = 0
        other = leads[self.names[near] != leads] if len(self.names) else leads
        if len(other):
            # Contexts that only the unit before counts: named here to be looked up.
            names = np.sort(np.concatenate([self.names, other]))
            moved = np.searchsorted(names, self.names)
            counts = np.zeros(len(names), np.int64)
            counts[moved] = self.counts
            self.names, self.counts, self.at = names, counts, [moved[one] for one in self.at]

    def contexts(self, n: int) -> np.ndarray:
        """Where in ``names`` the context of n tokens of each token is."""
        out = np.empty(len(self.piece), np.int64)
        out[1:] = self.at[n - 1][:-1]
        out[self.heads] = np.searchsorted(self.names, self.lead[n - 1])
        return out


def _cuts(ranges: int) -> np.ndarray:
    return np.array([-((-i << 56) // ranges) for i in range(1, ranges)], np.uint64)


def _named(units: DataFrame, order: int, ranges: int) -> DataFrame:
    """(range, unit, role, names, counts): the n-grams each unit names, by hash range."""
    schema = pa.schema(
        [
            ("range", pa.int32()),
            ("unit", pa.int64()),
            ("role", pa.int32()),
            ("names", pa.binary()),
            ("counts", pa.binary()),
        ]
    )

    def run(batches):
        known, cuts = _Hashes(), _cuts(ranges)
        for batch in batches:
            for row in batch.to_pylist():
                if len(known) > WORDS:
                    known = _Hashes()
                tokens = Tokens(row["pieces"], row["text"], order, known)
                ends = np.searchsorted(tokens.names, cuts)
                parts = zip(np.split(tokens.names, ends), np.split(tokens.counts, ends))
                rows = [
                    {
                        "range": i,
                        "unit": row["unit"],
                        "role": row["role"],
                        "names": _packed(np.diff(names, prepend=np.uint64(0))),
                        "counts": _packed(counts),
                    }
                    for i, (names, counts) in enumerate(parts)
                    if len(names)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return units.mapInArrow(run, "range INT, unit BIGINT, role INT, names BINARY, counts BINARY")


def _summed(named: DataFrame) -> DataFrame:
    """(unit, range, steps, totals, kept): where in a unit's part of a range n-grams are that others name too, and
    their training counts; ``kept`` without the deleted texts, for deleted units only. Unit -1 has the numbers of
    training tokens (totals) and of distinct ones (steps), of all training texts and of the kept ones."""
    schema = pa.schema(
        [
            ("unit", pa.int64()),
            ("range", pa.int32()),
            ("steps", pa.binary()),
            ("totals", pa.binary()),
            ("kept", pa.binary()),
        ]
    )

    def run(table: pa.Table) -> pa.Table:
        number = table["range"][0].as_py()
        units, roles = table["unit"].to_pylist(), table["role"].to_pylist()
        names = [np.cumsum(_unpacked(packed), dtype=np.uint64) for packed in table["names"].to_pylist()]
        sizes = [len(one) for one in names]
        every = np.concatenate(names)
        del names
        order = np.argsort(every, kind="stable")
        every = every[order]
        new = np.concatenate([[True], every[1:] != every[:-1]])
        starts = np.flatnonzero(new)
        every = every[starts]
        # The number of its n-gram for every row, in the order of the units and of the names in each.
        group = np.empty(len(order), np.int32)
        group[order] = np.cumsum(new) - 1
        shared_of = (np.diff(np.append(starts, len(order))) > 1)[group]
        role = np.repeat(np.array(roles, np.int8), sizes)
        count = np.concatenate([_unpacked(packed) for packed in table["counts"].to_pylist()]).astype(np.float64)
        # Sums of whole numbers below 2^53 are exact.
        total = np.bincount(group, count * (role != UNSEEN), len(every)).astype(np.int64)
        kept = np.bincount(group, count * (role == KEPT), len(every)).astype(np.int64)
        total_of, kept_of = total[group], kept[group]
        del order, new, role, count, group
        rows, end = [], 0
        for unit, kind, size in zip(units, roles, sizes):
            here = slice(end, end + size)
            end += size
            at = np.flatnonzero(shared_of[here])
            if len(at):
                rows.append(
                    {
                        "unit": unit,
                        "range": number,
                        "steps": _packed(np.diff(at, prepend=0)),
                        "totals": _packed(total_of[here][at]),
                        "kept": _packed(kept_of[here][at]) if kind == DELETED else None,
                    }
                )
        single = (every & _ORDER == 0) & (every != _keys(np.array([_START] * 2), np.array([1]), 1)[0][0])
        distinct = [int((single & (some > 0)).sum()) for some in (total, kept)]
        tokens = [int(some[single].sum()) for some in (total, kept)]
        steps, totals = _packed(np.array(distinct)), _packed(np.array(tokens))
        rows.append({"unit": -1, "range": number, "steps": steps, "totals": totals})
        return pa.Table.from_pylist(rows, schema=schema)

    return named.groupBy("range").applyInArrow(run, "unit BIGINT, range INT, steps BINARY, totals BINARY, kept BINARY")


def _sizes(summed: DataFrame) -> tuple[list[int], list[int]]:
    """Training tokens and distinct ones, of all training texts and of the kept ones."""

    def run(batches):
        sums = np.zeros(4, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                sums += np.concatenate([_unpacked(row["totals"]), _unpacked(row["steps"])]).astype(np.int64)
        yield pa.RecordBatch.from_pydict({name: [value] for name, value in zip("abcd", sums.tolist())})

    columns = "a BIGINT, b BIGINT, c BIGINT, d BIGINT"
    parts = summed.filter("unit = -1").select("totals", "steps").mapInArrow(run, columns)
    row = parts.agg(*(F.coalesce(F.sum(name), F.lit(0)) for name in "abcd")).first()
    return [row[0], row[1]], [row[2], row[3]]


class Model:
    """What a task needs to know of the model: a few numbers and the weights by context bucket."""

    def __init__(self, order: int, tokens: int, distinct: int, weights: np.ndarray | None = None):
        self.order, self.tokens, self.distinct, self.weights = order, tokens, distinct, weights

    def parts(self, tokens: Tokens, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token its count, its context bucket and the estimates that are mixed, one row each."""
        single = counts[tokens.at[0]]
        estimates = [
            (single + ADDED) / (self.tokens + ADDED * (self.distinct + 1)),
            single / max(1, self.tokens),
        ]
        bucket = np.zeros(len(single), np.int64)
        for n in range(1, self.order):
            seen = counts[tokens.contexts(n)]
            estimates.append(counts[tokens.at[n]] / np.maximum(1, seen))
            bucket = np.where(seen > 0, n * 64 + np.frexp(seen.astype(np.float64))[1], bucket)
        return single, bucket, np.stack(estimates)


def _counted(tokens: Tokens, own: bool, table: pa.Table, column: str, ranges: int) -> np.ndarray:
    """Counts of the names of a unit: its own, where no other unit names them, or the totals."""
    counts = tokens.counts.copy() if own else np.zeros(len(tokens.names), np.int64)
    starts = np.append(0, np.searchsorted(tokens.names, _cuts(ranges)))
    for row in table.to_pylist():
        at = starts[row["range"]] + np.cumsum(_unpacked(row["steps"]).astype(np.int64))
        counts[at] = _unpacked(row[column]).astype(np.int64)
    return counts


def _joined(units: DataFrame, summed: DataFrame, function, schema: str) -> DataFrame:
    left, right = units.groupBy("unit"), summed.groupBy("unit")
    return left.cogroup(right).applyInArrow(function, schema)


def _events(units: DataFrame, summed: DataFrame, model: Model, ranges: int) -> DataFrame:
    """(bucket, p0, p1, …, n): estimates of the deleted tokens from the kept texts, equal ones counted together."""
    names = [f"p{i}" for i in range(model.order + 1)]

    def run(unit: pa.Table, found: pa.Table) -> pa.Table:
        parts = [np.zeros((0, model.order + 1))]
        buckets, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in unit.to_pylist():
            tokens = Tokens(row["pieces"], row["text"], model.order, _Hashes())
            _, bucket, estimates = model.parts(tokens, _counted(tokens, False, found, "kept", ranges))
            keyed = np.concatenate([bucket[None, :].astype(np.float64), estimates[1:]]).T.copy()
            rows = keyed.view([("", np.float64)] * keyed.shape[1])
            _, first, n = np.unique(rows, return_index=True, return_counts=True)
            parts.append(estimates.T[first])
            buckets.append(bucket[first])
            sizes.append(n)
        values = np.concatenate(parts)
        columns = {"bucket": np.concatenate(buckets), **dict(zip(names, values.T)), "n": np.concatenate(sizes)}
        return pa.Table.from_pydict({name: pa.array(np.ascontiguousarray(column)) for name, column in columns.items()})

    schema = f"bucket BIGINT, {', '.join(f'{name} DOUBLE' for name in names)}, n BIGINT"
    deleted = units.filter(F.col("role") == DELETED)
    rows = summed.filter(F.col("kept").isNotNull())
    return _joined(deleted, rows, run, schema).groupBy("bucket", *names).agg(F.sum("n").alias("n"))


def learned_weights(events: DataFrame, order: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by context bucket: ``rounds`` steps of expectation-maximisation over the events.

    A bucket starts with equal weights for the estimates its context has; half an event is added to each of them, so
    that no estimate gets lost. There are 64 buckets per order, so the sums of a round are few.
    """
    weights = np.zeros((64 * order, order + 1))
    for bucket in range(64 * order):
        known = 2 + bucket // 64
        weights[bucket, :known] = 1 / known
    names = [f"p{i}" for i in range(order + 1)]
    start = weights.copy()
    for _ in range(rounds):
        shares = [
            F.col(name) * F.element_at(F.lit(weights[:, i].tolist()), (F.col("bucket") + 1).cast("int"))
            for i, name in enumerate(names)
        ]
        mixed = sum(shares[1:], shares[0])
        expected = [F.sum(F.col("n") * share / mixed).alias(f"s{i}") for i, share in enumerate(shares)]
        sums = events.groupBy("bucket").agg(*expected)
        for row in sums.collect():
            total = np.array([row[f"s{i}"] for i in range(order + 1)]) + (start[row["bucket"]] > 0) * 0.5
            weights[row["bucket"]] = total / total.sum()
    return weights


def _scores(units: DataFrame, summed: DataFrame, model: Model, ranges: int) -> DataFrame:
    schema = (
        "row BIGINT, doc_id BIGINT, unseen BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"
    )

    def run(unit: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        for row in unit.to_pylist():
            tokens = Tokens(row["pieces"], row["text"], model.order, _Hashes())
            counts = _counted(tokens, row["role"] != UNSEEN, found, "totals", ranges)
            single, bucket, estimates = model.parts(tokens, counts)
            mixed = (model.weights[bucket].T * estimates).sum(axis=0)
            sums = [
                np.bincount(tokens.piece, values, len(tokens.sizes))
                for values in ((single > 0).astype(np.float64), np.log10(estimates[0]), np.log10(mixed))
            ]
            columns = (some.tolist() for some in (tokens.sizes, *sums))
            for piece, size, known, base, score in zip(row["pieces"], *columns):
                rows.append({"row": piece["row"], "doc_id": piece["doc_id"], "unseen": row["role"] == UNSEEN,
                             "n_tokens": size, "n_known": int(known), "base_score": base, "score": score})
        return pa.Table.from_pylist(rows, schema=output)

    output = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("unseen", pa.bool_()), ("n_tokens", pa.int64()),
         ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )
    return _joined(units, summed.filter("unit >= 0"), run, schema)


def score(documents: DataFrame, role: Column, order: int = 2) -> DataFrame:
    """Train on the documents whose ``role`` is KEPT or DELETED and score all of them.

    Returns one row per row of ``documents`` (doc_id, text): doc_id, held_out (its role is UNSEEN), n_tokens, n_known
    (tokens that occur in training texts), train_tokens, base_score (log10 of the add-0.1 estimates of single tokens)
    and score (log10 probability under the model). NULL, empty and blank texts are one end. Without training texts,
    every token has the probability of an unknown one. Ids may repeat or be NULL; extra columns are ignored.
    """
    if not 1 <= order <= 4:
        raise ValueError("order has to be 1 to 4")
    units = lay_out(documents, role, order)
    ranges = max(8, units.count() // RANGE)
    summed = cut_lineage(_summed(_named(units, order, ranges)))
    release(documents.sparkSession)
    (tokens, kept_tokens), (distinct, kept_distinct) = _sizes(summed)
    events = cut_lineage(_events(units, summed, Model(order, kept_tokens, kept_distinct), ranges))
    model = Model(order, tokens, distinct, learned_weights(events, order))
    return (
        _scores(units, summed, model, ranges)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("unseen").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            F.sum("base_score").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("row")
    )
