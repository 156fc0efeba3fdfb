"""Repair of conversations by the cheapest edits, over grammar-compressed sequences.

The rows of a conversation become one sign each: its role and fault decide which edits it allows at which cost. Ordered
rows are cut into segments, and only distinct sequences of signs go on. In blocks of them, Re-Pair replaces the most
frequent neighbours by new symbols, shared by all conversations of the block. Each symbol has one min-plus matrix: the
least cost of bringing the repaired roles from one state to another over the rows it stands for, with the audit of these
edits as a rope, two parts of the matrices below it. Matrices are made bottom-up, once per rule. A conversation's
segments are joined by the same product.

States of the repaired roles: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.

Ties go to the ASCII-least audit. Inserts always stand before the next row, so two audits of the same rows are equal or
differ before either ends; comparing the parts in order, by a rank per matrix, is then comparing the whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.rows import small_batches
from touchline.session import cut_lineage

INSERT, REROLE, DELETE, TRUNCATED = 5, 1, 2, 5  # costs
SEGMENT_BITS = 12  # segments have at most 2^12 rows
BLOCK = 1 << 18  # signs of the sequences that share a grammar
SHORT = 64  # audits of symbols for up to so many rows are kept as text

_BLANKS = " \t\n\x0b\x0c\r"
_STATES = range(4)
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}  # role to the moves it allows


def _least(entries: Iterator[tuple[int, int, int, str]]) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest, then ASCII-least, of (from, to, cost, audit) for each from and to."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for i, j, cost, audit in entries:
        if (i, j) not in best or (cost, audit) < best[i, j]:
            best[i, j] = cost, audit
    return best


def _sign_matrix(sign: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Any inserts and then one row: (from, to) to (cost, audit)."""
    row = [(i, i, DELETE, "D") for i in _STATES]
    if sign != "d":
        role, extra = sign.lower(), TRUNCATED if sign.isupper() else 0
        row += [(i, j, extra, "K") for i, j in _AFTER.get(role, {}).items()]
        row += [(i, j, REROLE + extra, "R") for new in "ua" if new != role for i, j in _AFTER[new].items()]
    inserts = [(i, i, 0, "") for i in _STATES]
    one = [(i, j, INSERT, "I") for role in "ua" for i, j in _AFTER[role].items()]
    two = [(i, k, 2 * INSERT, "II") for i, j, _, _ in one for j2, k, _, _ in one if j == j2]
    return _least(
        (i, k, before + cost, audit + edit)
        for i, j, before, audit in inserts + one + two
        for j2, k, cost, edit in row
        if j == j2
    )


class Matrix:
    """Costs and audit ranks by (from, to); ``parts`` names the state between the two halves of a rule's audit."""

    def __init__(self, cost: dict, order: dict, parts: dict | None = None, audits: dict | None = None, size: int = 1):
        self.cost, self.parts, self.audits, self.size = cost, parts, audits, size
        ranks = {value: rank for rank, value in enumerate(sorted(set(order.values())))}
        self.rank = {key: ranks[value] for key, value in order.items()}

    @classmethod
    def of_sign(cls, sign: str) -> "Matrix":
        best = _sign_matrix(sign)
        audits = {key: audit for key, (_, audit) in best.items()}
        return cls({key: cost for key, (cost, _) in best.items()}, audits, audits=audits)

    def then(self, other: "Matrix") -> "Matrix":
        """The min-plus product: first the rows of this one, then those of the other."""
        best: dict = {}
        for (i, k), cost in self.cost.items():
            for j in _STATES:
                if (k, j) in other.cost:
                    value = cost + other.cost[k, j], (self.rank[i, k], other.rank[k, j]), k
                    if (i, j) not in best or value < best[i, j]:
                        best[i, j] = value
        return Matrix(
            {key: value[0] for key, value in best.items()},
            {key: value[1] for key, value in best.items()},
            {key: value[2] for key, value in best.items()},
            size=self.size + other.size,
        )


SIGNS = "dsuaxSUAX"


class Grammar:
    """Re-Pair rules over sequences of signs and the matrix of each symbol."""

    def __init__(self, sequences: Sequence[str]):
        text, self.rules = "\n".join(sequences), {}
        while True:
            chosen, used = [], {"\n"}
            # Pairs without a symbol in common can be replaced in one turn without changing each other's counts.
            for (left, right), count in Counter(zip(text, text[1:])).most_common():
                if count < 2:
                    break
                if left not in used and right not in used:
                    chosen.append(left + right)
                    used |= {left, right}
            if not chosen:
                break
            for pair in chosen:
                symbol = chr(0x100 + len(self.rules))
                self.rules[symbol] = pair
                text = text.replace(pair, symbol)
        self.sequences = text.split("\n")
        self.matrices = {sign: Matrix.of_sign(sign) for sign in SIGNS}
        for symbol, (left, right) in self.rules.items():  # a rule is made of symbols before it
            self.matrices[symbol] = self.matrices[left].then(self.matrices[right])
        self.texts: dict[tuple[str, int, int], str] = {}

    def audit(self, symbol: str, i: int, j: int) -> str:
        """The rope of a symbol's edits from one state to another as text."""
        out, stack = [], [(symbol, i, j)]
        while stack:
            at = stack.pop()
            matrix = self.matrices[at[0]]
            if matrix.audits is not None:
                out.append(matrix.audits[at[1:]])
            elif at in self.texts:
                out.append(self.texts[at])
            else:
                left, right = self.rules[at[0]]
                k = matrix.parts[at[1:]]
                if matrix.size <= SHORT and at != (symbol, i, j):
                    out.append(self.texts.setdefault(at, self.audit(*at)))
                else:
                    stack += [(right, k, at[2]), (left, at[1], k)]
        return "".join(out)

    def evaluated(self, compressed: str) -> tuple[Matrix, dict[tuple[int, int], str]]:
        """The matrix of a whole compressed sequence and its audits as text."""
        steps = [self.matrices[symbol] for symbol in compressed]
        done = [steps[0]]
        for matrix in steps[1:]:
            done.append(done[-1].then(matrix))
        audits = {}
        for i, j in done[-1].cost:
            parts, end = [], j
            for at in range(len(steps) - 1, 0, -1):
                k = done[at].parts[i, end]
                parts.append(self.audit(compressed[at], k, end))
                end = k
            parts.append(self.audit(compressed[0], i, end))
            audits[i, j] = "".join(reversed(parts))
        return done[-1], audits


_EVALUATED = pa.schema(
    [
        ("signs", pa.string()), ("cost", pa.list_(pa.int64())), ("rank", pa.list_(pa.int32())),
        ("audits", pa.list_(pa.string())),
    ]
)


def _evaluate(block: pa.Table) -> pa.Table:
    """Matrices of the sequences of a block, as lists of 16 with NULL where there is no way."""
    sequences = block["signs"].to_pylist()
    grammar = Grammar(sequences)
    out = []
    for signs, compressed in zip(sequences, grammar.sequences):
        matrix, audits = grammar.evaluated(compressed)
        places = [(i, j) for i in _STATES for j in _STATES]
        out.append(
            {
                "signs": signs, "cost": [matrix.cost.get(p) for p in places], "rank": [matrix.rank.get(p) for p in places],
                "audits": [audits.get(p) for p in places],
            }
        )
    return pa.Table.from_pylist(out, schema=_EVALUATED)


# Closing a conversation: from a state, by so many inserts, to an end.
_CLOSING = {0: 0, 1: 2, 2: 1, 3: 0}


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entry and exit state of each segment on the cheapest way through its conversation, which is sorted."""
    rows = (row for batch in batches for row in batch.to_pylist())
    schema = pa.schema([(name, pa.int64()) for name in ("first", "entry", "exit", "closing", "total")])
    out = []
    for _, segments in groupby(rows, key=lambda row: row["conv_id"]):
        best, backs, firsts = {0: (0, 0)}, [], []  # state to (cost, rank of the audit so far)
        for segment in segments:
            reached: dict[int, tuple] = {}
            for i, (cost, rank) in best.items():
                for j in _STATES:
                    more = segment["cost"][4 * i + j]
                    if more is not None:
                        value = cost + more, (rank, segment["rank"][4 * i + j]), i
                        if j not in reached or value < reached[j]:
                            reached[j] = value
            ranks = {value: n for n, value in enumerate(sorted({value[1] for value in reached.values()}))}
            best = {j: (cost, ranks[order]) for j, (cost, order, _) in reached.items()}
            backs.append({j: value[2] for j, value in reached.items()})
            firsts.append(segment["first"])
        total, _, state = min((cost + INSERT * _CLOSING[j], rank, j) for j, (cost, rank) in best.items())
        closing, end = _CLOSING[state], state
        for first, back in zip(reversed(firsts), reversed(backs)):
            out.append({"first": first, "entry": back[end], "exit": end, "closing": closing, "total": total})
            closing, total, end = 0, 0, back[end]
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_ROW_EDITS = re.compile("I*[KRD]")


class _Walk:
    """The rows of one conversation in order, with their edits: counts its faults, gives its repaired rows."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = Counter()
        self.state, self.audits, self.edits, self.total, self.closing = 0, [], iter(()), 0, 0
        self.before, self.turns, self.last_turn, self.low = None, 0, None, None

    def open_segment(self, row: dict) -> None:
        self.audits.append(row["audit"])
        self.edits = iter(_ROW_EDITS.findall(row["audit"]))
        self.total += row["total"]
        self.closing = row["closing"]

    def _placed(self, role: str) -> str:
        self.state = 1 if role.startswith("s") else 2 if role.startswith("u") else 3
        return role

    def _inserted(self, n: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(n):
            yield "I", self._placed("assistant" if self.state == 2 else "user"), ""

    def row(self, row: dict) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the repaired rows that come with a row."""
        if row["fault"]:
            self.counts[row["fault"]] += 1
        initial = row["role"][:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.before = initial
        if row["turn"] is not None:
            if row["turn"] != self.last_turn:
                self.turns += 1
            self.low = row["turn"] if self.low is None else self.low
            self.last_turn = row["turn"]
        edits = next(self.edits)
        yield from self._inserted(len(edits) - 1)
        if edits[-1] == "K":
            yield "K", self._placed(row["role"]), row["text"]
        elif edits[-1] == "R":
            yield "R", self._placed("assistant" if self.state == 2 else "user"), row["text"]

    def end(self) -> Iterator[tuple[str, str, str]]:
        self.audits.append("I" * self.closing)
        yield from self._inserted(self.closing)

    def report(self, digest: str) -> dict:
        gaps = 0 if self.low is None else self.last_turn - self.low + 1 - self.turns
        counts = {name: self.counts[name] for name in ("blank", "duplicate", "truncated", "illegal")}
        return {
            "conv_id": self.conv_id, "gaps": gaps, **counts, "cost": self.total, "audit": "".join(self.audits),
            "repaired_sha256": digest,
        }


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Walk, Iterator[tuple[str, str, str]]]]:
    """Each conversation of sorted rows with its repaired rows, which have to be read before the next one is."""
    rows = (row for batch in batches for row in batch.to_pylist())

    def repaired(walk, some):
        for row in some:
            if row["audit"] is not None:
                walk.open_segment(row)
            elif row["at"] is not None:
                yield from walk.row(row)
        yield from walk.end()

    for conv_id, some in groupby(rows, key=lambda row: row["conv_id"]):
        walk = _Walk(conv_id)
        yield walk, repaired(walk, some)


def _with_edits(conversations: DataFrame, present: Column | None) -> DataFrame:
    """Rows of conversations and, before each segment of them, its audit; sorted inside a conversation.

    Row columns are conv_id, turn, role, text, fault and at; audit rows have audit, closing and total; a conversation
    without rows has one row with neither.
    """
    small_batches(conversations.sparkSession)
    known = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        known.alias("present"),
        F.monotonically_increasing_id().alias("tie"),
    ).withColumn("digest", F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary")))
    order = ["conv_id", "turn", "role", "digest", "tie"]
    placed = cut_lineage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    )
    there = placed.where("present")
    repeated = (
        there.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"))
        .agg(F.min("at").alias("earliest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    trimmed = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.col("at") > F.col("earliest"), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    sign = (
        F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    marked = cut_lineage(there.join(repeated, same, "left").select("conv_id", "at", "role", fault.alias("fault")).select(
        "conv_id", "at", "fault", sign.alias("sign")
    ))
    # A segment's rows lie in one file of placed rows, whose numbers are dense.
    ordered = F.sort_array(F.collect_list(F.struct("at", "sign")))
    segments = cut_lineage(
        marked.groupBy("conv_id", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(
            F.min("at").alias("first"), F.array_join(ordered.getField("sign"), "").alias("signs")
        )
    )
    sequences = segments.select("signs").distinct()
    n_blocks = max(1, -(-(sequences.agg(F.sum(F.length("signs"))).first()[0] or 0) // BLOCK))
    matrices = cut_lineage(
        sequences.groupBy(F.pmod(F.xxhash64("signs"), F.lit(n_blocks)).alias("block")).applyInArrow(
            _evaluate, "signs STRING, cost ARRAY<BIGINT>, rank ARRAY<INT>, audits ARRAY<STRING>"
        )
    ).withColumnRenamed("signs", "_signs")
    same_signs = F.col("signs") == F.col("_signs")
    ways = segments.join(matrices, same_signs).select("conv_id", "first", "cost", "rank")
    paths = ways.repartition("conv_id").sortWithinPartitions("conv_id", "first").mapInArrow(
        _paths, "first BIGINT, entry BIGINT, exit BIGINT, closing BIGINT, total BIGINT"
    ).withColumnRenamed("first", "_first")
    edits = segments.join(paths, F.col("first") == F.col("_first")).join(matrices, same_signs).select(
        "conv_id",
        F.col("first").alias("at"),
        F.get("audits", (4 * F.col("entry") + F.col("exit")).cast("int")).alias("audit"),
        "closing",
        "total",
    )
    faults = marked.select(F.col("at").alias("_at"), "fault")
    whole = placed.join(faults, F.col("at") == F.col("_at"), "left").select(
        "conv_id", F.when(F.col("present"), F.col("at")).alias("at"), "turn", "role", "text", "fault"
    )
    both = edits.unionByName(whole, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "at", F.col("audit").asc_nulls_last())


def report(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """Faults, cheapest repair and its digest, one row per conv_id of ``conversations`` (conv_id, turn, role, text).

    Rows for which ``present`` doesn't hold only make their conversation appear: without other rows it has zeros, an
    empty audit and the digest of the empty text. Rows are taken by turn, NULL first, those of one turn by role and a
    hash of role and text. NULL role or text counts as one space, rows with a NULL conv_id as one conversation; a role
    that starts with none of s, u and a (or an empty one) has to be changed or deleted. Texts of any length stay whole.
    Other columns are ignored; an empty table gives no rows.

    A conversation's text is hashed in order by one task that holds a batch of it; everything before is cut into
    segments. Its audit has a sign per row and is the only value that grows with it.
    """
    kind = conversations.schema["conv_id"].dataType
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = f"conv_id {kind.simpleString()}, {', '.join(f'{c} BIGINT' for c in columns)}, audit STRING, repaired_sha256 STRING"
    wide = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for walk, rows in _walks(batches):
            digest, separator = hashlib.sha256(), b""
            for _, role, text in rows:
                digest.update(separator + f"{role}:{text}".encode())
                separator = b"\n"
            out.append(walk.report(digest.hexdigest()))
            size += 256 + len(out[-1]["audit"])
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=wide)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=wide)

    return _with_edits(conversations, present).mapInArrow(run, schema)


def repaired(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """(conv_id, position, edit, role, text): the rows of the repaired conversations; see :func:`report`."""
    schema = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, position BIGINT, edit STRING, role STRING, text STRING"
    wide = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for walk, rows in _walks(batches):
            for position, (edit, role, text) in enumerate(rows):
                out.append({"conv_id": walk.conv_id, "position": position, "edit": edit, "role": role, "text": text})
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=wide)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema=wide)

    return _with_edits(conversations, present).mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
