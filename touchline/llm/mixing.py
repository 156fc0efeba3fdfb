"""Mixing sources to target weights by proportionally fair scheduling.

Every source is cut into blocks of documents. Time runs in slots of one block. With weight w, block j of a source is
released at slot floor(j / w) and has to be placed before slot ceil((j + 1) / w); of the released blocks, the one with
the earliest deadline gets the slot. Releases and deadlines come from the exact weights in whole numbers. After every
slot each source has got its weight times the slots so far, give or take less than one block, as long as all sources
have blocks; a source that has run out leaves its slots to the others.

The choice of one slot depends on all slots before it, so one task makes the schedule, block by block: it reads a row
per source and holds a block per source, whatever the number of documents. On request, weights are rounded to whole
shares of a period, and the schedule of one period is repeated.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.rows import joined_by_place, places, stored
from touchline.operators.numbering import number_within
from touchline.session import cut_lineage

BLOCK = 32  # documents
PERIOD = 1000  # slots
BATCH = 1 << 14  # blocks of the schedule that are written at once
TEMPERATURE = 0.5


def shares(weights: Mapping[str | None, float], period: int = PERIOD) -> dict[str | None, int]:
    """Whole slots per period for each source, at least one: proportional, the largest remainders rounded up.

    The period is lengthened to twice the number of sources if there are more of them than it has room for.
    """
    if any(weight <= 0 for weight in weights.values()):
        raise ValueError("weights have to be positive")
    names = sorted(weights, key=lambda name: (name is not None, name or ""))
    total, period = sum(weights.values()), max(period, 2 * len(names))
    exact = {name: weights[name] / total * (period - len(names)) for name in names}
    out = {name: 1 + int(exact[name]) for name in names}
    rest = period - sum(out.values())
    for name in sorted(names, key=lambda name: int(exact[name]) - exact[name])[:rest]:
        out[name] += 1
    return out


def schedule(slots: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """The slots of one period that each source gets, by earliest deadline among the released blocks."""
    period = sum(slots.values())
    order = sorted(slots, key=lambda name: (name is not None, name or ""))
    released: list[list[tuple[int, int]]] = [[] for _ in range(period)]
    for rank, name in enumerate(order):
        for j in range(slots[name]):
            released[j * period // slots[name]].append((-(-(j + 1) * period // slots[name]), rank))
    waiting: list[tuple[int, int]] = []
    placed: dict[str | None, list[int]] = {name: [] for name in order}
    for slot in range(period):
        for block in released[slot]:
            heapq.heappush(waiting, block)
        _, rank = heapq.heappop(waiting)
        placed[order[rank]].append(slot)
    return placed


def exact_schedule(weights: Sequence[float], blocks: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of all blocks in the order of slots, sources as numbers; a slot without blocks is left out.

    ``blocks`` tells how many blocks each source has. The work is in proportion to the blocks, not to the slots.
    """
    fractions = [Fraction(weight) for weight in weights]
    scale = max((fraction.denominator for fraction in fractions), default=1)  # powers of two, of which the largest
    whole = [int(fraction * scale) for fraction in fractions]
    total, slot = sum(whole), 0
    coming = [(0, source, 0) for source, n in enumerate(blocks) if n]  # by release; sorted, so a heap
    waiting: list[tuple[int, int, int]] = []
    while coming or waiting:
        if not waiting:
            slot = max(slot, coming[0][0])
        while coming and coming[0][0] <= slot:
            _, source, j = heapq.heappop(coming)
            heapq.heappush(waiting, (-(-(j + 1) * total // whole[source]), source, j))
        _, source, j = heapq.heappop(waiting)
        yield source, j, slot
        slot += 1
        if j + 1 < blocks[source]:
            heapq.heappush(coming, ((j + 1) * total // whole[source], source, j + 1))


def _exact_slots(sizes: DataFrame) -> DataFrame:
    """(_source, _block, slot) of every block. ``sizes`` has _source, _weight and _blocks."""

    def run(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda row: (row["_source"] is not None, row["_source"] or ""))
        names = [row["_source"] for row in rows]

        def batch_of(found):
            source, block, slot = zip(*found)
            columns = [pa.array([names[k] for k in source], pa.string()), pa.array(block, pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(slot, pa.int64())], names=["_source", "_block", "slot"])

        found = []
        for placed in exact_schedule([row["_weight"] for row in rows], [row["_blocks"] for row in rows]):
            found.append(placed)
            if len(found) == BATCH:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    # A repeated task must not change the slots that others have read, so they are written.
    return cut_lineage(sizes.repartition(1).mapInArrow(run, "_source STRING, _block BIGINT, slot BIGINT"))


def tempered(documents: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Target weights (source, weight) that lift small sources: their number of documents to the power ``temperature``."""
    counts = documents.groupBy(F.col("source").cast("string").alias("source")).count()
    return counts.select("source", F.pow(F.col("count").cast("double"), F.lit(float(temperature))).alias("weight"))


def _weights(spark: SparkSession, weights: Mapping[str | None, float] | DataFrame) -> DataFrame:
    if not isinstance(weights, DataFrame):
        rows = [(source, float(weight)) for source, weight in weights.items()]
        weights = spark.createDataFrame(rows, "source STRING, weight DOUBLE")
    return cut_lineage(weights.select(F.col("source").alias("_source"), F.col("weight").alias("_weight")))


def mixed(
    documents: DataFrame,
    weights: Mapping[str | None, float] | DataFrame,
    block: int = BLOCK,
    period: int | None = None,
) -> DataFrame:
    """Where each row of ``documents`` (doc_id, source, place) comes in the mix.

    Returns _file, _at, doc_id, source, block, slot, position. ``weights`` is a mapping or has the columns source and
    weight; with a ``period``, its whole shares are used instead of the weights themselves. Inside a source, documents
    come in the order of a hash of their id, so that a block is no stretch of the input; repeated ids in the order of
    their place. NULL is a source like any other. Positions run from 0 without gaps over all rows; none is dropped or
    repeated. All sources need a weight; without documents there are no rows.
    """
    spark = documents.sparkSession
    casts = [F.col(name).cast(kind).alias(name) for name, kind in (("doc_id", "long"), ("source", "string"))]
    rows = documents.select("_file", "_at", *casts)
    target = _weights(spark, weights)
    if target.filter(~(F.col("_weight") > 0) | F.col("_weight").isNull() | (F.col("_weight") == float("inf"))).take(1):
        raise ValueError("weights have to be positive")
    sizes = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).alias("_blocks"))
    sizes = cut_lineage(target.join(sizes, F.col("source").eqNullSafe(F.col("_source")), "full"))
    missing = [row["source"] for row in sizes.filter("_weight IS NULL").select("source").take(3)]
    if missing:
        raise ValueError(f"no weight for {missing}")
    keyed = rows.withColumn("_key", F.xxhash64("doc_id", F.lit(11)))
    numbered = number_within(keyed, ["source"], ["_key", "doc_id", "_file", "_at"], "_n", unique=True)
    numbered = numbered.withColumn("block", F.expr(f"_n div {block}")).withColumn("_in", F.col("_n") % block)
    same = F.col("source").eqNullSafe(F.col("_source"))
    if period is None:
        known = sizes.select("_source", "_weight", F.coalesce("_blocks", F.lit(0)).alias("_blocks"))
        located = numbered.join(_exact_slots(known), same & (F.col("block") == F.col("_block")))
    else:
        slots = {row["_source"]: row["_weight"] for row in target.collect()}
        slots = shares(slots, period) if slots else {}
        plan = [(name, slots[name], at) for name, at in schedule(slots).items()] if slots else []
        # One row per source and one number per slot of a period: a bounded table.
        side = F.broadcast(spark.createDataFrame(plan, "_source STRING, _share INT, _slots ARRAY<BIGINT>"))
        at = (F.col("block") % F.col("_share") + 1).cast("int")
        slot = F.expr("block div _share") * sum(slots.values()) + F.element_at("_slots", at)
        located = numbered.join(side, same).withColumn("slot", slot)
    kept = located.select("_file", "_at", "doc_id", "source", "block", "slot", "_in")
    return number_within(kept, [], ["slot", "_in"], "position", unique=True).drop("_in")


def in_order(documents: DataFrame, weights: Mapping[str | None, float] | DataFrame | None = None) -> DataFrame:
    """All documents with their columns, in partitions that follow the mix and sorted inside them.

    Files written from the result hold the mix in the order of their names.
    """
    rows = stored(documents)
    order = "_position_in_the_mix"
    found = mixed(places(rows, "doc_id", "source"), tempered(documents) if weights is None else weights)
    positions = cut_lineage(found.select("_file", "_at", F.col("position").alias(order)))
    return joined_by_place(rows, positions, "inner").repartitionByRange(order).sortWithinPartitions(order).drop(order)
