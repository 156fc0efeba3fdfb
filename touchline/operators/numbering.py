"""Dense numbering of rows inside groups of any size.

``row_number`` over a group sorts the whole group in one task. Here the rows are range partitioned on
(group, order), so a group with a large share of the rows spans many tasks, and only one row per
(partition, group) is needed to turn local positions into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import cut_lineage

LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def same_key(left: DataFrame, right: DataFrame, names: Sequence[str]):
    """Null-safe equality of the named columns; still an equi-join key for Spark."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def join_same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join on the named columns, in which NULL keys meet too."""
    renamed = right.select(*[F.col(c).alias(f"_same_{c}") if c in names else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(F.col(f"_same_{name}"))
    return left.join(renamed, condition).drop(*[f"_same_{name}" for name in names])


def number_within(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, unique: bool = False
) -> DataFrame:
    """Add ``name``: 0, 1, 2, … per group in the given order; ties are numbered arbitrarily.

    The placed rows are written to the shared folder, so that the counts and the rows see the same
    partition bounds however often a stage runs again. Unless the order is known to be ``unique`` inside
    a group, a row number breaks ties, which lets the ranges also cut through copies that agree in every
    ordering column. A repeated task must give the same numbers again, so they are taken from rows that
    have been written before.
    """
    ranges = [*group, *order]
    rows = df
    if not unique:
        rows = cut_lineage(df).withColumn("_num_tie", F.monotonically_increasing_id())
        ranges.append("_num_tie")
    placed = cut_lineage(
        rows.repartitionByRange(*ranges)
        .sortWithinPartitions(*ranges)
        .withColumn("_num_at", F.monotonically_increasing_id())
        .withColumn("_num_task", F.shiftright("_num_at", LOCAL_BITS))
    )
    runs = placed.groupBy("_num_task", *group).agg(
        F.min("_num_at").alias("_num_from"), F.count(F.lit(1)).alias("_num_rows")
    )
    # A group has at most one run per range partition, so this window never sees more rows than tasks.
    earlier = Window.partitionBy(*group).orderBy("_num_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.withColumn("_num_before", F.coalesce(F.sum("_num_rows").over(earlier), F.lit(0))).drop("_num_rows")
    joined = join_same(placed, cut_lineage(shifts), ["_num_task", *group])
    return joined.select(*df.columns, (F.col("_num_before") + F.col("_num_at") - F.col("_num_from")).alias(name))


def number_by_block(
    df: DataFrame, group: Sequence[str], order: str, name: str, block: int = 1 << 20
) -> DataFrame:
    """Add ``name``: 0, 1, 2, … per group by a whole-number column that is unique inside the group.

    Unique whole numbers put at most ``block`` rows into one block, so blocks are ranked
    independently and shifted by the rows of the blocks before them.
    """
    blocked = df.withColumn("_num_block", F.expr(f"{order} div {block}"))
    sizes = blocked.groupBy(*group, "_num_block").agg(F.count(F.lit(1)).alias("_num_rows"))
    earlier = Window.partitionBy(*group).orderBy("_num_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_num_before", F.coalesce(F.sum("_num_rows").over(earlier), F.lit(0))).drop("_num_rows")
    inside = Window.partitionBy(*group, "_num_block").orderBy(order)
    ranked = blocked.withColumn("_num_rank", F.row_number().over(inside))
    joined = join_same(ranked, sizes, [*group, "_num_block"])
    return joined.select(*df.columns, (F.col("_num_before") + F.col("_num_rank") - 1).alias(name))
