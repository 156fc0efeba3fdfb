"""Ordered lists per key, cut into pages of a fixed length.

Every key comes as rows with part 0, 1, 2, …, of ``page`` entries each but the last; together they hold the whole
list. Columns and order are the same for keys and tables of any size.

Lists are made by merging runs. Rows are range partitioned by key and order once, and each task folds its sorted rows
into runs of at most ``page`` values of one key before anything else is shuffled; the runs are the only rows that are
written. A key with one run is done. For the others, which are those cut by a task's or a run's end, only the number
of values before each run is worked out, and runs are cut and put together at page ends. No row gets a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.numbering import LOCAL_BITS, join_same
from touchline.session import cut_lineage

# Long enough that a real key has one part, short enough that a part is a modest row.
PAGE = 10_000
_COPIES = 1 << 16  # copies of a row that are listed at once


def paged_list(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    part: str = "part",
    page: int = PAGE,
    unique: bool = False,
) -> DataFrame:
    """(keys…, part, n_rows, name): the values of each key as ordered arrays of ``page`` entries.

    Entries go by ``order``, then by value. NULL values count as rows but are skipped in lists, as aggregates do.
    ``unique`` says that no two rows agree in keys, order and value, which spares counting copies.
    """
    runs = cut_lineage(_runs(df, keys, order, value, page, unique))
    before = cut_lineage(_values_before(runs, keys))
    listed = F.filter("_values", lambda v: v.isNotNull()).alias(name)
    whole = runs.join(before, "_from", "left_anti").select(
        *keys, F.lit(0).cast("bigint").alias(part), F.col("_n").alias("n_rows"), listed
    )
    pages = F.explode(F.expr(f"sequence(_before div {page}, (_before + _n - 1) div {page})")).alias(part)
    pieces = runs.join(before, "_from").select("*", pages)
    low = F.greatest(F.lit(0), F.col(part) * page - F.col("_before"))
    high = F.least(F.col("_n"), (F.col(part) + 1) * page - F.col("_before"))
    piece = F.struct("_from", F.slice("_values", low.cast("int") + 1, (high - low).cast("int")).alias("values"))
    merged = (
        pieces.select(*keys, part, (high - low).alias("_n"), piece.alias("_piece"))
        .groupBy(*keys, part)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.flatten(F.sort_array(F.collect_list("_piece")).getField("values")).alias("_values"),
        )
        .select(*keys, part, "n_rows", listed)
    )
    return whole.unionByName(merged)


def _single(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with ``_copy`` numbered from 0 for copies: what tells rows apart doesn't depend on their place."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.select("*", F.explode(F.expr(f"sequence(0, (_n - 1) div {_COPIES})")).alias("_block"))
    copies = F.expr(f"sequence(_block * {_COPIES}, least(_n, (_block + 1) * {_COPIES}) - 1)")
    return blocks.select(*columns, F.explode(copies).alias("_copy"))


def _runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, page: int, unique: bool) -> DataFrame:
    """(keys…, _from, _n, _values): sorted runs of at most ``page`` values of a key, with the place of their first.

    The ranges cut through a key with many rows, also through copies. A row's place is its task and its position there,
    so places are in the order of keys and entries.
    """
    columns = list(dict.fromkeys([*keys, *order, value]))
    rows, ranges = df.select(*columns), columns
    if not unique:
        rows, ranges = _single(rows, columns), [*columns, "_copy"]
    sorted_rows = rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    placed = sorted_rows.withColumn("_at", F.monotonically_increasing_id())
    # The rows of a group lie in one task, which folds them into one array before the shuffle.
    entries = F.sort_array(F.collect_list(F.struct("_at", F.col(value).alias("v"))))
    return (
        placed.groupBy(*keys, F.expr(f"_at div {page}").alias("_run"))
        .agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"), entries.getField("v").alias("_values"))
        .drop("_run")
    )


def _values_before(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_from, _before): the number of values of its key before each run, for keys with several runs."""
    narrow = runs.select(*keys, "_from", "_n", F.shiftright("_from", LOCAL_BITS).alias("_task"))
    # Summed per task first: the window over a key has a row per task, the one inside a task a row per run.
    tasks = narrow.groupBy(*keys, "_task").agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_pieces"))
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    several = tasks.withColumns(
        {"_earlier": F.coalesce(F.sum("_total").over(earlier), F.lit(0)), "_all": F.sum("_pieces").over(of_key)}
    ).where("_all > 1")
    inside = Window.partitionBy(*keys, "_task").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    joined = join_same(narrow, several.select(*keys, "_task", "_earlier"), [*keys, "_task"])
    return joined.select(
        "_from", (F.col("_earlier") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_before")
    )


def joined_text(values: Column, separator: str = ",") -> Column:
    """The list as one text; NULL when it is empty."""
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    part: str = "part",
    separator: str = ",",
    page: int = PAGE,
    unique: bool = False,
) -> DataFrame:
    """(keys…, part, name): the values of each key as ordered, separated text without truncation."""
    paged = paged_list(df, keys, order, value, "_list", part, page, unique)
    return paged.select(*keys, part, joined_text(F.col("_list"), separator).alias(name))


def short_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    part: str = "part",
    separator: str = ",",
    page: int = PAGE,
) -> DataFrame:
    """The rows of :func:`ordered_text`, for keys that are known to have few rows each.

    A key's rows meet once and are sorted in its list, so nothing is sampled, sorted over all keys or written. Rows that
    lie by key already, after a join on it, aren't moved again.
    """
    entry = F.struct(*dict.fromkeys([*order, value]))
    listed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    values = F.col("_list").getField(value)

    def text_of(number: Column) -> Column:
        some = F.slice(values, (number * page).cast("int") + 1, F.lit(page))
        return F.struct(number.alias(part), joined_text(F.filter(some, lambda v: v.isNotNull()), separator).alias(name))

    parts = F.transform(F.expr(f"sequence(0L, (size(_list) - 1) div {page})"), text_of)
    return listed.select(*keys, F.inline(parts))
