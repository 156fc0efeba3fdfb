"""Key, uniqueness and null reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.schemas import FOREIGN_KEYS, REQUIRED_COLUMNS, STAR_SCHEMA


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key_value, n_rows): child keys no parent row has. NULL keys are allowed.

    The child is counted per key first, so a hot key reaches the join as one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key_value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = parent.select(F.col(parent_column).alias("_known"))
    return used.join(known, used["key_value"] == known["_known"], "left_anti")


def foreign_key_violations(
    tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str, str, str]] = FOREIGN_KEYS
) -> DataFrame:
    """(child_table, child_column, parent_table, key_value, n_rows) over all keys whose tables are given.

    Each child is scanned once for all of its keys and each parent once for all keys that refer to it. Their values are
    tagged with the number of the key and meet in one aggregation, in which hot values have been counted before the
    shuffle: those no parent has are left. Values are whole numbers.
    """
    checked = [key for key in keys if key[0] in tables and key[2] in tables]
    number = {key: i for i, key in enumerate(checked)}

    def tagged(df: DataFrame, entries: Sequence[tuple[int, str]], known: bool) -> DataFrame:
        pairs = [F.struct(F.lit(tag).alias("_tag"), F.col(c).cast("bigint").alias("key_value")) for tag, c in entries]
        values = df.select(F.inline(F.array(*pairs))).where(F.col("key_value").isNotNull())
        return values.select("*", F.lit(known).alias("_known"))

    sides = [
        tagged(tables[name], [(number[key], key[at + 1]) for key in checked if key[at] == name], known)
        for at, known in ((0, False), (2, True))
        for name in dict.fromkeys(key[at] for key in checked)
    ]
    missing = (
        reduce(DataFrame.union, sides)
        .groupBy("_tag", "key_value")
        .agg(F.count_if(~F.col("_known")).alias("n_rows"), F.bool_or("_known").alias("_known"))
        .where(~F.col("_known"))
    )
    names = F.array(
        *[
            F.struct(F.lit(key[0]).alias("child_table"), F.lit(key[1]).alias("child_column"), F.lit(key[2]).alias("parent_table"))
            for key in checked
        ]
    )
    return missing.select(F.get(names, F.col("_tag")).alias("k"), "key_value", "n_rows").select("k.*", "key_value", "n_rows")


def unique_violations(df: DataFrame, columns: Sequence[str] = ("id",)) -> DataFrame:
    """Key values that occur more than once; as in a UNIQUE constraint, NULL may repeat."""
    known = reduce(lambda left, right: left & right, [F.col(column).isNotNull() for column in columns])
    return df.where(known).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique_report(tables: Mapping[str, DataFrame], names: Sequence[str] = tuple(STAR_SCHEMA)) -> DataFrame:
    """(table_name, id, n_rows) of repeated ids over all star tables given."""
    reports = [
        unique_violations(tables[name]).select(
            F.lit(name).alias("table_name"), F.col("id").cast("bigint").alias("id"), "n_rows"
        )
        for name in names
        if name in tables
    ]
    return reduce(DataFrame.unionByName, reports)


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, n_null), counted in one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
    entries = [F.struct(F.lit(column).alias("column_name"), F.col(column).alias("n_null")) for column in columns]
    return counted.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))


def null_violations(
    tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS
) -> DataFrame:
    """Null counts of all required columns that hold NULLs."""
    reports = [null_counts(tables[name], name, columns) for name, columns in required.items() if name in tables]
    return reduce(DataFrame.unionByName, reports).where(F.col("n_null") > 0)
