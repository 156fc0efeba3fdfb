"""Relational scans. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def equal_to(conditions: Mapping[str, Any] | None) -> Column:
    """All conditions at once; a None value asks for NULL."""
    tests = [
        F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        for name, value in (conditions or {}).items()
    ]
    return reduce(lambda left, right: left & right, tests, F.lit(True))


def rows_where(table: DataFrame, conditions: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows of a table meeting every equality condition; over JDBC Spark sends the filter to the database."""
    return table.where(equal_to(conditions)) if conditions else table


def jdbc_table(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; with a partition column the scan runs as that many parallel range reads."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    for name, value in partition_options(partition_column, bounds, partitions).items():
        reader = reader.option(name, value)
    return reader.load()


def partition_options(
    column: str | None, bounds: tuple[Any, Any] | None, partitions: int | None
) -> dict[str, str]:
    if column is None:
        return {}
    if bounds is None or not partitions:
        raise ValueError("a partitioned scan needs bounds and a number of partitions")
    return {
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def query_options(
    query: str, column: str | None = None, bounds: tuple[Any, Any] | None = None, partitions: int | None = None
) -> dict[str, str]:
    """Options of a query scan: as it is in one task, or as a derived table that is read in ranges of a column."""
    ranges = partition_options(column, bounds, partitions)
    return {"dbtable": f"({query}) q", **ranges} if ranges else {"query": query}


def jdbc_query(
    spark: SparkSession,
    query: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The rows of a query the database runs; with a column of the result, in parallel range reads."""
    settings = {**options, **query_options(query, partition_column, bounds, partitions)}
    return spark.read.format("jdbc").options(**settings).load()


def query_tables(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The rows of a query over the given frames, named in braces: ``SELECT … FROM {matches}``."""
    return spark.sql(query, **tables)
