"""Table writers: appends with a load stamp, table creation and JSON documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import as_struct
from touchline.session import cut_lineage


def stamped(df: DataFrame, column: str = "dt_updated") -> DataFrame:
    """Rows with the time of the load."""
    return df.withColumn(column, F.current_timestamp())


def in_column_order(df: DataFrame, target: str | T.StructType) -> DataFrame:
    """The target's columns in the target's order, cast to its types; columns ``df`` lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in as_struct(target).fields
        ]
    )


def append_table(df: DataFrame, path: str) -> None:
    """Append to a Parquet table, which is created when missing."""
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, table: str, options: Mapping[str, str], column_types: str | None = None) -> None:
    """Append to a database table, which is created when missing.

    Each task commits its rows in one transaction. Keep speculation off: a second copy of a task would
    append its rows again.
    """
    writer = df.write.format("jdbc").mode("append").options(**options).option("dbtable", table)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()


def create_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "errorifexists", path: str | None = None
) -> None:
    """Create a catalog table from a query, at ``path`` when given."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Create a catalog table or put the query's rows in place of all of its rows.

    The rows are written aside first, so the query may read the table it replaces.
    """
    cut_lineage(df).write.mode("overwrite").format("parquet").saveAsTable(name)


def replace_partitions(df: DataFrame, name: str, partition: str) -> None:
    """Create a catalog table partitioned by a column, or replace the partitions the query has rows for."""
    placed = df.select(*[column for column in df.columns if column != partition], partition)
    if not df.sparkSession.catalog.tableExists(name):
        create_table(placed, name, [partition])
        return
    rows = cut_lineage(placed)
    in_column_order(rows, df.sparkSession.table(name).schema).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).insertInto(name)


def insert_rows(df: DataFrame, name: str) -> None:
    """Append to a catalog table, with the columns put into the table's order and types."""
    in_column_order(df, df.sparkSession.table(name).schema).write.insertInto(name)


def write_documents(documents: DataFrame, path: str, column: str = "document", keys: Sequence[str] = ()) -> None:
    """One JSON document per line, optionally in folders by key."""
    writer = documents.select(*keys, F.col(column).alias("value")).write.mode("overwrite")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.text(path)
