"""Readers of landed JSON and CSV feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import compact_day, strict_day
from touchline.operators.staging import named_like
from touchline.schemas import as_struct

Schema = str | T.StructType


def _check_single_documents(spark: SparkSession, path: str) -> None:
    """Fail if a file's first line is a whole JSON object or array and more lines follow it.

    Only first lines of files with several lines are parsed.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "value"
    ).where(F.trim("value") != "")
    first = lines.groupBy("file").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    if first.isEmpty():
        return
    starts = lines.join(first.withColumnRenamed("file", "_file"), (F.col("file") == F.col("_file")) & (F.col("at") == F.col("first")))
    whole = F.col("value").rlike(r"^\s*[\[{]") & F.try_parse_json("value").isNotNull()
    bad = starts.where(whole).select("file").first()
    if bad is not None:
        raise ValueError(f"{bad[0]} holds one document per line; read it with json_lines")


def read_records(spark: SparkSession, path: str, schema: Schema, json_lines: bool = False) -> DataFrame:
    """Records of JSON responses: a bare array per file, or one record per line.

    Line files can be split between tasks; an array file is read by one task, so keep responses small. Files that turn
    out to hold one record per line aren't read as arrays: all records but the first of each would be lost.
    """
    if not json_lines:
        _check_single_documents(spark, path)
    return spark.read.schema(schema).option("multiLine", not json_lines).json(path)


def read_keyed(
    spark: SparkSession, root: str, schema: Schema, keys: Schema, json_lines: bool = False
) -> DataFrame:
    """Responses landed in folders named by their request, such as ``match_id=7`` or ``tag=cup/date=20200612``.

    ``keys`` declares the folder names and types; they become columns, and filters on them skip folders.
    """
    whole = T.StructType(as_struct(schema).fields + as_struct(keys).fields)
    return read_records(spark, root, whole, json_lines)


def read_envelopes(
    spark: SparkSession, path: str, record: Schema, field: str = "Results", json_lines: bool = False
) -> DataFrame:
    """Records listed below ``field`` of each response; an empty or missing list gives no rows."""
    envelope = T.StructType([T.StructField(field, T.ArrayType(as_struct(record)))])
    return read_records(spark, path, envelope, json_lines).select(F.inline(field))


def read_calendar(
    spark: SparkSession,
    path: str,
    match: Schema,
    json_lines: bool = False,
    stage: str = "stage_name",
    keys: Schema | None = None,
) -> DataFrame:
    """Calendar stages, each with its ``matches`` array (see ``shaping.explode_calendar``).

    ``keys`` declares the folders of a feed that holds the calendars of many tournaments.
    """
    schema = T.StructType([T.StructField(stage, T.StringType()), T.StructField("matches", T.ArrayType(as_struct(match)))])
    return read_keyed(spark, path, schema, keys or T.StructType(), json_lines)


def read_tournaments(
    spark: SparkSession, path: str, schema: Schema, name: str | None = None, json_lines: bool = False
) -> DataFrame:
    """Tournament or season records, optionally only those whose name contains the pattern."""
    return named_like(read_records(spark, path, schema, json_lines), "name", name)


def read_ratings(spark: SparkSession, path: str, schema: Schema, day: str, entity: str = "rating") -> DataFrame:
    """A rating feed of one day with lower-case key columns and its year, date and entity."""
    rows = spark.read.schema(schema).option("header", "true").csv(path)
    return (
        rows.withColumnRenamed("Country", "country")
        .withColumnRenamed("Club", "club")
        .withColumn("year", F.year(strict_day(F.lit(day))))
        .withColumn("date", compact_day(F.lit(day)))
        .withColumn("entity", F.lit(entity))
    )
