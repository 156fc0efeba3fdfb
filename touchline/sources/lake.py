"""Scans of the partitioned Parquet lake and selection of its partitions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from enum import Enum

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import as_struct
from touchline.sinks.commits import CommitLog, Files

PARTITION_COLUMNS = ("tournament_id", "year", "stage_name", "date")
MATCH_PARTITION_COLUMNS = (*PARTITION_COLUMNS, "match_id")
_PARTITION_TYPES = {
    "tournament_id": T.LongType(),
    "year": T.IntegerType(),
    "stage_name": T.StringType(),
    "date": T.StringType(),
    "match_id": T.LongType(),
}
Schema = str | T.StructType

# Folder values in both layouts, k=v and bare: /52/2020/Final/2020-06-12/
_PATH = (
    r"^.*/(?:tournament_id=)?(\d+)/(?:year=)?(\d+)/(?:stage_name=)?([^/]+)"
    r"/(?:date=)?(\d{8}|\d{4}-\d{2}-\d{2})(?:/.*)?$"
)


class SearchOption(Enum):
    ALL = 1
    TOURNAMENT_YEAR = 2
    TOURNAMENT_YEAR_DATE = 3


def lake_schema(data: Schema, partitions: tuple[str, ...] = PARTITION_COLUMNS) -> T.StructType:
    """File columns plus typed partition columns. A declared schema spares the footer reads."""
    fields = [field for field in as_struct(data).fields if field.name not in partitions]
    return T.StructType(fields + [T.StructField(name, _PARTITION_TYPES[name]) for name in partitions])


def scan_glob(
    spark: SparkSession,
    root: str,
    pattern: str = "*/*/*/*/*.parquet",
    schema: Schema | None = None,
) -> DataFrame:
    """All partitions of the files below ``root`` that match ``pattern``; folder values become columns."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        return in_force(reader.schema(schema).parquet(f"{root}/{pattern}"), root)
    found = in_force(reader.parquet(f"{root}/{pattern}"), root)
    return found.withColumns(
        {name: F.col(name).cast(kind) for name, kind in _PARTITION_TYPES.items() if name in found.columns}
    )


def scan_lake(
    spark: SparkSession,
    root: str,
    schema: Schema,
    tournament_id: int | None = None,
    year: int | None = None,
) -> DataFrame:
    """The k=v lake below ``root``. Giving the leading folders spares listing all the others."""
    path = root
    if tournament_id is not None:
        path += f"/tournament_id={tournament_id}"
        if year is not None:
            path += f"/year={year}"
    try:
        return in_force(spark.read.schema(schema).option("basePath", root).parquet(path), root)
    except AnalysisException as error:
        if path != root and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_entity(
    spark: SparkSession, root: str, entity: str, depth: int = 4, schema: Schema | None = None
) -> DataFrame:
    """One entity of a lake that keeps ``<entity>.parquet`` at the end of every partition path."""
    return scan_glob(spark, root, "/".join(["*"] * depth + [f"{entity}.parquet"]), schema)


def scan_files(spark: SparkSession, paths: list[str], schema: Schema | None = None) -> DataFrame:
    """A list of files or folders as one frame; columns only some of them have are NULL elsewhere."""
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def _plain(value: Column) -> Column:
    """A URL-escaped text decoded once; a plus stays one."""
    return F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


# Characters Spark escapes in folder names, besides control characters.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")


def partition_folder(values: Iterable[tuple[str, str | None]]) -> str:
    """The k=v path of some partition values, as Spark writes it."""

    def escaped(text: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in text)

    return "/".join(f"{escaped(k)}={escaped(v) if v else '__HIVE_DEFAULT_PARTITION__'}" for k, v in values)


def _below(path: Column, root: str) -> Column:
    """A file's path from ``root`` on."""
    return F.ltrim(F.substring_index(path, re.sub("^[a-z0-9]+:/+", "/", root.rstrip("/")), -1), F.lit("/"))


def listing(
    spark: SparkSession, root: str, columns: Sequence[str] = (), below: Sequence[str] | None = None
) -> DataFrame:
    """(file, length, partition columns…): the files of a lake and the values of their folders, as text.

    Only folders are read, no file is opened. ``file`` starts below ``root``. ``below`` names folders to look at instead
    of all; those that don't exist are skipped.
    """
    files = Files(spark, root)
    paths = [""] if below is None else below
    found = [f"{files.root}/{name}".rstrip("/") for name in paths if files.exists(name)]
    if not found:
        kinds = ", ".join(f"`{column}` STRING" for column in columns)
        return spark.createDataFrame([], f"file STRING, length BIGINT{', ' * bool(kinds)}{kinds}")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(found)
    file = _below(F.col("path"), root)
    values = {column: F.regexp_extract(F.concat(F.lit("/"), file), f"/{column}=([^/]*)/", 1) for column in columns}
    return rows.select(
        file.alias("file"),
        "length",
        *[F.when(v != "__HIVE_DEFAULT_PARTITION__", _plain(v)).alias(column) for column, v in values.items()],
    )


def partitions(spark: SparkSession, root: str, columns: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """(partition columns…, n_files, n_bytes) of the folders below ``root``, from their names alone."""
    return (
        listing(spark, root, columns)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    )


def _folder(file: Column) -> Column:
    return F.regexp_replace(file, "/[^/]*$", "")


def _is_of(file: Column, name: str) -> Column:
    return F.substring_index(file, "/", -1).startswith(name)


def files_of_set(spark: SparkSession, root: str, commit: Mapping) -> DataFrame:
    """(file) of a written set; see ``touchline.sinks.lake``."""
    return listing(spark, root).where(_is_of(F.col("file"), commit["set"])).select("file")


def replaced_files(spark: SparkSession, root: str, commit: Mapping) -> DataFrame:
    """(file) of all files a published set has replaced: the others in its folders, and those it covers."""
    covers = commit["covers"]
    found = listing(spark, root, commit["columns"], commit["below"])
    mine = _is_of(F.col("file"), commit["set"])
    folders = found.where(mine).select(_folder(F.col("file")).alias("_folder")).distinct()
    others = found.where(~mine)
    replaced = others.join(folders, _folder(F.col("file")) == F.col("_folder"), "left_semi").select("file")
    if covers:
        replaced = replaced.unionByName(others.where(covers).select("file")).distinct()
    return replaced


def in_force(rows: DataFrame, root: str) -> DataFrame:
    """Rows of a lake's files without those of a set that isn't published or of files one has replaced."""
    spark = rows.sparkSession
    newest = CommitLog(spark, root).newest()
    if newest is None or newest["state"] == "clean":
        return rows
    if newest["state"] == "open":
        return rows.where(~F.col("_metadata.file_name").startswith(newest["set"]))
    gone = replaced_files(spark, root, newest).withColumnRenamed("file", "_replaced")
    placed = rows.withColumn("_lake_file", _below(_plain(F.col("_metadata.file_path")), root))
    return placed.join(gone, F.col("_lake_file") == F.col("_replaced"), "left_anti").drop("_lake_file")


def _decoded(value: Column) -> Column:
    # A folder name Spark escaped is escaped once more by the URI.
    return _plain(_plain(value))


def path_columns(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Add year, date, stage_name and tournament_id read from each row's file path.

    Paths of another shape give NULL. Prefer :func:`scan_glob` for k=v folders: it prunes partitions.
    """
    separator = "\u0001"
    source = F.col("_metadata.file_path") if path is None else path
    values = F.when(source.rlike(_PATH), F.regexp_replace(source, _PATH, separator.join(["$1", "$2", "$3", "$4"])))
    split = df.withColumn("_values", F.split(values, separator))
    stage = _decoded(F.col("_values")[2])
    return split.withColumns(
        {
            "year": F.col("_values")[1].cast("int"),
            "date": F.col("_values")[3],
            "stage_name": F.when(stage != "__HIVE_DEFAULT_PARTITION__", stage),
            "tournament_id": F.col("_values")[0].cast("bigint"),
        }
    ).drop("_values")


def select_partitions(
    df: DataFrame,
    option: SearchOption = SearchOption.ALL,
    tournament_id: int | None = None,
    year: int | None = None,
    date: str | None = None,
) -> DataFrame:
    """Rows of the chosen partitions; the predicates only touch partition columns, so others are not read.

    ALL keeps rows matching any criterion given, or everything without one. TOURNAMENT_YEAR needs both
    and takes an optional date; TOURNAMENT_YEAR_DATE needs all three. A missing one selects nothing.
    """
    of_tournament = F.col("tournament_id") == tournament_id if tournament_id is not None else None
    of_year = F.col("year") == year if year is not None else None
    of_date = F.col("date") == date if date else None
    if option is SearchOption.ALL:
        given = [c for c in (of_date, of_year, of_tournament) if c is not None]
        if not given:
            return df
        wanted = given[0]
        for criterion in given[1:]:
            wanted = wanted | criterion
        return df.where(wanted)
    required = [of_tournament, of_year] + ([of_date] if option is SearchOption.TOURNAMENT_YEAR_DATE else [])
    if any(criterion is None for criterion in required):
        return df.where(F.lit(False))
    wanted = of_tournament & of_year
    return df.where(wanted if of_date is None else wanted & of_date)
