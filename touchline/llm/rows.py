"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import cut_lineage

_PLACE = ("_metadata.file_path", "_metadata.row_index")


# Rows of an Arrow batch between Spark and Python. Texts, sets and blocks are large rows: ten thousand of them, the
# usual number, would be held several times on both sides.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _is_scan(df: DataFrame) -> bool:
    """Whether each row of ``df`` is one row of the files it reads, and the same one in every run."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        if not plan.deterministic():
            return False
        plan = plan.child()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def stored(df: DataFrame) -> DataFrame:
    """``df`` if its rows are rows of Parquet files, selected at most, else its rows written to the shared folder.

    Joins, unions, exploded or sampled rows are written: several of them could be made of one row of a file.
    """
    small_batches(df.sparkSession)
    if not _is_scan(df):
        return cut_lineage(df)
    try:
        df.select(*_PLACE)
    except AnalysisException:  # files of another kind, or columns in the way
        return cut_lineage(df)
    return df


def with_place(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_at``: the file a row is stored in and its position there.

    The pair identifies a row whatever its values are and stays the same when the row is read again. Frames that
    don't come straight from Parquet files are written to the shared folder first.
    """
    return stored(df).select("*", F.col(_PLACE[0]).alias("_file"), F.col(_PLACE[1]).alias("_at"))


def places(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns of stored rows, and their place."""
    return df.select(*columns, F.col(_PLACE[0]).alias("_file"), F.col(_PLACE[1]).alias("_at"))


def joined_by_place(df: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Stored rows joined with rows of (_file, _at, …); a bounded number of these is broadcast."""
    # Names that no table has, next to any columns of the stored rows.
    mine, its = ["_place_of_row_file", "_place_of_row_at"], ["_found_place_file", "_found_place_at"]
    keyed = df.select("*", *(F.col(place).alias(name) for place, name in zip(_PLACE, mine)))
    side = found.withColumnsRenamed(dict(zip(("_file", "_at"), its)))
    condition = (F.col(mine[0]) == F.col(its[0])) & (F.col(mine[1]) == F.col(its[1]))
    return keyed.join(small_side(side), condition, how).drop(*mine, *its)


def id_hash(column: str = "doc_id") -> Column:
    """crc32 of an id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def whole(column: str = "text") -> Column:
    """The text itself, empty for NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, found without counting further."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` marked for a broadcast if it was counted to have at most ``rows`` short rows, else as it is."""
    return F.broadcast(df) if bounded(df, rows) else df
