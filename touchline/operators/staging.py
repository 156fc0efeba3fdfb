"""Staging upkeep: duplicates, rolling windows, retention, seasons and unions of differing files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.numbering import number_within, same_key
from touchline.session import cut_lineage


def drop_copies(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies collapse before the shuffle, so a hot row costs one row per task."""
    return df.dropDuplicates()


def _day(as_of: date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def recent_rows(df: DataFrame, column: str, days: int = 30, as_of: date | str | None = None) -> DataFrame:
    """Rows strictly newer than ``days`` days before ``as_of`` (today when not given)."""
    return df.where(F.col(column) > F.date_sub(_day(as_of), days))


def recent_days(spark: SparkSession, column: str, days: int = 30, as_of: date | str | None = None) -> str:
    """The days :func:`recent_rows` takes, as an SQL condition on a column of days as text."""
    start = spark.range(1).select(F.date_sub(_day(as_of), days).cast("string")).first()[0]
    return f"{column} > '{start}'"


def retained_rows(
    df: DataFrame, days: int, column: str = "dt_updated", as_of: date | str | None = None
) -> DataFrame:
    """Rows a staging table keeps when everything older than ``days`` days is cleared."""
    return df.where(is_retained(F.col(column), days, as_of))


def is_retained(stamp: Column, days: int, as_of: date | str | None = None) -> Column:
    """Whether a stamp is at most ``days`` days old; an unknown one isn't older than anything."""
    return stamp.isNull() | (stamp >= F.date_sub(_day(as_of), days))


def union_differing(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column one side lacks becomes NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def named_like(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Rows whose name contains a match of the pattern; all rows without a pattern."""
    return df if not pattern else df.where(F.col(column).rlike(pattern))


def order_seasons(seasons: DataFrame, year: int | None = None) -> DataFrame:
    """Seasons by tournament, newest name first, optionally only those naming a year."""
    kept = named_like(seasons, "name", None if year is None else str(year))
    return kept.orderBy(F.col("tournament_id"), F.col("name").desc(), F.col("id"))


def rank_seasons(seasons: DataFrame, name: str = "season_rank") -> DataFrame:
    """Add the 1-based rank of each season name inside its tournament, newest first.

    Ranks come from the distinct names; these are numbered without putting a tournament into one task.
    """
    names = cut_lineage(seasons.select("tournament_id", F.col("name").alias("season_name")).distinct())
    numbered = number_within(names, ["tournament_id"], ["season_name"], "_up", unique=True)
    totals = names.groupBy("tournament_id").agg(F.count(F.lit(1)).alias("_total"))
    ranks = numbered.join(totals, "tournament_id").select(
        F.col("tournament_id").alias("_tournament"), "season_name", (F.col("_total") - F.col("_up")).alias(name)
    )
    return seasons.join(
        ranks, (seasons["tournament_id"] == ranks["_tournament"]) & (seasons["name"] == ranks["season_name"])
    ).select(*seasons.columns, name)


def latest_season(seasons: DataFrame) -> DataFrame:
    """The most recent season of each tournament."""
    newest = F.max_by(F.struct(*seasons.columns), F.struct("name", "id")).alias("_season")
    return seasons.groupBy("tournament_id").agg(newest).select("_season.*")


def pending(seasons: DataFrame, landed: DataFrame | None = None, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Seasons still to be landed: flag ``is_on_s3`` is 0 and, if given, none of ``landed`` has the key.

    ``landed`` may be rows or the folders of a lake (``touchline.sources.lake.partitions``), which needs no data read.
    """
    todo = seasons.where(F.col("is_on_s3") == 0) if "is_on_s3" in seasons.columns else seasons
    if landed is None:
        return todo
    present = landed.select(*keys).distinct()
    return todo.join(present, same_key(todo, present, keys), "left_anti")
