"""The flows of the platform: feed → lake → staging → warehouse → documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.cleaning import split_rejects
from touchline.operators import shaping, slices, staging, star
from touchline.schemas import MATCHES, as_struct
from touchline.session import cut_lineage  # noqa: F401  (plan tests watch what each module writes)
from touchline.sinks import lake as lake_sink
from touchline.sinks.commits import Files
from touchline.sinks.tables import in_column_order, stamped
from touchline.sources import lake, landed

Schema = str | T.StructType


def _request_columns(**values: tuple[object, str]) -> dict[str, Column]:
    """Literal columns for the given values; those not given come from the feed's folders."""
    return {name: F.lit(value).cast(kind) for name, (value, kind) in values.items() if value is not None}


def land_matches(
    spark: SparkSession,
    feed: str,
    schema: Schema,
    target: str,
    tournament_id: int | None = None,
    year: int | None = None,
    *,
    json_lines: bool,
) -> None:
    """Match responses into the lake by tournament, year, stage and day.

    ``json_lines`` tells whether files hold one record per line or one array. Without tournament and year, ``feed``
    holds folders ``tournament_id=…/year=…`` and the responses of all of them are landed in one job.
    """
    if tournament_id is None:
        records = landed.read_keyed(spark, feed, schema, "tournament_id BIGINT, year INT", json_lines)
    else:
        records = landed.read_records(spark, feed, schema, json_lines)
    keyed = shaping.stage_and_day(records).withColumns(
        _request_columns(tournament_id=(tournament_id, "bigint"), year=(year, "int"))
    )
    lake_sink.write_partitioned(keyed, target)


def land_calendar(
    spark: SparkSession,
    feed: str,
    match: Schema,
    target: str,
    tournament_id: int | None = None,
    day: str | None = None,
    *,
    json_lines: bool,
) -> None:
    """Calendar responses into the lake, by tournament, year, stage and day, sorted by match inside a file.

    ``json_lines`` tells whether files hold one stage per line or one array. Without a tournament, ``feed`` holds
    folders ``tournament_id=…``, all landed in one job.
    """
    keys = "tournament_id BIGINT" if tournament_id is None else None
    rows = shaping.explode_calendar(landed.read_calendar(spark, feed, match, json_lines, keys=keys), day)
    keyed = rows.withColumns(
        {
            **_request_columns(tournament_id=(tournament_id, "bigint")),
            "date": F.replace("date", F.lit("-"), F.lit("")),
            "match_id": F.col("id"),
        }
    )
    lake_sink.write_partitioned(keyed, target, sort_by=("match_id",))


def land_ratings(spark: SparkSession, feed: str, schema: Schema, target: str, day: str) -> None:
    """The rating feed of one day into the rating lake."""
    lake_sink.write_ratings(landed.read_ratings(spark, feed, schema, day), target)


def staging_rows(
    lake_rows: DataFrame,
    config: Mapping[str, str],
    tournament_id: int | None = None,
    year: int | None = None,
    day: str | None = None,
    option: lake.SearchOption = lake.SearchOption.ALL,
) -> tuple[DataFrame, DataFrame]:
    """Selected lake partitions as (rows ready to append to a staging table, rows that can't be read).

    Good rows are typed by the config and stamped; the others keep their raw cells and name the failing columns. No
    unreadable cell becomes a default. All partitions are taken unless an option and its values are given.
    """
    chosen = lake_rows
    if tournament_id is not None or year is not None or day is not None:
        chosen = lake.select_partitions(lake_rows, option, tournament_id, year, day)
    good, rejected = split_rejects(chosen, config)
    return stamped(good), rejected


LOAD_DAY = "load_day"


def append_staging(rows: DataFrame, path: str, column: str = "dt_updated", partition_by: Sequence[str] = ()) -> None:
    """Append to a staging table that is partitioned by the given columns and the day of the load stamp."""
    dated = rows.withColumn(LOAD_DAY, F.col(column).cast("date"))
    dated.write.mode("append").partitionBy(*partition_by, LOAD_DAY).parquet(path)


def clear_staging(spark: SparkSession, path: str, days: int, as_of: date | str | None = None) -> int:
    """Drop the partitions of a staging table whose load day is more than ``days`` days ago; returns how many.

    Load days are read off the folders, no file is opened. Rows of an unknown day stay. Other partitions aren't read or
    written, so rows appended meanwhile are safe, and a run that breaks off can be repeated.
    """
    found = lake.listing(spark, path, [LOAD_DAY])
    if not found.where(F.col(LOAD_DAY) == "").isEmpty():
        raise ValueError(f"{path} is not partitioned by {LOAD_DAY}")
    folder = F.regexp_replace("file", "/[^/]*$", "")
    expired = found.where(~staging.is_retained(F.col(LOAD_DAY).cast("date"), days, as_of)).select(folder).distinct()
    gone = 0
    for some in batched((row[0] for row in expired.toLocalIterator()), 10_000):
        Files(spark, path).delete(some)
        gone += len(some)
    return gone


def pending_seasons(seasons: DataFrame, root: str, keys: Mapping[str, str]) -> DataFrame:
    """Seasons of which the lake at ``root`` has no folder; ``keys`` maps partition columns to columns of the seasons."""
    folders = lake.partitions(seasons.sparkSession, root, list(keys))
    kinds = dict(seasons.dtypes)
    landed = folders.select(*[F.col(folder).cast(kinds[column]).alias(column) for folder, column in keys.items()])
    return staging.pending(seasons, landed, list(keys.values()))


GAME_DAY = "game_day"


def update_game_results(
    results: DataFrame, path: str, column: str = "game_date", days: int = 30, as_of: date | str | None = None
) -> None:
    """Put the distinct staged results of the last ``days`` whole days in place of those days' production rows.

    The table is partitioned by day. A run replaces all days it covers, those without staged results by nothing; runs
    may overlap or be repeated, and readers of :func:`game_results` see a run wholly or not at all.
    """
    dated = results.withColumn(GAME_DAY, F.col(column).cast("date"))
    recent = staging.drop_copies(staging.recent_rows(dated, GAME_DAY, days, as_of))
    covers = staging.recent_days(results.sparkSession, GAME_DAY, days, as_of)
    lake_sink.write_partitioned(recent, path, [GAME_DAY], covers=covers)


def game_results(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """The production rows, with their ``game_day``."""
    full = T.StructType([*as_struct(schema).fields, T.StructField(GAME_DAY, T.DateType())])
    return lake.scan_lake(spark, path, full)


def fact_load(source_matches: DataFrame, tables: star.Star, links: DataFrame, season: int | None = None) -> DataFrame:
    """Source matches in the column order and types of the fact table."""
    return in_column_order(star.fact_rows(source_matches, tables, links, season), MATCHES)


def season_documents(
    tables: star.Star,
    season: int | None = None,
    goal_order: Sequence[str] = ("id",),
    page: int = slices.PAGE,
    block: int = slices.BLOCK,
) -> DataFrame:
    """The slice documents of one season, or of all seasons, over finished matches with goals.

    The schedule is joined once: the numbered games carry what their result rows need. Goals are counted per match
    first; later only the goals of numbered games are read, moved and put into texts.
    """
    games = slices.slice_games(star.schedule(tables, season), keep=slices.RESULT_COLUMNS)
    numbered = slices.number_games(slices.games_with_counts(games, tables.goals))
    texts = star.goal_texts(tables.goals, numbered.select("match_id", "n_goals"), goal_order, page)
    matches = star.results_with(numbered, tables.match_status, texts, keep=("season", "ord"))
    return slices.documents(slices.slices(numbered, page, block=block), matches, block)


def schedule_slices(tables: star.Star, season: int | None = None, page: int = slices.PAGE) -> DataFrame:
    """The slices of finished matches with or without goals, with name-based pictures, by index."""
    games = slices.slice_games(star.schedule(tables, season), "team")
    return slices.slices(slices.number_games(games), page).orderBy(*slices.DOCUMENT, "index", "part")
