"""Shaping landed match records into stages, days and buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import dates, text
from touchline.operators.pages import PAGE, paged_list
from touchline.schemas import PLAYER_EVENTS, STADIUM_DOCUMENT


def stage_and_day(matches: DataFrame) -> DataFrame:
    """Landed match records plus ``stage_name`` (group, else round) and the compact ``date``."""
    stage = text.stage_name(F.col("group.metaData.groupName"), F.col("round.metaData.name"))
    return matches.withColumn("stage_name", text.named_stage(stage)).withColumn(
        "date", dates.compact_day(F.col("kickOffTime.date"))
    )


def explode_calendar(calendar: DataFrame, day: str | None = None) -> DataFrame:
    """One row per calendar match with its stage, UTC day and year; only one day when ``day`` is given."""
    rows = calendar.select(*[c for c in calendar.columns if c != "matches"], F.explode("matches").alias("_match"))
    rows = rows.select(*[c for c in rows.columns if c != "_match"], "_match.*")
    rows = (
        rows.withColumn("stage_name", text.named_stage(F.col("stage_name")))
        .withColumn("date", dates.unix_day(F.col("time")))
        .withColumn("year", dates.unix_year(F.col("time")))
    )
    return rows if day is None else rows.where(F.col("date") == day)


def match_days(matches: DataFrame, column: str = "date") -> DataFrame:
    """Distinct days, newest first."""
    return matches.select(column).distinct().orderBy(F.col(column).desc())


def stage_names(matches: DataFrame) -> DataFrame:
    return matches.select("stage_name").distinct()


def stage_day_buckets(
    matches: DataFrame, match_id: str = "id", ordered: bool = True, page: int = PAGE
) -> DataFrame:
    """(stage_name, date, part, n_rows, match_ids): the matches of every stage and day that occur.

    One aggregation replaces testing every stage against every day; long buckets continue in further parts.
    """
    buckets = paged_list(matches, ["stage_name", "date"], [match_id], match_id, "match_ids", page=page)
    return buckets.orderBy("stage_name", "date", "part") if ordered else buckets


def scorers(timeline: DataFrame, events: str = "playerEvents") -> DataFrame:
    """One row per scorer of the player-events document; documents without scorers give none."""
    document = F.from_json(F.col(events), PLAYER_EVENTS)
    rows = timeline.select("id", F.explode(document["scorers"]).alias("s"))
    player = F.col("s.player.translations.name.EN")
    code = F.col("s.player.countryCode")
    minute = F.col("s.time.minute")
    return rows.select(
        "id",
        player.alias("player"),
        code.alias("countryCode"),
        minute.alias("minute"),
        F.col("s.time.second").alias("second"),
        text.scorer_line(minute, player, code).alias("text"),
    )


def stadium_dimension(timeline: DataFrame) -> DataFrame:
    """Distinct stadiums per season out of the stadium document.

    Every output column follows from (document, season), so duplicates go before anything is parsed.
    """
    distinct = timeline.select("stadium", "seasonYear").distinct()
    parsed = distinct.withColumn("d", F.from_json("stadium", STADIUM_DOCUMENT))

    def unquoted(path: str):
        return F.replace(F.col(path), F.lit('"'), F.lit(""))

    return parsed.select(
        unquoted("d.id").alias("id"),
        unquoted("d.city.id").alias("city_id"),
        unquoted("d.city.translations.name.EN").alias("city_name"),
        unquoted("d.translations.name.EN").alias("name"),
        F.col("d.geolocation.latitude").alias("lat"),
        F.col("d.geolocation.longitude").alias("lng"),
        "seasonYear",
        "stadium",
    )
