"""Star-schema loads and queries.

Dimension joins carry no broadcast hint: Spark broadcasts a side once its size, known from the files or
from the finished stage, is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with
hot keys split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import dates, text
from touchline.operators.pages import PAGE, ordered_text, short_text
from touchline.schemas import FINISHED
from touchline.session import cut_lineage


@dataclass(frozen=True)
class Star:
    """The tables the schedule and result queries read."""

    matches: DataFrame
    competitions: DataFrame
    stages: DataFrame
    teams: DataFrame
    places: DataFrame
    match_status: DataFrame | None = None
    goals: DataFrame | None = None


def schedule(star: Star, season: int | None = None, status_id: int | None = FINISHED) -> DataFrame:
    """Matches with the names of their competition, teams, place and stage."""
    matches = star.matches if status_id is None else star.matches.where(F.col("status_id") == status_id)
    competitions = star.competitions if season is None else star.competitions.where(F.col("year") == season)
    m, c, s = matches.alias("m"), competitions.alias("c"), star.stages.alias("s")
    home, away, p = star.teams.alias("home"), star.teams.alias("away"), star.places.alias("p")
    return (
        m.join(c, F.col("m.competition_id") == F.col("c.id"))
        .join(s, F.col("m.stage_id") == F.col("s.id"))
        .join(home, F.col("m.home_team_id") == F.col("home.id"))
        .join(away, F.col("m.away_team_id") == F.col("away.id"))
        .join(p, F.col("m.place_id") == F.col("p.id"))
        .select(
            F.col("m.id").alias("match_id"),
            F.col("m.status_id").alias("status_id"),
            F.col("c.caption").alias("competition"),
            F.col("c.year").alias("season"),
            F.col("m.date").alias("date"),
            F.col("m.local_date").alias("local_date"),
            F.col("home.name").alias("home_team"),
            F.col("away.name").alias("away_team"),
            F.col("p.city").alias("city"),
            F.col("p.stadium").alias("stadium"),
            F.col("s.title").alias("stage"),
            "m.total_home_goals",
            "m.total_away_goals",
            "m.penalty_shootout_home_goals",
            "m.penalty_shootout_away_goals",
            text.flag_image(F.col("home.short_name2")).alias("image_path_home"),
            text.flag_image(F.col("away.short_name2")).alias("image_path_away"),
        )
    )


def goals_per_match(goals: DataFrame, order: Sequence[str] = ("id",), page: int = PAGE) -> DataFrame:
    """(match_id, text_part, text): the goal lines of each match in order, separated by commas."""
    return ordered_text(goals, ["match_id"], order, "text", "text", part="text_part", page=page)


def goal_texts(
    goals: DataFrame, games: DataFrame, order: Sequence[str] = ("id",), page: int = PAGE, few: int = PAGE
) -> DataFrame:
    """The rows of :func:`goals_per_match` for the matches of ``games`` (match_id, n_goals).

    Only goals of these matches are ordered. A match with up to ``few`` goals has them in one list; those with more, of
    which there are few, take the way for lists of any length.
    """
    def of(matches: DataFrame) -> DataFrame:
        wanted = matches.select(F.col("match_id").alias("_wanted"))
        return goals.join(wanted, goals["match_id"] == wanted["_wanted"], "left_semi")

    texts = short_text(of(games.where(F.col("n_goals") <= few)), ["match_id"], order, "text", "text", "text_part", page=page)
    many = cut_lineage(games.where(F.col("n_goals") > few).select("match_id").distinct())
    if many.isEmpty():
        return texts
    return texts.unionByName(goals_per_match(of(many), order, page))


def results_of(
    played: DataFrame,
    match_status: DataFrame,
    goals: DataFrame,
    goal_order: Sequence[str] = ("id",),
    how: str = "inner",
    strict: bool = False,
    page: int = PAGE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Schedule rows (:func:`schedule`) with status, goal text and score, plus the columns in ``keep``.

    With the inner join matches without goals drop out. A match with more than ``page`` goals has one row
    per part of its goal text.
    """
    return results_with(played, match_status, goals_per_match(goals, goal_order, page), how, strict, keep)


def results_with(
    played: DataFrame,
    match_status: DataFrame,
    texts: DataFrame,
    how: str = "inner",
    strict: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """As :func:`results_of`, with the goal texts (match_id, text_part, text) that somebody has made."""
    m, ms = played.alias("m"), match_status.alias("ms")
    lines = texts.withColumnRenamed("match_id", "_goal_match")
    score = text.score_text(
        F.col("total_home_goals"), F.col("total_away_goals"),
        F.col("penalty_shootout_home_goals"), F.col("penalty_shootout_away_goals"), strict,
    )
    return (
        m.join(ms, F.col("m.status_id") == F.col("ms.id"))
        .join(lines, F.col("m.match_id") == F.col("_goal_match"), how)
        .select(
            *keep,
            "match_id",
            "competition",
            F.col("ms.status").alias("status"),
            F.col("season").alias("year"),
            dates.kickoff_day(F.col("date")).alias("date"),
            dates.kickoff_clock(F.col("date")).alias("time"),
            "home_team",
            "away_team",
            "city",
            "stadium",
            "stage",
            "total_home_goals",
            "total_away_goals",
            "penalty_shootout_home_goals",
            "penalty_shootout_away_goals",
            F.coalesce(F.col("text_part"), F.lit(0).cast("bigint")).alias("text_part"),
            "text",
            "image_path_home",
            "image_path_away",
            score.alias("result"),
        )
    )


def results(
    star: Star,
    season: int | None = None,
    status_id: int | None = FINISHED,
    goal_order: Sequence[str] = ("id",),
    how: str = "inner",
    strict: bool = False,
    page: int = PAGE,
) -> DataFrame:
    """The result list of the star tables, see :func:`results_of`."""
    return results_of(
        schedule(star, season, status_id), star.match_status, star.goals, goal_order, how, strict, page
    )


def goals_by_season(matches: DataFrame, competitions: DataFrame, goals_of_match: DataFrame) -> DataFrame:
    """Goals, matches and mean goals per match for each championship and season.

    ``goals_of_match`` is (match_id, n_goals): goals are summed per match before they meet the matches.
    Sums per competition id come before its caption and year are looked up.
    """
    m, g = matches.alias("m"), goals_of_match.alias("g")
    sums = (
        m.join(g, F.col("m.id") == F.col("g.match_id"))
        .groupBy("m.competition_id")
        .agg(F.sum("g.n_goals").alias("n_goals"), F.count(F.lit(1)).alias("n_matches"))
    )
    named = sums.join(competitions.alias("c"), F.col("competition_id") == F.col("c.id"))
    return (
        named.groupBy(F.col("c.caption").alias("competition"), F.col("c.year").alias("season"))
        .agg(F.sum("n_goals").alias("n_goals"), F.sum("n_matches").alias("n_matches"))
        .withColumn("goals_per_match", F.col("n_goals") / F.col("n_matches"))
    )


def goal_rows(timeline: DataFrame, link: DataFrame) -> DataFrame:
    """Goal events of linked matches as (id, match_id, player_id, text) rows."""
    events = timeline.where(text.is_goal_type(F.col("TypeLocalized"))).alias("t")
    return events.join(link.alias("x"), F.col("x.match_id_fifa") == F.col("t.IdMatch")).select(
        F.col("t.EventId").alias("id"),
        F.col("x.match_id").alias("match_id"),
        F.col("t.IdPlayer").alias("player_id"),
        text.goal_line(F.col("t.MatchMinute"), F.col("t.EventDescription")).alias("text"),
    )


def corrected_local_dates(
    matches: DataFrame, link: DataFrame, source_matches: DataFrame, hours: Column | int = 2
) -> DataFrame:
    """Local kick-off of matches whose stored date carries a zone sign and whose source has a kick-off."""
    m, x, u = matches.alias("m"), link.alias("x"), source_matches.alias("u")
    return (
        m.where(F.col("m.date").contains("+"))
        .join(x, F.col("m.id") == F.col("x.match_id"), "left")
        .join(u, F.col("x.match_id_uefa") == F.col("u.id"), "left")
        .where(F.col("u.dateTime").isNotNull())
        .select(
            F.col("m.id").alias("id"),
            F.col("u.dateTime").alias("dateTime"),
            F.col("u.utcOffsetInHours").alias("utcOffsetInHours"),
            dates.local_kickoff(F.col("u.dateTime"), hours).alias("date_local"),
        )
    )


def with_local_date(source_matches: DataFrame, name: str = "local_date") -> DataFrame:
    """Kick-off moved by the row's own offset in hours."""
    return source_matches.withColumn(
        name, dates.local_kickoff(F.col("dateTime"), F.col("utcOffsetInHours"))
    )


def canonical_places(places: DataFrame) -> DataFrame:
    """(lat, lng, id): the smallest id at each coordinate pair."""
    return places.groupBy("lat", "lng").agg(F.min("id").alias("id"))


def link_stadiums(stadiums: DataFrame, places: DataFrame) -> DataFrame:
    """(place_id, stadium_id_uefa) for stadiums at the coordinates of a known place."""
    s, p = stadiums.alias("s"), canonical_places(places).alias("p")
    return s.join(
        p, (F.col("s.latitude") == F.col("p.lat")) & (F.col("s.longitude") == F.col("p.lng"))
    ).select(F.col("p.id").alias("place_id"), F.col("s.id").alias("stadium_id_uefa"))


def duplicate_places(places: DataFrame, ordered: bool = True) -> DataFrame:
    """All places that share their coordinates with another one, by stadium.

    Counting and joining back keeps a crowded coordinate out of a single window group; the sort ends in
    the id so that its ranges can cut through equal stadium names.
    """
    crowded = places.groupBy("lat", "lng").agg(F.count(F.lit(1)).alias("n_places")).where(F.col("n_places") > 1)
    shared = places.join(crowded, ["lat", "lng"]).select(*places.columns, "n_places")
    return shared.orderBy("stadium", "id") if ordered else shared


def place_rows(stadiums: DataFrame, place_id: Column, competition_id: Column) -> DataFrame:
    """Stadium rows in the column order of places."""
    return stadiums.select(
        place_id.cast("bigint").alias("id"),
        F.col("name").alias("stadium"),
        F.col("cityName").alias("city"),
        text.short_name(F.col("name")).alias("short_name"),
        F.col("capacity").cast("int").alias("capacity"),
        competition_id.cast("bigint").alias("competition_id"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lng"),
    )


def fact_rows(
    source_matches: DataFrame,
    star: Star,
    stadium_links: DataFrame,
    season: int | None = None,
    league: str | None = None,
    collation: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Source matches as rows of the matches fact table.

    Stage, season and both team codes must be known; place and status may be missing. Competitions are
    found by year alone, so two competitions of a year double its matches unless ``league`` picks one.
    ``collation`` (for example UTF8_LCASE) compares titles and codes under that collation.
    """

    def same(left: Column, right: Column) -> Column:
        return left == right if collation is None else F.collate(left, collation) == F.collate(right, collation)

    source = source_matches if season is None else source_matches.where(F.col("seasonYear") == season)
    competitions = star.competitions if league is None else star.competitions.where(F.col("league") == league)
    u = source.withColumn("stage_name", text.stage_name(F.col("groupName"), F.col("roundName"))).alias("u")
    s, c, l = star.stages.alias("s"), competitions.alias("c"), stadium_links.alias("l")
    home, away = star.teams.alias("home"), star.teams.alias("away")
    p, ms = star.places.alias("p"), star.match_status.alias("ms")
    rows = (
        u.join(s, same(F.col("u.stage_name"), F.col("s.title")))
        .join(c, F.col("c.year") == F.col("u.seasonYear"))
        .join(home, same(F.col("home.short_name"), F.col("u.homeTeamcountryCode")))
        .join(away, same(F.col("away.short_name"), F.col("u.awayTeamcountryCode")))
        .join(l, F.col("l.stadium_id_uefa") == F.col("u.stadiumId"), "left")
        .join(p, F.col("l.place_id") == F.col("p.id"), "left")
        .join(ms, same(F.col("ms.status"), F.lower(F.col("u.status"))), "left")
        .select(
            F.col("u.id").alias("id"),
            F.col("c.id").alias("competition_id"),
            F.col("p.id").alias("place_id"),
            F.col("s.id").alias("stage_id"),
            F.col("ms.id").alias("status_id"),
            F.col("u.dateTime").alias("date"),
            dates.local_kickoff(F.col("u.dateTime"), F.col("u.utcOffsetInHours")).alias("local_date"),
            F.col("home.id").alias("home_team_id"),
            F.col("away.id").alias("away_team_id"),
            F.col("u.scoreRegularHome").alias("goals_home_team"),
            F.col("u.scoreRegularAway").alias("goals_away_team"),
            F.col("u.scoreTotalHome").alias("total_home_goals"),
            F.col("u.scoreTotalAway").alias("total_away_goals"),
            F.col("u.scorePenaltyHome").alias("penalty_shootout_home_goals"),
            F.col("u.scorePenaltyAway").alias("penalty_shootout_away_goals"),
            F.col("u.matchNumber").alias("game_order"),
        )
    )
    return rows.orderBy("id", "competition_id") if ordered else rows


def crowded_seasons(competitions: DataFrame) -> DataFrame:
    """(year, n_competitions) of the seasons in which the fact load repeats matches."""
    return competitions.groupBy("year").agg(F.count(F.lit(1)).alias("n_competitions")).where(
        F.col("n_competitions") > 1
    )


def with_status_id(matches: DataFrame, match_status: DataFrame, column: str = "status") -> DataFrame:
    """Matches with the id of their status text; unknown texts keep the row with a NULL id."""
    seed = match_status.select(F.col("id").alias("status_id"), F.col("status").alias("_status"))
    return matches.join(seed, F.lower(F.col(column)) == F.col("_status"), "left").drop("_status")


def with_stage_id(matches: DataFrame, stages: DataFrame, column: str = "stage") -> DataFrame:
    """Matches with the id of their stage title; unknown titles keep the row with a NULL id."""
    seed = stages.select(F.col("id").alias("stage_id"), F.col("title").alias("_title"))
    return matches.join(seed, F.col(column) == F.col("_title"), "left").drop("_title")
