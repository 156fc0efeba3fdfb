"""Declared schemas, keys and seed rows of the warehouse and of the landed feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Schemas are DDL text, which needs no running session; as_struct() turns them into types.


def as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


# ---------------------------------------------------------------- star schema

COMPETITIONS = (
    "id BIGINT, number_of_games BIGINT, number_of_match_days BIGINT, number_of_teams BIGINT, "
    "last_updated STRING, caption STRING, year INT, league STRING, url STRING"
)
TEAMS = "id BIGINT, short_name STRING, short_name2 STRING, name STRING"
PLACES = (
    "id BIGINT, stadium STRING, city STRING, short_name STRING, capacity INT, competition_id BIGINT, "
    "lat DOUBLE, lng DOUBLE"
)
STAGES = "id INT, title STRING"
MATCH_STATUS = "id INT, status STRING"
PLAYERS = (
    "id INT, number INT, image STRING, first_name STRING, last_name STRING, position STRING, "
    "team_id INT, birthdate DATE"
)
GOALS = (
    "id BIGINT, match_id BIGINT, player_id BIGINT, team_id BIGINT, minute INT, second INT, text STRING"
)
MATCHES = (
    "id INT, competition_id BIGINT, place_id BIGINT, stage_id INT, status_id INT, date STRING, "
    "local_date STRING, home_team_id BIGINT, away_team_id BIGINT, goals_home_team INT, goals_away_team INT, "
    "total_home_goals INT, total_away_goals INT, penalty_shootout_home_goals INT, "
    "penalty_shootout_away_goals INT, game_order INT"
)

STAR_SCHEMA = {
    "competitions": COMPETITIONS,
    "teams": TEAMS,
    "places": PLACES,
    "stages": STAGES,
    "match_status": MATCH_STATUS,
    "players": PLAYERS,
    "goals": GOALS,
    "matches": MATCHES,
}

# Columns declared NOT NULL.
REQUIRED_COLUMNS = {
    "competitions": (
        "number_of_games", "number_of_match_days", "number_of_teams", "last_updated", "caption", "year", "league",
    ),
    "places": ("id",),
    "match_status": ("id",),
    "players": ("id",),
    "goals": ("id", "match_id", "player_id", "team_id"),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("matches", "competition_id", "competitions", "id"),
    ("matches", "place_id", "places", "id"),
    ("matches", "away_team_id", "teams", "id"),
    ("matches", "home_team_id", "teams", "id"),
    ("matches", "stage_id", "stages", "id"),
    ("matches", "status_id", "match_status", "id"),
    ("players", "team_id", "teams", "id"),
    ("goals", "match_id", "matches", "id"),
    ("goals", "player_id", "players", "id"),
    ("goals", "team_id", "teams", "id"),
)

LINK_MATCH_TO_FIFA = "match_id BIGINT, match_id_fifa BIGINT"
LINK_MATCH_TO_UEFA = "match_id BIGINT, match_id_uefa BIGINT"
LINK_MATCH_TO_SPORTS_RU = "match_id BIGINT, match_id_sports_ru BIGINT"
LINK_STADIUM_TO_UEFA = "place_id BIGINT, stadium_id_uefa BIGINT"

# ---------------------------------------------------------------- staging

TOURNAMENT_CALENDAR = (
    "id INT, attendance INT, time INT, year INT, date DATE, tournament_name STRING, tournament_id INT, "
    "stage_name STRING, only_date BOOLEAN, state_id INT, state STRING, status_id INT, status_name STRING, "
    "command1 STRING, command2 STRING, playoff_position INT, final_type INT, other_matches STRING, "
    "dt_updated TIMESTAMP"
)
TOURNAMENT_SEASONS = "id INT, tournament_id INT, name STRING, dt_updated TIMESTAMP"
TOURNAMENTS = (
    "id BIGINT, name STRING, tag_id BIGINT, type STRING, countries STRING, priority STRING, flag STRING, "
    "big_logo STRING, dt_updated TIMESTAMP"
)
GOALS_INFO = (
    "id INT, player STRING, countryCode STRING, minute INT, second INT, text STRING"
)

# ---------------------------------------------------------------- landed feeds

LANDED_MATCH = (
    "id BIGINT, `group` STRUCT<metaData: STRUCT<groupName: STRING>>, "
    "round STRUCT<metaData: STRUCT<name: STRING>>, kickOffTime STRUCT<date: STRING>"
)
CALENDAR_MATCH = "id BIGINT, time BIGINT"
PLAYER_EVENTS = (
    "scorers ARRAY<STRUCT<player: STRUCT<translations: STRUCT<name: STRUCT<EN: STRING>>, countryCode: STRING>, "
    "time: STRUCT<minute: INT, second: INT>>>"
)
STADIUM_DOCUMENT = (
    "id STRING, city STRUCT<id: STRING, translations: STRUCT<name: STRUCT<EN: STRING>>>, "
    "translations STRUCT<name: STRUCT<EN: STRING>>, geolocation STRUCT<latitude: DOUBLE, longitude: DOUBLE>"
)
GAME_MESSAGE = "id BIGINT, team1 STRING, team2 STRING, score STRING"

# ---------------------------------------------------------------- seeds (fixed values)

MATCH_STATUS_ROWS = (
    (1, "upcoming"),
    (2, "finished"),
    (3, "canceled"),
)
FINISHED = 2

STAGE_ROWS = (
    (1, "Preliminary round"),
    (2, "First round"),
    (3, "Group A"),
    (4, "Group 1"),
    (5, "Group B"),
    (6, "Group 2"),
    (7, "Group C"),
    (8, "Group 3"),
    (9, "Group D"),
    (10, "Group 4"),
    (11, "Group E"),
    (12, "Group 5"),
    (13, "Group F"),
    (14, "Group 6"),
    (15, "Group G"),
    (16, "Group H"),
    (17, "Round of 16"),
    (18, "Quarter-finals"),
    (19, "Semi-finals"),
    (20, "3 AND 4 place"),
    (21, "Final"),
)


def _seed(spark: SparkSession, rows: tuple, schema: str) -> DataFrame:
    # VALUES gives a local relation of known size, so Catalyst broadcasts it on its own.
    values = ", ".join(f"({key}, '{text}')" for key, text in rows)
    return spark.sql(f"VALUES {values}").toDF(*as_struct(schema).names)


def match_status_seed(spark: SparkSession) -> DataFrame:
    return _seed(spark, MATCH_STATUS_ROWS, MATCH_STATUS)


def stage_seed(spark: SparkSession) -> DataFrame:
    return _seed(spark, STAGE_ROWS, STAGES)
