import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from pyspark.sql import functions as F  # noqa: E402

from touchline.operators import star  # noqa: E402
from touchline.schemas import match_status_seed, stage_seed  # noqa: E402
from touchline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def tables(spark):
    """A small warehouse: four matches of 2022, one of 2018; match 3 has no goals, match 4 is not played."""
    make = spark.createDataFrame
    matches = make(
        [
            (1, 100, 1, 3, 2, "2022-11-20T16:00:00Z", 10, 11, 2, 2, 4, 3),
            (2, 100, 1, 3, 2, "2022-11-21T13:00:00Z", 12, 10, 1, 0, None, None),
            (3, 100, 1, 3, 2, "2022-11-22T13:00:00Z", 11, 12, 0, 0, None, None),
            (4, 100, 1, 3, 1, "2022-11-23T13:00:00Z", 11, 10, None, None, None, None),
            (5, 101, 1, 3, 2, "2018-11-23T13:00:00Z", 11, 10, 1, 0, None, None),
        ],
        "id INT, competition_id BIGINT, place_id BIGINT, stage_id INT, status_id INT, date STRING, "
        "home_team_id BIGINT, away_team_id BIGINT, total_home_goals INT, total_away_goals INT, "
        "penalty_shootout_home_goals INT, penalty_shootout_away_goals INT",
    ).withColumn("local_date", F.col("date"))
    return star.Star(
        matches=matches,
        competitions=make(
            [(100, "Cup 2022", 2022, "A"), (101, "Cup 2018", 2018, "A")],
            "id BIGINT, caption STRING, year INT, league STRING",
        ),
        stages=stage_seed(spark),
        teams=make(
            [(10, "AAA", "AA", "A"), (11, "BBB", "BB", "B"), (12, "CCC", "CC", "C")],
            "id BIGINT, short_name STRING, short_name2 STRING, name STRING",
        ),
        places=make(
            [(1, "S1", "Town", 1.0, 2.0)], "id BIGINT, stadium STRING, city STRING, lat DOUBLE, lng DOUBLE"
        ),
        match_status=match_status_seed(spark),
        goals=make(
            [(7, 1, "23` X"), (5, 1, "10` Y"), (9, 2, "5` Z"), (8, 5, "1` W"), (6, 1, None)],
            "id BIGINT, match_id BIGINT, text STRING",
        ),
    )
