import pytest
from pyspark.sql import functions as F

from touchline.operators import quality, shaping, star
from touchline.plans import flows, models
from touchline.schemas import FOREIGN_KEYS, MATCHES, as_struct, match_status_seed, stage_seed


def test_seeds(spark, rows):
    assert rows(match_status_seed(spark)) == [(1, "upcoming"), (2, "finished"), (3, "canceled")]
    stages = rows(stage_seed(spark))
    assert len(stages) == 21 and (3, "Group A") in stages and (21, "Final") in stages


def test_schedule(tables, rows):
    assert rows(star.schedule(tables, 2022), "match_id", "competition", "home_team", "away_team", "stage") == [
        (1, "Cup 2022", "A", "B", "Group A"), (2, "Cup 2022", "C", "A", "Group A"), (3, "Cup 2022", "B", "C", "Group A"),
    ]
    assert star.schedule(tables, status_id=None).count() == 5


def test_results(tables, rows):
    assert rows(star.results(tables, 2022), "match_id", "date", "time", "text", "result", "image_path_home", "status") == [
        (1, "2022-11-20", "16:00:00", "10` Y,23` X", "2(4):2(3)", "aa.svg", "finished"),
        (2, "2022-11-21", "13:00:00", "5` Z", "1:0", "cc.svg", "finished"),
    ]
    kept = rows(star.results(tables, 2022, how="left"), "match_id", "text_part", "text", "result")
    assert (3, 0, None, "0:0") in kept and len(kept) == 3


def test_results_in_parts(tables, rows):
    assert rows(star.results(tables, 2022, page=2), "match_id", "text_part", "text") == [
        (1, 0, "10` Y"), (1, 1, "23` X"), (2, 0, "5` Z"),
    ]


def test_goals_by_season(tables, rows):
    per_match = tables.goals.groupBy("match_id").agg(F.count("*").alias("n_goals"))
    assert rows(star.goals_by_season(tables.matches, tables.competitions, per_match)) == [("Cup 2018", 2018, 1, 1, 1.0), ("Cup 2022", 2022, 4, 2, 2.0)]


def test_goal_rows(spark, rows):
    timeline = spark.createDataFrame(
        [
            (11, 100, 1, "23'", '[{"Description":"Leo Test (Alpha) scores!!"}]', "Goal!"),
            (12, 100, 2, "90'+2'", '[{"Description":"Ann O\'Neil (Beta) successfully converts the penalty!"}]', "Penalty Goal"),
            (13, 100, 3, "5'", '[{"Description":"x"}]', "Attempt at Goal"),
            (14, 100, 4, None, '[{"Description":"y scores!!"}]', "Own goal"),
            (15, 999, 5, "1'", '[{"Description":"z scores!!"}]', "Goal!"),
            (16, 100, 6, "2'", '[{"Description":"z scores!!"}]', None),
        ],
        "EventId BIGINT, IdMatch BIGINT, IdPlayer BIGINT, MatchMinute STRING, EventDescription STRING, TypeLocalized STRING",
    )
    link = spark.createDataFrame([(1, 100)], "match_id BIGINT, match_id_fifa BIGINT")
    assert rows(star.goal_rows(timeline, link)) == [
        (11, 1, 1, "23` Leo Test (Alpha) "), (12, 1, 2, "90` +2` Ann O` Neil (Beta) pen"), (14, 1, 4, None),
    ]


def test_corrected_local_dates(spark, rows):
    matches = spark.createDataFrame(
        [(1, "2020-06-12T19:00:00+02:00"), (2, "2020-06-12T19:00:00Z"), (3, "a+b"), (4, "+")], "id INT, date STRING"
    )
    link = spark.createDataFrame([(1, 70), (2, 70), (3, 71)], "match_id BIGINT, match_id_uefa BIGINT")
    source = spark.createDataFrame(
        [(70, "2020-06-12T19:00:00Z", 3), (71, None, 1)], "id BIGINT, dateTime STRING, utcOffsetInHours INT"
    )
    found = star.corrected_local_dates(matches, link, source)
    assert rows(found) == [(1, "2020-06-12T19:00:00Z", 3, "2020-06-12T21:00:00Z")]
    own = star.corrected_local_dates(matches, link, source, F.col("u.utcOffsetInHours"))
    assert rows(own, "date_local") == [("2020-06-12T22:00:00Z",)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan  # the far-side test turns the outer joins into inner ones


def test_places(spark, rows):
    places = spark.createDataFrame(
        [(5, "B", 1.0, 2.0), (3, "A", 1.0, 2.0), (4, "C", 0.0, 1.0), (6, "D", None, None), (7, "E", None, None)],
        "id BIGINT, stadium STRING, lat DOUBLE, lng DOUBLE",
    )
    stadiums = spark.createDataFrame(
        [(50, 1.0, 2.0), (51, -0.0, 1.0), (52, None, None), (53, 9.0, 9.0)], "id BIGINT, latitude DOUBLE, longitude DOUBLE"
    )
    assert rows(star.link_stadiums(stadiums, places)) == [(3, 50), (4, 51)]
    assert [(r.id, r.n_places) for r in star.duplicate_places(places).collect()] == [(3, 2), (5, 2)]


def test_place_rows(spark):
    stadium = spark.createDataFrame(
        [("Puskas Arena", "Budapest", 67000, 47.5, 19.1)],
        "name STRING, cityName STRING, capacity INT, latitude DOUBLE, longitude DOUBLE",
    )
    row = star.place_rows(stadium, F.lit(364), F.lit(1476)).first()
    assert tuple(row) == (364, "Puskas Arena", "Budapest", "puskasarena", 67000, 1476, 47.5, 19.1)


SOURCE = (
    "id INT, dateTime STRING, utcOffsetInHours INT, groupName STRING, roundName STRING, seasonYear INT, "
    "homeTeamcountryCode STRING, awayTeamcountryCode STRING, stadiumId BIGINT, status STRING, scoreRegularHome INT, "
    "scoreRegularAway INT, scoreTotalHome INT, scoreTotalAway INT, scorePenaltyHome INT, scorePenaltyAway INT, matchNumber INT"
)


def source_row(key, group="Group A", round_="Final", year=2022, home="AAA", stadium=50, status="FINISHED"):
    return (key, "2020-06-12T19:00:00Z", 2, group, round_, year, home, "BBB", stadium, status, 1, 0, 1, 0, None, None, key)


@pytest.fixture(scope="module")
def loaded(spark, tables):
    source = spark.createDataFrame(
        [
            source_row(1), source_row(2, group=None), source_row(3, stadium=99), source_row(4, home="XXX"),
            source_row(5, status="unknown"), source_row(6, year=2018), source_row(7, group="group a"),
        ],
        SOURCE,
    )
    links = spark.createDataFrame([(1, 50)], "place_id BIGINT, stadium_id_uefa BIGINT")
    return source, links


def test_fact_rows(tables, loaded, rows):
    source, links = loaded
    found = star.fact_rows(source, tables, links, season=2022, ordered=True)
    assert [tuple(r) for r in found.select("id", "place_id", "stage_id", "status_id", "competition_id").collect()] == [
        (1, 1, 3, 2, 100), (2, 1, 21, 2, 100), (3, None, 3, 2, 100), (5, 1, 3, None, 100),
    ]
    first = found.first()
    assert (first.date, first.local_date) == ("2020-06-12T19:00:00Z", "2020-06-12T21:00:00Z")
    assert (first.home_team_id, first.away_team_id, first.game_order) == (10, 11, 1)


def test_fact_rows_options(spark, tables, loaded, rows):
    source, links = loaded
    folded = star.fact_rows(source, tables, links, collation="UTF8_LCASE")
    assert (7,) in rows(folded, "id") and (6,) in rows(folded, "id")
    twice = tables.competitions.union(
        spark.createDataFrame([(102, "League", 2022, "B")], tables.competitions.schema)
    )
    doubled = star.Star(**{**tables.__dict__, "competitions": twice})
    assert star.fact_rows(source, doubled, links, season=2022).count() == 8
    assert star.fact_rows(source, doubled, links, season=2022, league="B").count() == 4
    assert rows(star.crowded_seasons(twice)) == [(2022, 2)]


def test_fact_load_has_the_target_columns(spark, tables, loaded):
    source, links = loaded
    assert flows.fact_load(source, tables, links).schema.simpleString() == as_struct(MATCHES).simpleString()


def test_scorers(spark, rows):
    timeline = spark.createDataFrame(
        [
            (1, '{"scorers":[{"player":{"translations":{"name":{"EN":"Leo"}},"countryCode":"ARG"},"time":{"minute":23,"second":5}},'
                '{"player":{"countryCode":"FRA"}}]}'),
            (2, None), (3, "{}"), (4, '{"scorers":[]}'),
        ],
        "id INT, playerEvents STRING",
    )
    assert rows(shaping.scorers(timeline)) == [
        (1, "Leo", "ARG", 23, 5, "23` Leo(ARG)"), (1, None, "FRA", None, None, None),
    ]


def test_stadium_dimension(spark, rows):
    document = (
        '{"id":"1","city":{"id":"2","translations":{"name":{"EN":"Rome"}}},'
        '"translations":{"name":{"EN":"The \\"Big\\" One"}},"geolocation":{"latitude":41.5,"longitude":12}}'
    )
    timeline = spark.createDataFrame([(document, 2020), (document, 2020), (document, 2021)], "stadium STRING, seasonYear INT")
    found = rows(shaping.stadium_dimension(timeline).drop("stadium"))
    assert found == [("1", "2", "Rome", "The Big One", 41.5, 12.0, y) for y in (2020, 2021)]


def test_quality(spark, tables, rows):
    make = spark.createDataFrame
    frames = {
        "matches": make([(1, 100, None), (2, 999, 1), (3, 999, 1)], "id INT, competition_id BIGINT, place_id BIGINT"),
        "competitions": make([(100, None), (100, "x"), (None, "y"), (None, "z")], "id BIGINT, caption STRING"),
        "places": make([(1,), (None,)], "id BIGINT"),
    }
    keys = [k for k in FOREIGN_KEYS if k[2] in ("competitions", "places")]
    assert rows(quality.foreign_key_violations(frames, keys)) == [("matches", "competition_id", "competitions", 999, 2)]
    assert rows(quality.unique_report(frames)) == [("competitions", 100, 2)]
    required = {"competitions": ("caption",), "places": ("id",), "matches": ("id",)}
    assert rows(quality.null_violations(frames, required)) == [("competitions", "caption", 1), ("places", "id", 1)]


def test_models(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id INT, t STRING")
    assert rows(models.materialize(spark, "match_results", {"game_results": df})) == [(1, "a"), (2, "b")]
    assert rows(spark.sql("SELECT * FROM match_results WHERE id = 2")) == [(2, "b")]
    with pytest.raises(ValueError):
        models.materialize(spark, "match_results", {"game_results": df}, as_="paper")


def test_model_as_table(spark, rows):
    places = spark.createDataFrame([(3, 1.0, 2.0)], "id BIGINT, lat DOUBLE, lng DOUBLE")
    stadiums = spark.createDataFrame([(50, 1.0, 2.0)], "id BIGINT, latitude DOUBLE, longitude DOUBLE")
    found = models.materialize(spark, "link_stadium_to_uefa", {"places": places, "uefa_stadiums": stadiums})
    assert rows(found) == [(3, 50)]
    again = stadiums.withColumn("id", F.lit(51).cast("bigint"))
    found = models.materialize(spark, "link_stadium_to_uefa", {"places": places, "uefa_stadiums": again})
    assert rows(found) == [(3, 51)]
    spark.sql("DROP TABLE link_stadium_to_uefa")


def test_incremental_model_replaces_the_days_it_has(spark, rows):
    kept = {"kept_results": models.Model(lambda t: t["rows"], "incremental", "game_date")}
    frame = lambda *pairs: spark.createDataFrame(pairs, "game_date STRING, id INT")
    models.materialize(spark, "kept_results", {"rows": frame(("d1", 1), ("d2", 2))}, models=kept)
    found = models.materialize(spark, "kept_results", {"rows": frame(("d2", 3), ("d3", 4))}, models=kept)
    assert rows(found, "game_date", "id") == [("d1", 1), ("d2", 3), ("d3", 4)]
    spark.sql("DROP TABLE kept_results")
