import json

import pytest
from pyspark.sql import functions as F

from touchline.operators import shaping, staging
from touchline.plans import flows
from touchline.schemas import CALENDAR_MATCH, LANDED_MATCH
from touchline.sources import lake, landed

MATCHES = [
    {"id": 1, "group": {"metaData": {"groupName": "Group A"}}, "round": {"metaData": {"name": "R"}},
     "kickOffTime": {"date": "2020-06-12"}},
    {"id": 2, "round": {"metaData": {"name": "Final"}}, "kickOffTime": {"date": "2020-07-12"}},
    {"id": 3, "group": {"metaData": {"groupName": "Group A"}}, "round": {"metaData": {"name": "R"}},
     "kickOffTime": {"date": "2020-06-12"}},
    {"id": 4, "round": {"metaData": {"name": ""}}, "kickOffTime": {"date": "2020-06-13"}},
]


def write(path, value):
    path.write_text(json.dumps(value))
    return str(path)


def test_array_records(spark, tmp_path, rows):
    feed = write(tmp_path / "m.json", MATCHES)
    staged = shaping.stage_and_day(landed.read_records(spark, feed, LANDED_MATCH))
    assert rows(staged, "id", "stage_name", "date") == [
        (1, "Group A", "20200612"), (2, "Final", "20200712"), (3, "Group A", "20200612"),
        (4, "no_stage_name", "20200613"),
    ]
    buckets = [tuple(r) for r in shaping.stage_day_buckets(staged).collect()]
    assert buckets == [
        ("Final", "20200712", 0, 1, [2]), ("Group A", "20200612", 0, 2, [1, 3]),
        ("no_stage_name", "20200613", 0, 1, [4]),
    ]
    assert [r.date for r in shaping.match_days(staged).collect()] == ["20200712", "20200613", "20200612"]
    assert len(shaping.stage_names(staged).collect()) == 3


def test_buckets_in_parts(spark, rows):
    staged = spark.range(25).select("id", F.lit("Group A").alias("stage_name"), F.lit("20200612").alias("date"))
    found = shaping.stage_day_buckets(staged, page=10).collect()
    assert [(r.part, r.n_rows) for r in found] == [(0, 10), (1, 10), (2, 5)]
    assert [i for r in found for i in r.match_ids] == list(range(25))


def test_envelopes(spark, tmp_path, rows):
    write(tmp_path / "a.json", {"Results": [{"id": 1, "name": "x"}, {"id": 2, "name": "y"}]})
    write(tmp_path / "b.json", {"Results": []})
    write(tmp_path / "c.json", {"Error": "none"})
    found = landed.read_envelopes(spark, str(tmp_path), "id BIGINT, name STRING")
    assert rows(found) == [(1, "x"), (2, "y")]


def test_keyed_responses(spark, tmp_path, rows):
    for match_id in (7, 8):
        folder = tmp_path / f"match_id={match_id}"
        folder.mkdir()
        write(folder / "r.json", [{"attendance": match_id * 10}])
    found = landed.read_keyed(spark, str(tmp_path), "attendance INT", "match_id BIGINT")
    assert rows(found) == [(70, 7), (80, 8)]
    assert rows(found.where("match_id = 8")) == [(80, 8)]


def test_tournaments_by_name(spark, tmp_path, rows):
    feed = write(tmp_path / "t.json", [{"id": 1, "name": "World Cup"}, {"id": 2, "name": "League"}, {"id": 3}])
    schema = "id BIGINT, name STRING"
    assert rows(landed.read_tournaments(spark, feed, schema, "Cup|Euro")) == [(1, "World Cup")]
    assert len(landed.read_tournaments(spark, feed, schema).collect()) == 3


CALENDAR = [
    {"stage_name": "Group A", "matches": [{"id": 1, "time": 1592006399}, {"id": 2, "time": 1592006400}]},
    {"stage_name": "", "matches": [{"id": 3, "time": 1577836800}]},
    {"stage_name": "Empty", "matches": []},
]


def test_calendar(spark, tmp_path, rows):
    calendar = landed.read_calendar(spark, write(tmp_path / "c.json", CALENDAR), CALENDAR_MATCH)
    assert rows(shaping.explode_calendar(calendar), "id", "stage_name", "date", "year") == [
        (1, "Group A", "2020-06-12", 2020), (2, "Group A", "2020-06-13", 2020), (3, "no_stage_name", "2020-01-01", 2020),
    ]
    assert rows(shaping.explode_calendar(calendar, "2020-06-12"), "id") == [(1,)]


def test_calendar_around_midnight(spark, rows):
    midnight = 1592006400  # 2020-06-13T00:00:00Z
    calendar = spark.createDataFrame(
        [("Final", [(1, midnight - 1), (2, midnight)])], f"stage_name STRING, matches ARRAY<STRUCT<{CALENDAR_MATCH}>>"
    )
    assert rows(shaping.explode_calendar(calendar), "id", "date") == [(1, "2020-06-12"), (2, "2020-06-13")]
    assert rows(shaping.explode_calendar(calendar, "2020-06-13"), "id") == [(2,)]


def test_ratings_of_two_days(spark, tmp_path, rows):
    feed = tmp_path / "r.csv"
    feed.write_text("Country,Club,Elo\nGER,Bayern,2000.5\nESP,Real Madrid,1990\n")
    target, schema = str(tmp_path / "lake"), "Country STRING, Club STRING, Elo DOUBLE"
    flows.land_ratings(spark, str(feed), schema, target, "2023-01-01")
    flows.land_ratings(spark, str(feed), schema, target, "2023-01-02")
    found = spark.read.parquet(target)
    assert rows(found, "country", "club", "Elo", "date", "entity") == sorted(
        (c, n, e, d, "rating")
        for c, n, e in (("GER", "Bayern", 2000.5), ("ESP", "Real Madrid", 1990.0))
        for d in ("20230101", "20230102")
    )


def test_feed_to_staging(spark, tmp_path, rows):
    """Feed → lake → selected partitions → typed staging rows."""
    target = str(tmp_path / "lake")
    flows.land_matches(spark, write(tmp_path / "m.json", MATCHES), LANDED_MATCH, target, 3, 2020, json_lines=False)
    flows.land_matches(spark, write(tmp_path / "n.json", MATCHES[:1]), LANDED_MATCH, target, 4, 2021, json_lines=False)
    scanned = lake.scan_glob(spark, target, schema=lake.lake_schema(LANDED_MATCH))
    config = {"id": "int", "tournament_id": "int", "year": "int", "stage_name": "string", "date": "string"}
    option = lake.SearchOption.TOURNAMENT_YEAR
    staged, none = flows.staging_rows(scanned, config, tournament_id=3, year=2020, option=option)
    assert none.count() == 0
    assert rows(staged, "id", "stage_name", "year") == [
        (1, "Group A", 2020), (2, "Final", 2020), (3, "Group A", 2020), (4, "no_stage_name", 2020),
    ]
    by_id = {r.id: r for r in staged.collect()}
    assert json.loads(by_id[1].group) == {"metaData": {"groupName": "Group A"}}
    assert by_id[2].group == '""' and by_id[2].dt_updated is not None
    good, bad = flows.staging_rows(scanned, {**config, "stage_name": "int"})
    assert good.count() == 0 and bad.count() == 5


def test_line_files_keep_all_their_records(spark, tmp_path, rows):
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(match) for match in MATCHES))
    target = str(tmp_path / "lake")
    flows.land_matches(spark, str(lines), LANDED_MATCH, target, 3, 2020, json_lines=True)
    assert rows(lake.scan_lake(spark, target, lake.lake_schema("id BIGINT")), "id") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError, match="one document per line"):
        flows.land_matches(spark, str(lines), LANDED_MATCH, target, 3, 2020, json_lines=False)
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps(MATCHES, indent=1))
    assert landed.read_records(spark, str(pretty), LANDED_MATCH).count() == 4


def test_clearing_touches_expired_days_only(spark, tmp_path, rows):
    path = str(tmp_path / "staging")
    frame = spark.sql(
        "SELECT * FROM VALUES (1, 'a', DATE'2024-01-01'), (2, 'a', DATE'2024-01-25'), (3, 'b', DATE'2024-01-01'), "
        "(4, 'b', NULL) t(id, p, dt_updated)"
    )
    flows.append_staging(frame, path, partition_by=["p"])
    before = {f for f in spark.read.parquet(path).inputFiles()}
    assert flows.clear_staging(spark, path, 10, "2024-01-31") == 2
    assert rows(spark.read.parquet(path), "id", "p") == [(2, "a"), (4, "b")]
    assert set(spark.read.parquet(path).inputFiles()) < before
    assert flows.clear_staging(spark, path, 10, "2024-01-31") == 0
    with pytest.raises(ValueError):
        frame.write.parquet(str(tmp_path / "flat"))
        flows.clear_staging(spark, str(tmp_path / "flat"), 10)


def test_production_runs_may_overlap(spark, tmp_path, rows):
    path = str(tmp_path / "results")
    frame = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-11'), (2, DATE'2024-01-12'), (3, DATE'2024-02-09') t(id, game_date)")
    for day in ("2024-02-10", "2024-02-10", "2024-02-11"):
        flows.update_game_results(frame.union(frame), path, as_of=day)
    assert rows(spark.read.parquet(path), "id") == [(2,), (3,)]


def test_calendar_to_lake(spark, tmp_path, rows):
    target = str(tmp_path / "lake")
    feed = write(tmp_path / "c.json", CALENDAR)
    flows.land_calendar(spark, feed, CALENDAR_MATCH, target, 52, json_lines=False)
    found = lake.scan_lake(spark, target, lake.lake_schema("id BIGINT, time BIGINT, match_id BIGINT"))
    assert rows(found, "id", "match_id", "tournament_id", "stage_name") == [
        (1, 1, 52, "Group A"), (2, 2, 52, "Group A"), (3, 3, 52, "no_stage_name"),
    ]


def test_many_tournaments_in_one_job(spark, tmp_path, rows):
    for tournament in (52, 53):
        folder = tmp_path / "calendars" / f"tournament_id={tournament}"
        folder.mkdir(parents=True)
        write(folder / "c.json", CALENDAR)
        folder = tmp_path / "matches" / f"tournament_id={tournament}" / "year=2020"
        folder.mkdir(parents=True)
        write(folder / "m.json", MATCHES)
    flows.land_calendar(spark, str(tmp_path / "calendars"), CALENDAR_MATCH, str(tmp_path / "a"), json_lines=False)
    found = lake.scan_lake(spark, str(tmp_path / "a"), lake.lake_schema("id BIGINT, match_id BIGINT"))
    assert rows(found, "tournament_id", "match_id") == [(t, m) for t in (52, 53) for m in (1, 2, 3)]
    flows.land_matches(spark, str(tmp_path / "matches"), LANDED_MATCH, str(tmp_path / "b"), json_lines=False)
    found = lake.scan_lake(spark, str(tmp_path / "b"), lake.lake_schema(LANDED_MATCH))
    assert rows(found, "tournament_id", "year", "id") == [(t, 2020, m) for t in (52, 53) for m in (1, 2, 3, 4)]


def test_seasons(spark, rows):
    seasons = spark.createDataFrame(
        [(1, 10, "2019/2020"), (2, 10, "2020/2021"), (3, 10, "2018/2019"), (4, 20, "2020"), (5, 20, None)],
        "id INT, tournament_id INT, name STRING",
    )
    assert [r.id for r in staging.order_seasons(seasons, 2020).collect()] == [2, 1, 4]
    ranked = {r.id: r.season_rank for r in staging.rank_seasons(seasons).collect()}
    assert ranked == {2: 1, 1: 2, 3: 3, 4: 1}
    assert rows(staging.latest_season(seasons.where("name IS NOT NULL")), "id") == [(2,), (4,)]


def test_pending(spark, rows):
    seasons = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (None, 0)], "id INT, is_on_s3 INT")
    done = spark.createDataFrame([(3,), (3,), (None,)], "id INT")
    assert rows(staging.pending(seasons), "id") == [(1,), (3,), (None,)]
    assert rows(staging.pending(seasons, done), "id") == [(1,)]


def test_windows_and_copies(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-11'), (2, DATE'2024-01-12'), (2, DATE'2024-01-12') t(id, d)")
    assert rows(staging.recent_rows(df, "d", 30, "2024-02-10"), "id") == [(2,), (2,)]
    assert rows(staging.retained_rows(df, 30, "d", "2024-02-10"), "id") == [(1,), (2,), (2,)]
    unknown = df.union(spark.sql("SELECT 9, CAST(NULL AS DATE)"))
    assert rows(staging.retained_rows(unknown, 29, "d", "2024-02-10"), "id") == [(2,), (2,), (9,)]
    once = staging.drop_copies(df)
    assert rows(once, "id") == [(1,), (2,)] and staging.drop_copies(once).count() == 2


def test_union_differing(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id INT, a STRING")
    b = spark.createDataFrame([("y", 2)], "b STRING, id INT")
    assert rows(staging.union_differing([a, b, a])) == [(1, "x", None), (1, "x", None), (2, None, "y")]
