from datetime import date

import pytest
from pyspark.sql import functions as F

from touchline.functions import cleaning, dates, text


@pytest.mark.parametrize(
    "values, expected, strict",
    [
        ((2, 1, None, None), "2:1", "2:1"),
        ((2, 2, 4, 3), "2(4):2(3)", "2(4):2(3)"),
        ((1, 1, 0, 3), "1:1", "1(0):1(3)"),
    ],
)
def test_score_text(spark, values, expected, strict):
    df = spark.createDataFrame([values], "h int, a int, ph int, pa int")
    columns = [F.col(c) for c in df.columns]
    row = df.select(text.score_text(*columns), text.score_text(*columns, strict=True)).first()
    assert tuple(row) == (expected, strict)


def test_goal_line(spark):
    df = spark.createDataFrame(
        [
            ("23'", '[{"Description":"Leo Test (Alpha) scores!!"}]'),
            ("90'+2'", '[{"Description":"Ann O\'Neil (Beta) successfully converts the penalty!"}]'),
            (None, '[{"Description":"y scores!!"}]'),
        ],
        "minute string, description string",
    )
    lines = [r[0] for r in df.select(text.goal_line(F.col("minute"), F.col("description"))).collect()]
    assert lines == ["23` Leo Test (Alpha) ", "90` +2` Ann O` Neil (Beta) pen", None]


def test_goal_types(spark):
    kinds = ["Goal!", "Penalty Goal", "OWN GOAL", "Attempt at Goal", "Foul", None]
    df = spark.createDataFrame([(k,) for k in kinds], "k string").where(text.is_goal_type(F.col("k")))
    assert [r.k for r in df.collect()] == ["Goal!", "Penalty Goal", "OWN GOAL"]


def test_names_and_images(spark):
    row = spark.range(1).select(
        text.short_name(F.lit("Allianz Arena X")), text.flag_image(F.lit("DE")), text.team_image(F.lit("Italy")),
        text.flag_image(F.lit(None).cast("string")), text.named_stage(F.lit("")),
        text.stage_name(F.lit(None).cast("string"), F.lit("Final")),
    ).first()
    assert tuple(row) == ("allianzarenax", "de.svg", "assets/images/Italy.png", None, "no_stage_name", "Final")


@pytest.mark.parametrize(
    "kickoff, hours, expected",
    [
        ("2020-06-12T19:00:00Z", 2, "2020-06-12T21:00:00Z"),
        ("2020-06-12T19:00:00Z", -3, "2020-06-12T16:00:00Z"),
        ("2020-06-12T23:30:00Z", 1, "2020-06-13T00:30:00Z"),
        ("2020-06-12T19:00:00Z", None, None),
        ("12.06.2020 19:00", 2, None),
        ("2020-02-30T19:00:00Z", 2, None),
    ],
)
def test_local_kickoff(spark, kickoff, hours, expected):
    df = spark.createDataFrame([(kickoff, hours)], "k string, h int")
    assert df.select(dates.local_kickoff(F.col("k"), F.col("h"))).first()[0] == expected


def test_kickoff_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2020-03-08T02:30:00Z", 86399)], "k string, s long")
        row = df.select(dates.local_kickoff(F.col("k"), 0), dates.unix_day(F.col("s"))).first()
        assert tuple(row) == ("2020-03-08T02:30:00Z", "1970-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_days(spark):
    row = spark.range(1).select(
        dates.compact_day(F.lit("2020-06-12")), dates.compact_day(F.lit("20200612")),
        dates.unix_day(F.lit(86400)), dates.unix_year(F.lit(1577836799)),
        dates.kickoff_day(F.lit("2020-06-12T19:05:00Z")), dates.kickoff_clock(F.lit("2020-06-12T19:05:00Z")),
    ).first()
    assert tuple(row) == ("20200612", None, "1970-01-02", 2019, "2020-06-12", "19:05:00")


CASES = [
    ("int", None, 0, False), ("int", "", 0, False), ("int", "12", 12, False), ("int", "12.5", 0, True),
    ("int", "-7", -7, False), ("float", None, 0.0, False), ("float", "", 0.0, False),
    ("float", "1\u00a0234,5", 1234.5, False), ("float", "x", 0.0, True), ("float", "1d", 0.0, True),
    ("float", "1e3", 1000.0, False), ("date", "2020-06-12", date(2020, 6, 12), False),
    ("date", "20200612", None, True), ("date", None, None, False), ("date", "2020-13-01", None, True),
    ("bool", "", False, False), ("bool", "x", True, False), ("bool", None, None, False),
    ("string", "a", "a", False), ("string", None, None, False),
    ("json", None, '""', False), ("json", "abc", '"abc"', False), ("json", 'a"b', '"a\\"b"', False),
    ("unknown", "abc", '"abc"', False),
]


@pytest.mark.parametrize("kind, raw, expected, rejected", CASES)
def test_cleaner_rules(spark, kind, raw, expected, rejected):
    df = spark.createDataFrame([(raw,)], "c string")
    assert cleaning.clean(df, {"c": kind}).first()[0] == expected
    assert cleaning.mark_rejects(df, {"c": kind}).first()["rejected"] == (["c"] if rejected else [])


def test_cleaner_on_typed_columns(spark):
    df = spark.sql(
        "SELECT 12.7D AS i, CAST('NaN' AS DOUBLE) AS f, 0 AS b0, 3 AS b1, named_struct('id', 1) AS s, "
        "array(1, 2) AS a, 5 AS n, CAST('NaN' AS DOUBLE) AS j"
    )
    config = {"i": "int", "f": "float", "b0": "bool", "b1": "bool"}
    row = cleaning.clean(df, config).first()
    assert (row.i, row.f, row.b0, row.b1, row.s, row.a, row.n) == (12, 0.0, False, True, '{"id":1}', "[1,2]", "5")
    assert row.j == '""'


def test_split_rejects(spark, rows):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y"), ("", "z")], "a string, b string")
    good, bad = cleaning.split_rejects(df, {"a": "int", "b": "float"})
    assert rows(good) == [(1, 2.5)]
    assert rows(bad) == [("", "z", ["b"]), ("x", "y", ["a", "b"])]
    assert rows(cleaning.reject_counts(df, {"a": "int", "b": "float"})) == [("a", 1), ("b", 2)]


def test_config_file(tmp_path):
    path = tmp_path / "types.json"
    path.write_text('{"id": "int"}')
    assert cleaning.load_config(str(path)) == {"id": "int"}
