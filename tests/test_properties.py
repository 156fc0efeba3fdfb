"""Column rules against plain Python on random input, one Spark job per batch of cells."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.functions import cleaning, dates, text
from touchline.operators import staging
from touchline.sources.lake import path_columns

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def cells(alphabet, size=12):
    return st.lists(st.one_of(st.none(), st.text(alphabet, max_size=size)), min_size=150, max_size=200)


def cleaned(spark, values, kind):
    df = spark.createDataFrame(list(enumerate(values)), "i INT, c STRING")
    marked = cleaning.mark_rejects(df, {"i": "int", "c": kind}).select("i", "rejected")
    found = cleaning.clean(df, {"i": "int", "c": kind}).join(marked, "i").collect()
    return {r.i: (r.c, bool(r.rejected)) for r in found}


def plain(convert, default, value):
    if value in (None, ""):
        return default, False
    try:
        return convert(value), False
    except ValueError:
        return default, True


@SLOW
@given(values=cells("0123456789+-. x"))
def test_whole_numbers(spark, values):
    found = cleaned(spark, values, "int")
    assert found == {i: plain(int, 0, v) for i, v in enumerate(values)}


@SLOW
@given(values=cells("0123456789.,-+edf \u00a0"))
def test_decimal_numbers(spark, values):
    def convert(value):
        return float(value.replace(",", ".").replace("\u00a0", ""))

    found = cleaned(spark, values, "float")
    assert found == {i: plain(convert, 0.0, v) for i, v in enumerate(values)}


@SLOW
@given(values=st.lists(st.text("ab'!\" scores", max_size=20), min_size=100, max_size=150))
def test_goal_lines(spark, values):
    import json

    rows = [(i, "7'", json.dumps([{"Description": v}])) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i INT, m STRING, d STRING")
    found = {r.i: r.line for r in df.select("i", text.goal_line(F.col("m"), F.col("d")).alias("line")).collect()}
    for i, value in enumerate(values):
        line = "7'" + value.replace('"', "").replace("scores!!", "")
        line = line.replace("'", "` ").replace("successfully converts the penalty", "pen").replace("!", "")
        assert found[i] == line


@SLOW
@given(seconds=st.lists(st.integers(0, 4_000_000_000), min_size=100, max_size=150))
def test_unix_days(spark, seconds):
    from datetime import datetime, timezone

    df = spark.createDataFrame([(s,) for s in seconds], "s BIGINT")
    found = df.select("s", dates.unix_day(F.col("s")).alias("d"), dates.unix_year(F.col("s")).alias("y")).collect()
    for row in found:
        moment = datetime.fromtimestamp(row.s, timezone.utc)
        assert (row.d, row.y) == (moment.strftime("%Y-%m-%d"), moment.year)


@SLOW
@given(values=st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), min_size=20, max_size=60))
def test_distinct_is_idempotent(spark, values):
    df = spark.createDataFrame(values, "i INT, t STRING")
    once = staging.drop_copies(df)
    assert Counter(map(tuple, once.collect())) == Counter(set(values))
    assert Counter(map(tuple, staging.drop_copies(once).collect())) == Counter(set(values))


@SLOW
@given(stages=st.lists(st.text("abZ019 +%:/-_äö", min_size=1, max_size=12), min_size=20, max_size=30, unique=True))
def test_stage_names_survive_folder_names(spark, tmp_path_factory, stages):
    """Any stage name comes back from the path it was written to."""
    path = str(tmp_path_factory.mktemp("stages"))
    df = spark.createDataFrame(list(enumerate(stages)), "id INT, stage_name STRING").withColumns(
        {"tournament_id": F.lit(1), "year": F.lit(2020), "date": F.lit("20200612")}
    )
    df.coalesce(1).write.mode("overwrite").partitionBy("tournament_id", "year", "stage_name", "date").parquet(path)
    files = spark.read.schema("id INT").option("recursiveFileLookup", "true").parquet(path)
    found = {r.id: r.stage_name for r in path_columns(files).collect()}
    assert found == dict(enumerate(stages))
