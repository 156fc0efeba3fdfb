from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from touchline.sinks import lake as lake_sink
from touchline.sources import lake
from touchline.sources.lake import SearchOption

DATA = "id BIGINT"


@pytest.fixture(scope="module")
def matches(spark):
    return spark.createDataFrame(
        [
            (1, 3, 2020, "Group A", "20200612"),
            (2, 3, 2020, "Q/F: +1", "20200701"),
            (3, 3, 2016, "Group A", "20160612"),
            (4, 5, 2020, None, "20200612"),
            (5, 5, 2021, "01", "20210612"),
        ],
        "id BIGINT, tournament_id BIGINT, year INT, stage_name STRING, date STRING",
    )


@pytest.fixture(scope="module")
def root(spark, matches, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "matches")
    lake_sink.write_partitioned(matches, path)
    return path


def scan(spark, root):
    return lake.scan_glob(spark, root, schema=lake.lake_schema(DATA))


def test_round_trip(spark, root, matches, rows):
    assert rows(scan(spark, root), *matches.columns) == rows(matches)
    assert rows(lake.scan_lake(spark, root, lake.lake_schema(DATA)), *matches.columns) == rows(matches)


def test_scan_without_schema_keeps_text_partitions(spark, root, matches, rows):
    assert rows(lake.scan_glob(spark, root), *matches.columns) == rows(matches)


def test_path_columns(spark, root, matches, rows):
    found = lake.path_columns(lake.scan_files(spark, [root], DATA))
    assert rows(found, *matches.columns) == rows(matches)


def test_bare_layout_and_foreign_paths(spark, tmp_path, rows):
    table = pa.table({"id": [7]})
    for place in ("52/2020/Final +1/2020-06-12", "other"):
        folder = tmp_path / "football" / place
        folder.mkdir(parents=True)
        pq.write_table(table, folder / "x.parquet")
    found = lake.path_columns(lake.scan_files(spark, [str(tmp_path / "football")], DATA))
    assert rows(found, "tournament_id", "year", "stage_name", "date") == [
        (52, 2020, "Final +1", "2020-06-12"), (None, None, None, None),
    ]


def test_entity_files(spark, tmp_path, rows):
    folder = Path(tmp_path / "tournament_id=3/year=2020/stage_name=Group A/date=20200612")
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"id": [1]}), folder / "matches.parquet")
    pq.write_table(pa.table({"id": [2]}), folder / "matches_stat.parquet")
    assert rows(lake.scan_entity(spark, str(tmp_path), "matches")) == [(1, 3, 2020, "Group A", "20200612")]


def test_files_with_differing_columns(spark, tmp_path, rows):
    pq.write_table(pa.table({"id": [1], "a": ["x"]}), tmp_path / "1.parquet")
    pq.write_table(pa.table({"id": [2], "b": ["y"]}), tmp_path / "2.parquet")
    both = lake.scan_files(spark, [str(tmp_path / "1.parquet"), str(tmp_path / "2.parquet")])
    assert rows(both, "id", "a", "b") == [(1, "x", None), (2, None, "y")]


@pytest.mark.parametrize(
    "option, criteria, expected",
    [
        (SearchOption.ALL, {}, [1, 2, 3, 4, 5]),
        (SearchOption.ALL, {"tournament_id": 3}, [1, 2, 3]),
        (SearchOption.ALL, {"tournament_id": 3, "year": 2021}, [1, 2, 3, 5]),
        (SearchOption.ALL, {"date": "20200612", "year": 2016}, [1, 3, 4]),
        (SearchOption.TOURNAMENT_YEAR, {"tournament_id": 3, "year": 2020}, [1, 2]),
        (SearchOption.TOURNAMENT_YEAR, {"tournament_id": 3, "year": 2020, "date": "20200701"}, [2]),
        (SearchOption.TOURNAMENT_YEAR, {"tournament_id": 3}, []),
        (SearchOption.TOURNAMENT_YEAR_DATE, {"tournament_id": 3, "year": 2020, "date": "20200612"}, [1]),
        (SearchOption.TOURNAMENT_YEAR_DATE, {"tournament_id": 3, "year": 2020}, []),
    ],
)
def test_selection(spark, root, option, criteria, expected):
    selected = lake.select_partitions(scan(spark, root), option, **criteria)
    assert sorted(r.id for r in selected.collect()) == expected


def test_all_is_the_union_of_single_criteria(spark, root):
    def ids(**criteria):
        return {r.id for r in lake.select_partitions(scan(spark, root), **criteria).collect()}

    combined = ids(tournament_id=5, year=2016, date="20200701")
    assert combined == ids(tournament_id=5) | ids(year=2016) | ids(date="20200701")


def test_selection_prunes_partitions(spark, root):
    selected = lake.select_partitions(scan(spark, root), SearchOption.TOURNAMENT_YEAR, 3, 2020)
    plan = selected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tournament_id" in plan and "(year" in plan
    assert len(selected.inputFiles()) >= 1


def test_narrowed_scan(spark, root, rows):
    schema = lake.lake_schema(DATA)
    assert rows(lake.scan_lake(spark, root, schema, 3, 2020), "id", "tournament_id", "year") == [(1, 3, 2020), (2, 3, 2020)]
    assert lake.scan_lake(spark, root, schema, 3, 1999).count() == 0
    assert lake.scan_lake(spark, root, schema, 99).count() == 0


def test_overwrite_keeps_other_partitions(spark, matches, tmp_path, rows):
    path = str(tmp_path / "lake")
    lake_sink.write_partitioned(matches, path)
    lake_sink.write_partitioned(matches.where("id = 1").withColumn("id", F.col("id") + 100), path)
    assert rows(scan(spark, path), "id") == [(101,), (2,), (3,), (4,), (5,)]


def test_hot_partition_is_split_when_written(spark, tmp_path):
    """A partition with nearly all rows is written by several tasks once it exceeds the advisory size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        wide = spark.range(40000).select(
            "id", F.lit(1).cast("bigint").alias("tournament_id"), F.lit(2020).alias("year"),
            F.lit("Final").alias("stage_name"), F.lit("20200612").alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
        ).repartition(8)
        path = tmp_path / "hot"
        lake_sink.write_partitioned(wide, str(path))
        assert len(list(path.rglob("*.parquet"))) > 1
        assert spark.read.parquet(str(path)).count() == 40000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_match_folders_and_ratings(spark, matches, tmp_path, rows):
    path = str(tmp_path / "by-match")
    lake_sink.write_partitioned_by_match(matches.withColumn("match_id", F.col("id") * 10), path)
    found = lake.scan_glob(spark, path, "*/*/*/*/*/*.parquet", lake.lake_schema(DATA, lake.MATCH_PARTITION_COLUMNS))
    assert rows(found, "id", "match_id") == [(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)]
    assert (tmp_path / "by-match/tournament_id=3/year=2016/stage_name=Group A/date=20160612/match_id=30").is_dir()


def test_common_entity(spark, matches, tmp_path, rows):
    lake_sink.write_entity(matches, str(tmp_path / "competitions.parquet"))
    assert rows(spark.read.parquet(str(tmp_path / "competitions.parquet"))) == rows(matches)
    assert list((tmp_path / "competitions.parquet").glob("*.gz.parquet"))
