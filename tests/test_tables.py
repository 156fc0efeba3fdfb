import pytest
from pyspark.sql import functions as F

from touchline.sinks import tables as sink
from touchline.sources import relational


def test_all_conditions_hold_together(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2), (2, "a", 2)], "x INT, y STRING, z INT")
    assert rows(relational.rows_where(df, {"x": 1, "y": "a"})) == [(1, "a", None)]
    assert rows(relational.rows_where(df, {"z": None}), "x") == [(1,)]
    assert relational.rows_where(df).count() == 3


def test_query_over_frames(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, t STRING")
    assert rows(relational.query_tables(spark, "SELECT t FROM {m} WHERE id = 2", m=df)) == [("b",)]


def test_parallel_scan_options():
    assert relational.partition_options("id", (0, 1000), 8) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    assert relational.partition_options(None, None, None) == {}
    with pytest.raises(ValueError):
        relational.partition_options("id", None, 8)


def test_append_and_stamp(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sink.append_table(sink.stamped(spark.range(3)), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6 and stored.where("dt_updated IS NULL").count() == 0


def test_column_order(spark):
    df = spark.sql("SELECT 'x' AS b, 1L AS a, true AS c")
    ordered = sink.in_column_order(df, "a INT, b STRING, d DATE")
    assert ordered.schema.simpleString() == "struct<a:int,b:string,d:date>"
    assert tuple(ordered.first()) == (1, "x", None)


def test_documents_by_key(spark, tmp_path, rows):
    docs = spark.createDataFrame([(2022, '{"a":1}'), (2018, '{"a":2}')], "season INT, document STRING")
    sink.write_documents(docs, str(tmp_path / "d"), keys=["season"])
    assert rows(spark.read.text(str(tmp_path / "d")), "value") == [('{"a":1}',), ('{"a":2}',)]
    assert (tmp_path / "d" / "season=2022").is_dir()


def test_created_table(spark, rows):
    sink.create_table(spark.range(2).withColumn("y", F.lit(1)), "made_table", ["y"])
    assert rows(spark.table("made_table"), "id") == [(0,), (1,)]
    spark.sql("DROP TABLE made_table")


def test_insert_by_name(spark, rows):
    sink.create_table(spark.sql("SELECT 1 AS id, 'a' AS t"), "insert_target")
    sink.insert_rows(spark.sql("SELECT 'b' AS t, 2L AS id"), "insert_target")
    assert rows(spark.table("insert_target")) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE insert_target")


def test_query_scans_can_be_split():
    from touchline.sources.relational import query_options

    assert query_options("SELECT 1 AS a") == {"query": "SELECT 1 AS a"}
    assert query_options("SELECT a FROM t", "a", (0, 9), 3) == {
        "dbtable": "(SELECT a FROM t) q", "partitionColumn": "a", "lowerBound": "0", "upperBound": "9", "numPartitions": "3",
    }
    with pytest.raises(ValueError):
        query_options("SELECT a FROM t", "a")
