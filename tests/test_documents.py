"""Published document sets, and lookups in the stored slice graph."""

import pytest

from touchline.operators import slices
from touchline.plans import catalog
from touchline.session import configure
from touchline.sinks.commits import CommitLog
from touchline.sinks.documents import BrokenSetError, DocumentSets

SF = "/root/testdata/sf0.001"


def blocks(spark, *rows):
    return spark.createDataFrame(list(rows), "season INT, n_entries BIGINT, document STRING")


@pytest.fixture
def sets(spark, tmp_path):
    found = DocumentSets(spark, str(tmp_path))
    assert found.publish(blocks(spark, (2018, 2, "{a}"), (2018, 1, "{b}"), (2022, 4, "{c}")), "season") == ["2018", "2022"]
    return found


def test_one_season_is_replaced_and_the_others_stay(spark, sets, rows):
    other = sets.manifest()["2022"]
    assert sets.publish(blocks(spark, (2018, 5, "{d}")), "season") == ["2018"]
    assert rows(sets.read()) == [("2018", "{d}"), ("2022", "{c}")]
    assert sets.manifest()["2022"] == other and sets.manifest()["2018"]["entries"] == 5
    assert rows(sets.read(2022)) == [("2022", "{c}")]
    with pytest.raises(KeyError):
        sets.read(1999)


def test_half_written_set_is_not_seen(spark, sets, rows, monkeypatch, tmp_path):
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "publish", lambda self, content: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sets.publish(blocks(spark, (2018, 5, "{d}"), (2030, 5, "{e}")), "season")
    assert rows(sets.read()) == [("2018", "{a}"), ("2018", "{b}"), ("2022", "{c}")]
    with pytest.raises(KeyError):
        sets.read(2030)
    for season in (2018, 2019, 2020, 2021):
        sets.publish(blocks(spark, (season, 1, "{f}")), "season")
    assert len(list((tmp_path / "data").iterdir())) == 5  # the first, and four more; leftovers are removed


@pytest.mark.parametrize("damage", ["lost", "changed", "doubled"])
def test_damaged_set_is_refused(spark, sets, tmp_path, damage):
    path = next(p for p in tmp_path.rglob("*.json") if "set=2018" in str(p))
    text = path.read_text()
    for other in path.parent.glob(".*.crc"):
        other.unlink()
    if damage == "lost":
        path.unlink()
        (path.parent / "part-empty.json").write_text("")
    else:
        path.write_text(text.replace("{a}", "{x}").replace("{b}", "{y}") if damage == "changed" else text + text)
    with pytest.raises(BrokenSetError, match="2018"):
        sets.read()
    assert sets.read(2022).count() == 1
    assert sets.read(2018, verify=False) is not None


@pytest.fixture
def bucketed(spark):
    """Plans that name the buckets they read; Spark prunes them also where it then reads them as plain files."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_lookup_reads_one_bucket_of_the_stored_graph(spark, bucketed):
    graph = catalog._stored_graph(configure(spark), SF)
    for found in (slices.of_index(graph, 3), slices.of_slice(graph, 1995, "3-MEDIUM", 3)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 64" in plan
    assert slices.of_slice(graph, 1995, "3-MEDIUM", 3).count() >= 1


def test_stored_graph_is_found_by_another_session(spark, bucketed, rows, tmp_path):
    graph = catalog._stored_graph(configure(spark), SF)
    path = str(tmp_path / "graph")
    slices.store_graph(graph, "graph_of_one_session", path)
    spark.sql("DROP TABLE graph_of_one_session")
    again = slices.open_graph(spark, "graph_of_another", path, graph.schema)
    assert "SelectedBucketsCount: 1 out of 64" in slices.of_index(again, 2)._jdf.queryExecution().executedPlan().toString()
    assert rows(slices.of_index(again, 2)) == rows(slices.of_index(graph, 2))
    spark.sql("DROP TABLE graph_of_another")
