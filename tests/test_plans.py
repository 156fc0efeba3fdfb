"""Shapes of the physical plans that keep the work distributed."""

import re

import pytest
from pyspark.sql import functions as F

from touchline.operators import numbering, pages, slices, star
from touchline.plans import analog, catalog, flows
from touchline.session import configure, cut_lineage, shared_dir

SF = "/root/testdata/sf0.001"
LAZY = (
    "star_schedule", "goals_by_season", "fact_load", "goal_text", "stadium_dim", "json_scorers", "clean_types",
    "fk_violations", "local_time_fixed", "slice_lookup", "duplicate_places", "stadium_link", "unique_violations",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan
    assert "Exchange SinglePartition" not in plan


def test_no_global_window_in_the_graph(spark):
    numbered = slices.number_games(catalog._scored_games(configure(spark), SF))
    for df in (slices.slices(numbered), slices.edges(numbered)):
        plan = plan_of(df)
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_node_aggregation_stays_a_hash_aggregation(spark):
    numbered = slices.number_games(catalog._scored_games(configure(spark), SF))
    found = slices.occurrences(numbered).groupBy("season", "competition", "type", "key").agg({"ord": "min"})
    assert "SortAggregate" not in plan_of(found) and "HashAggregate" in plan_of(found)


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(star.goals_per_match(analog.goals(spark, SF), analog.GOAL_ORDER))
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert read and all("l_tax" not in columns and "l_shipdate" not in columns for columns in read)


def test_filters_reach_the_scan(spark):
    plan = plan_of(catalog.queries()["incremental_30d"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts", plan)
    plan = plan_of(catalog.queries()["relational_eq_scan"](spark, SF))
    assert "EqualTo(o_orderstatus,F)" in plan


def test_lake_writes_are_rebalanced(spark):
    df = analog.lake_rows(spark, SF)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(df.hint("rebalance", "tournament_id", "year"))


def test_cut_lineage_uses_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    cut = cut_lineage(spark.range(10))
    assert cut.count() == 10
    assert all(name.startswith("file:" + shared_dir(spark)) for name in (f.replace("file://", "file:") for f in cut.inputFiles()))
    assert folder is None or shared_dir(spark) == folder.rstrip("/")
    assert cut_lineage(spark.range(0)).isEmpty()


def test_written_small_sides_are_broadcast_at_once(spark):
    """The size of written nodes is known, so the large side is not shuffled for the join."""
    numbered = slices.number_games(catalog._scored_games(configure(spark), SF))
    nodes = slices.nodes(numbered)
    plan = plan_of(slices._with_target_index(slices._links(numbered), nodes))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.fixture
def hot_joins(spark):
    """Thresholds small enough for test data: every join shuffles, and hot partitions count as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_key(n):
    return F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % n)


def splits(df):
    df.collect()
    return "skew=true" in plan_of(df)


def test_hot_match_is_split_in_goal_rows(spark, hot_joins):
    timeline = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("EventId"), hot_key(2000).alias("IdMatch"), F.col("id").alias("IdPlayer"),
        F.sha2(F.col("id").cast("string"), 256).alias("MatchMinute"),
        F.lit('[{"Description":"x"}]').alias("EventDescription"), F.lit("Goal!").alias("TypeLocalized"),
    )
    link = spark.range(2000).select(F.col("id").alias("match_id"), F.col("id").alias("match_id_fifa"))
    found = star.goal_rows(timeline, link)
    assert splits(found) and found.count() == 30000


def test_hot_coordinates_are_split(spark, hot_joins):
    places = spark.range(0, 30000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("stadium"),
        hot_key(2000).cast("double").alias("lat"), F.lit(1.0).alias("lng"),
    )
    found = star.duplicate_places(places, ordered=False)
    assert splits(found) and found.count() == 30000


def test_hot_source_match_is_split_in_the_local_dates(spark, hot_joins):
    matches = spark.range(0, 30000, 1, 8).select("id", F.lit("+").alias("date"))
    link = spark.range(0, 30000, 1, 8).select(F.col("id").alias("match_id"), hot_key(2000).alias("match_id_uefa"))
    source = spark.range(2000).select(
        "id", F.lit("2020-06-12T19:00:00Z").alias("dateTime"), F.lit(1).alias("utcOffsetInHours")
    )
    found = star.corrected_local_dates(matches, link, source)
    assert splits(found) and found.count() == 30000


def test_documents_read_their_sources_once(spark, monkeypatch):
    """Goals and scores are the only two things that documents take from the lines."""
    plans = []
    for module in (numbering, slices, flows, pages):
        original = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, original=original: plans.append(plan_of(df)) or original(df))
    tables = analog.star_tables(configure(spark), SF)
    plans.append(plan_of(flows.season_documents(tables, goal_order=analog.GOAL_ORDER)))
    assert sum(len(re.findall(r"Location[^\n]*lineitem", plan)) for plan in plans) == 2
    assert sum(len(re.findall(r"Location[^\n]*orders", plan)) for plan in plans) <= 2


def test_lists_read_their_rows_once(spark, monkeypatch):
    plans = []
    original = pages.cut_lineage
    monkeypatch.setattr(pages, "cut_lineage", lambda df: plans.append(plan_of(df)) or original(df))
    plans.append(plan_of(star.goals_per_match(analog.goals(configure(spark), SF), analog.GOAL_ORDER)))
    assert sum(len(re.findall(r"Location[^\n]*lineitem", plan)) for plan in plans) == 1


def test_children_and_parents_are_scanned_once_for_all_keys(spark):
    plan = plan_of(catalog.queries()["fk_violations"](spark, SF))
    scans = re.findall(r"Location[^\n]*/(\w+)\.parquet", plan)
    assert scans.count("lineitem") == 1 and scans.count("supplier") == 2  # as a child and as a parent
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.fixture
def writes(spark, monkeypatch):
    """The plans of all frames that are written aside."""
    plans = []
    for module in (numbering, slices, flows, pages):
        original = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, original=original: plans.append(plan_of(df)) or original(df))
    configure(spark)
    return plans


def test_numbered_games_are_written_once(spark, writes):
    slices.number_games(catalog._scored_games(spark, SF))
    assert sum("home_team" in plan and "orders" in plan for plan in writes) == 1
    assert len(writes) == 2 and "orders" not in writes[1]  # the other one is the shifts


@pytest.mark.parametrize("unique", [True, False])
def test_lists_write_their_rows_once_as_runs(spark, writes, unique):
    """Rows are folded into runs before the shuffle; the second write has a row per run of a key with several."""
    goals = analog.goals(spark, SF)
    found = pages_of(goals, unique)
    assert len(writes) == 2 and "lineitem" in writes[0] and "lineitem" not in writes[1]
    assert "partial_collect_list" in writes[0] and "partial_collect_list" not in writes[1]
    assert found.count() > 0


def pages_of(goals, unique):
    return pages.paged_list(goals, ["match_id"], analog.GOAL_ORDER, "text", "texts", page=3, unique=unique)
