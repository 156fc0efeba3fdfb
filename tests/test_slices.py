import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brute import brute_force
from touchline.operators import slices, star
from touchline.plans import flows


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(
        [
            (2022, "Cup", 1, "2022-11-20", "A", "B", "Town", "S1", "G", "a.svg", "b.svg"),
            (2022, "Cup", 2, "2022-11-21", "C", "A", "Other", "S1", "G", "c.svg", "a2.svg"),
        ],
        "season INT, competition STRING, match_id BIGINT, game_date STRING, home_team STRING, away_team STRING, "
        "city STRING, stadium STRING, stage STRING, image_path_home STRING, image_path_away STRING",
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """Many games of two documents, most of them at one place and day."""
    return spark.range(400).select(
        F.when(F.col("id") % 5 == 0, 2018).otherwise(2022).cast("int").alias("season"),
        F.lit("Cup").alias("competition"),
        ((F.col("id") * 7919) % 10007).alias("match_id"),
        F.when(F.col("id") % 3 != 0, "2022-01-05").otherwise(
            F.concat(F.lit("2022-02-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0"))
        ).alias("game_date"),
        F.concat(F.lit("T"), (F.col("id") % 11).cast("string")).alias("home_team"),
        F.concat(F.lit("U"), (F.col("id") % 13).cast("string")).alias("away_team"),
        F.concat(F.lit("City "), F.col("id").cast("string")).alias("city"),
        F.when(F.col("id") % 3 != 1, "Big").otherwise(F.concat(F.lit("S"), (F.col("id") % 17).cast("string"))).alias("stadium"),
        F.lit("G").alias("stage"),
        F.lit("h.svg").alias("image_path_home"),
        F.concat(F.lit("a"), F.col("id").cast("string")).alias("image_path_away"),
    )


def test_golden_graph(games, rows):
    found = slices.slices(slices.number_games(games))
    assert rows(found, "index", "type", "key", "matches", "dependencies", "city", "image_path", "n_matches", "part") == [
        (0, "team", "A", [1, 2], [2, 3, 4, 6], None, "a.svg", 2, 0),
        (1, "team", "B", [1], [2, 3, 4], None, "b.svg", 1, 0),
        (2, "place", "S1", [1, 2], [0, 1, 3, 4, 5, 6], "Town", None, 2, 0),
        (3, "stage", "G", [1, 2], [0, 1, 2, 4, 5, 6], None, None, 2, 0),
        (4, "date", "2022-11-20", [1], [0, 1, 2, 3], None, None, 1, 0),
        (5, "team", "C", [2], [2, 3, 6], None, "c.svg", 1, 0),
        (6, "date", "2022-11-21", [2], [0, 2, 3, 5], None, None, 1, 0),
    ]


@pytest.mark.parametrize("page", [10_000, 16, 3])
def test_graph_matches_brute_force(skewed, page):
    """Parts of any length hold the same whole lists."""
    expected = brute_force(skewed.collect())
    found = defaultdict(lambda: {"matches": [], "dependencies": []})
    parts = slices.slices(slices.number_games(skewed), page).collect()
    for row in sorted(parts, key=lambda r: r.part):
        assert len(row.matches) <= page and len(row.dependencies) <= page
        entry = found[(row.season, row.competition, row["index"])]
        entry.update(type=row.type, key=row.key, city=row.city, image=row.image_path)
        entry["matches"] += row.matches
        entry["dependencies"] += row.dependencies
    assert dict(found) == expected


def test_graph_without_any_broadcast(spark, skewed):
    """Nodes too large to broadcast: all joins shuffle, the result is the same."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        parts = slices.slices(slices.number_games(skewed))
        assert "Broadcast" not in parts._jdf.queryExecution().executedPlan().toString()
        expected = brute_force(skewed.collect())
        found = {(r.season, r.competition, r["index"]): (r.key, r.matches, r.dependencies) for r in parts.collect()}
        assert found == {k: (v["key"], v["matches"], v["dependencies"]) for k, v in expected.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_edges_are_symmetric_between_types(skewed):
    numbered = slices.number_games(skewed)
    nodes = slices.nodes(numbered)
    kind = {(r.season, r["index"]): r.type for r in nodes.collect()}
    pairs = [(r.season, r["index"], r.dependency) for r in slices.edges(numbered, nodes).collect()]
    assert len(pairs) == len(set(pairs))
    assert {(s, b, a) for s, a, b in pairs} == set(pairs)
    assert all(kind[s, a] != kind[s, b] for s, a, b in pairs)
    for season in (2018, 2022):
        indexes = sorted(i for s, i in kind if s == season)
        assert indexes == list(range(len(indexes)))


def test_lookup(games, rows):
    assert rows(slices.linked_to(games, "team", "B"), "type", "key", "match_id") == sorted(
        [("match", None, 1), ("place", "S1", None), ("stage", "G", None), ("date", "2022-11-20", None)], key=repr
    )
    assert len(rows(slices.linked_to(games, "place", "S1"))) == 2 + 3 + 1 + 2
    assert rows(slices.linked_to(games, "team", "nobody")) == []


def test_slice_of_an_index(games, rows):
    graph = slices.slices(slices.number_games(games))
    assert rows(slices.of_index(graph, 2), "part", "matches", "dependencies") == [(0, [1, 2], [0, 1, 3, 4, 5, 6])]


def test_lookup_agrees_with_the_graph(skewed):
    graph = slices.slices(slices.number_games(skewed)).collect()
    names = {(r.season, r["index"]): (r.type, r.key) for r in graph}
    linked = slices.linked_to(skewed, "team", "T1").collect()
    for row in graph:
        if (row.type, row.key) == ("team", "T1"):
            mine = [r for r in linked if r.season == row.season]
            assert sorted(r.match_id for r in mine if r.type == "match") == sorted(row.matches)
            assert {(r.type, r.key) for r in mine if r.type != "match"} == {
                names[row.season, d] for d in row.dependencies
            }


def test_season_document(tables):
    documents = flows.season_documents(tables, 2022).collect()
    kinds = ["date", "match", "place", "stage", "team"]
    assert sorted((d.season, d.competition, d.kind, d.block, d.part) for d in documents) == [
        (2022, "Cup 2022", kind, 0, 0) for kind in kinds
    ]
    bodies = [json.loads(d.document) for d in sorted(documents, key=lambda d: d.kind)]
    assert all(list(body) == ["season", "competition", "slices", "matches"] for body in bodies)
    body = {name: [entry for body in bodies for entry in body[name]] for name in ("slices", "matches")}
    assert [m["match_id"] for m in body["matches"]] == [1, 2]
    assert tuple(body["matches"][1]) == (*slices.MATCH_FIELDS, "text_part")
    assert body["matches"][1]["penalty_shootout_home_goals"] is None
    assert body["matches"][0]["result"] == "2(4):2(3)"
    place = next(s for s in body["slices"] if s["type"] == "place")
    assert place["value"] == {"city": "Town", "stadium": "S1"} and "imagePath" not in place and place["part"] == 0
    team = next(s for s in body["slices"] if s["index"] == 0)
    assert team["value"] == {"name": "A"} and team["imagePath"] == "aa.svg" and team["matches"] == [1, 2]


def entries(documents):
    """The slices and matches of some documents, in the order of their blocks."""
    ordered = sorted(documents.collect(), key=lambda d: (d.season, d.competition, d.kind, d.block, d.part))
    bodies = [json.loads(d.document) for d in ordered]
    return {name: [entry for body in bodies for entry in body[name]] for name in ("slices", "matches")}


def shapes(documents):
    found = entries(documents)
    return {tuple(sorted(s)) for s in found["slices"]}, {tuple(sorted(m)) for m in found["matches"]}


def test_more_data_changes_no_shape(tables, spark):
    """Twenty-five times the matches: the same columns and entry shapes, more blocks."""
    many = star.Star(
        **{
            **vars(tables),
            "matches": tables.matches.crossJoin(spark.range(25).select(F.col("id").alias("_copy"))).withColumn(
                "id", F.col("id") + 100 * F.col("_copy").cast("int")
            ).drop("_copy"),
            "goals": tables.goals.crossJoin(spark.range(25).select(F.col("id").alias("_copy"))).withColumn(
                "match_id", F.col("match_id") + 100 * F.col("_copy")
            ).drop("_copy"),
        }
    )
    small, large = (flows.season_documents(t, 2022, page=10, block=10) for t in (tables, many))
    assert small.columns == large.columns and shapes(small) == shapes(large)
    assert {d.kind for d in small.collect()} == {d.kind for d in large.collect()}
    assert len(entries(large)["matches"]) == 25 * len(entries(small)["matches"])
    assert max(d.block for d in large.collect()) == 4


def test_long_documents_come_in_blocks(tables):
    """Blocks of any size hold the same slices and matches."""
    whole = entries(flows.season_documents(tables, 2022))
    short = flows.season_documents(tables, 2022, page=2, block=2)
    pages = [json.loads(d.document) for d in short.collect()]
    assert len(pages) > 5
    merged = defaultdict(lambda: {"matches": [], "dependencies": []})
    for part in (s for p in pages for s in p["slices"]):
        merged[part["index"]]["matches"] += part["matches"]
        merged[part["index"]]["dependencies"] += part["dependencies"]
    for entry in whole["slices"]:
        assert sorted(merged[entry["index"]]["matches"]) == sorted(entry["matches"])
        assert sorted(merged[entry["index"]]["dependencies"]) == entry["dependencies"]
    texts = defaultdict(list)
    for match in sorted((m for p in pages for m in p["matches"]), key=lambda m: m.get("text_part", 0)):
        texts[match["match_id"]].append(match["text"])
    assert {k: ",".join(v) for k, v in texts.items()} == {m["match_id"]: m["text"] for m in whole["matches"]}


def test_schedule_slices(tables, rows):
    found = flows.schedule_slices(tables, 2022).collect()
    assert [r["index"] for r in found] == list(range(len(found)))
    teams = {r.key: r for r in found if r.type == "team"}
    assert teams["A"].image_path == "assets/images/A.png"
    assert teams["B"].matches == [1, 3]  # game 3 has no goals and stays


def test_results_join_keeps_only_scored_games(tables):
    games = slices.slice_games(star.schedule(tables))
    assert sorted(r.match_id for r in slices.games_with_goals(games, tables.goals).collect()) == [1, 2, 5]


def test_unknown_names_stay_in_the_graph(games):
    """A stadium without a name is a slice like any other."""
    unknown = games.withColumn("stadium", F.lit(None).cast("string"))
    found = {r["index"]: r for r in slices.slices(slices.number_games(unknown)).collect()}
    assert len(found) == 7
    assert (found[2].type, found[2].key, found[2].city) == ("place", None, "Town")
    assert found[2].dependencies == [0, 1, 3, 4, 5, 6] and found[2].matches == [1, 2]
    assert 2 in found[0].dependencies


@pytest.mark.parametrize("few", [10_000, 2])
def test_texts_of_games_are_those_of_all_goals(spark, few):
    """Only the games' goals are put into texts, however many a match has; repeated games, copies and NULLs included."""
    goals = spark.createDataFrame(
        [(i % 7, i // 14, None if i % 5 == 0 else f"g{i % 3}") for i in range(98)] + [(None, 1, "x"), (8, 1, None)],
        "match_id BIGINT, minute INT, text STRING",
    )
    ids = spark.createDataFrame([(1,), (1,), (3,), (8,), (9,), (None,)], "match_id BIGINT")
    games = slices.games_with_counts(ids, goals)
    assert sorted(map(tuple, games.collect())) == [(1, 14), (1, 14), (3, 14), (8, 1)]
    every = star.goals_per_match(goals, ["minute"], 4).where("match_id IN (1, 3, 8)")
    found = star.goal_texts(goals, games, ["minute"], 4, few)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, every.collect()), key=repr)
    assert found.columns == every.columns and found.count() == 9


def test_blocks_are_made_where_the_lists_are(spark, skewed, tmp_path):
    """Neither the lists of the slices nor the blocks made of them are moved once more."""
    base = str(tmp_path / "numbered")
    slices.number_games(skewed).write.parquet(base)
    numbered = spark.read.parquet(base)
    graph_nodes = slices.nodes(numbered)
    plain = slices.slices(numbered, 16, graph_nodes)
    together = slices.slices(numbered, 16, graph_nodes, block=8)
    assert sorted(map(repr, together.drop("block").collect())) == sorted(map(repr, plain.collect()))
    assert together.where("block != index div 8").isEmpty()
    matches = numbered.select(
        "season", "competition", "ord", F.lit(0).cast("bigint").alias("text_part"),
        *[F.col(name) if name in numbered.columns else F.lit(None).cast("string").alias(name)
          for name in slices.MATCH_FIELDS],
    )

    def made(graph):
        return slices.documents(graph, matches, 8)

    assert sorted(map(repr, made(together).collect())) == sorted(map(repr, made(plain).collect()))
    blocks = together.select("season", "competition", F.col("type").alias("kind"), "block", "part", F.col("index").alias("at"),
                             F.col("key").alias("entry"))
    lists, made_blocks = (plan.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                          for plan in (together._jdf, slices._blocks(blocks, "slices")._jdf))
    assert made_blocks == lists
