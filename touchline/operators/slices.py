"""The slice graph: teams, places, stages and match days linked by the matches they share.

One document per (season, competition). A slice has an index, numbered from 0 by first appearance in
(game_date, match_id, slot) order, the slots being home team, away team, place, stage, date. It lists its
matches and the indexes of slices of another type that occur in the same matches.

All documents are built in one pass. The matches are numbered once and written; everything else follows from
these rows by plain aggregation, and lists are cut into parts: part k holds the list entries numbered
k*page … (k+1)*page-1. Documents are cut into blocks of a fixed number of entries in the same way. The layout
doesn't depend on how many matches there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import dates, text
from touchline.operators.numbering import join_same, number_by_block, number_within
from touchline.operators.pages import PAGE
from touchline.session import cut_lineage

DOCUMENT = ("season", "competition")
_NODE = (*DOCUMENT, "type", "key")
BLOCK = 500  # entries of a document block
_SLOTS = 8  # room for the five slots of a match in one whole number


def slice_games(schedule: DataFrame, team_images: str = "flag", keep: Sequence[str] = ()) -> DataFrame:
    """The columns of schedule rows that make up the graph, and those in ``keep``.

    ``team_images`` picks the code-based ``flag`` files or the name-based ``team`` pictures.
    """
    home, away = F.col("image_path_home"), F.col("image_path_away")
    if team_images == "team":
        home, away = text.team_image(F.col("home_team")), text.team_image(F.col("away_team"))
    return schedule.select(
        "season",
        "competition",
        "match_id",
        dates.kickoff_day(F.col("date")).alias("game_date"),
        "home_team",
        "away_team",
        "city",
        "stadium",
        "stage",
        home.alias("image_path_home"),
        away.alias("image_path_away"),
        *keep,
    )


def games_with_goals(games: DataFrame, goals: DataFrame) -> DataFrame:
    """Games at least one goal is recorded for."""
    scored = goals.select(F.col("match_id").alias("_scored")).distinct()
    return games.join(scored, games["match_id"] == scored["_scored"], "left_semi")


def games_with_counts(games: DataFrame, goals: DataFrame) -> DataFrame:
    """The rows of :func:`games_with_goals` with ``n_goals``, the number of goals of the match."""
    counted = goals.groupBy(F.col("match_id").alias("_scored")).agg(F.count(F.lit(1)).alias("n_goals"))
    return games.join(counted, games["match_id"] == counted["_scored"]).drop("_scored")


def number_games(games: DataFrame) -> DataFrame:
    """Games with ``ord``, their position in the document: the base of everything below.

    A match is in a document once, so day and match id order its games without ties. The sorted games are the one
    full write; what turns places into positions is a side table of a row per task and document, read along with them.
    """
    return number_within(games, DOCUMENT, ["game_date", "match_id"], "ord", unique=True)


# (slot, type, key column) of the entities of a game, in slot order
_ENTITIES = (
    (0, "team", "home_team"),
    (1, "team", "away_team"),
    (2, "place", "stadium"),
    (3, "stage", "stage"),
    (4, "date", "game_date"),
)


def occurrences(numbered: DataFrame) -> DataFrame:
    """Five rows per game, one for each of its slices."""
    entities = [
        F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("type"), F.col(column).alias("key"))
        for slot, kind, column in _ENTITIES
    ]
    return numbered.select(*DOCUMENT, "ord", "match_id", F.inline(F.array(*entities)))


def nodes(numbered: DataFrame) -> DataFrame:
    """(season, competition, index, type, key, city, image_path, n_matches), one row per slice.

    City and image are those of the game the slice first appears in; they are looked up afterwards, so
    that the large aggregation only keeps numbers and stays a hash aggregation. Nodes are few compared to
    the games and are written to the shared folder, because every list needs their indexes.
    """
    found = (
        occurrences(numbered)
        .groupBy(*_NODE)
        .agg(F.min(F.col("ord") * _SLOTS + F.col("slot")).alias("first"), F.count(F.lit(1)).alias("n_matches"))
    )
    indexed = cut_lineage(
        number_by_block(found, DOCUMENT, "first", "index").withColumn("ord", F.expr(f"first div {_SLOTS}"))
    )
    looks = numbered.select(*DOCUMENT, "ord", "city", "image_path_home", "image_path_away")
    slot = F.col("first") % _SLOTS
    image = F.when(slot == 0, F.col("image_path_home")).when(slot == 1, F.col("image_path_away"))
    described = join_same(looks, indexed, [*DOCUMENT, "ord"]).select(
        *DOCUMENT, "index", "type", "key", F.when(slot == 2, F.col("city")).alias("city"),
        image.alias("image_path"), "n_matches",
    )
    return cut_lineage(described)


def _links(numbered: DataFrame) -> DataFrame:
    """Distinct links between two slices of a document, in both directions.

    The nine pairs of a game are deduplicated before the shuffle and mirrored after it.
    """
    teams = [("team", "home_team"), ("team", "away_team")]
    others = [("place", "stadium"), ("stage", "stage"), ("date", "game_date")]
    pairs = [(t, o) for t in teams for o in others]
    pairs += [(others[i], others[j]) for i in range(len(others)) for j in range(i + 1, len(others))]
    listed = F.array(
        *[
            F.struct(
                F.lit(a_type).alias("a_type"), F.col(a_key).alias("a_key"),
                F.lit(b_type).alias("b_type"), F.col(b_key).alias("b_key"),
            )
            for (a_type, a_key), (b_type, b_key) in pairs
        ]
    )
    once = numbered.select(*DOCUMENT, F.inline(listed)).distinct()
    both = F.array(
        F.struct(
            F.col("a_type").alias("type"), F.col("a_key").alias("key"),
            F.col("b_type").alias("to_type"), F.col("b_key").alias("to_key"),
        ),
        F.struct(
            F.col("b_type").alias("type"), F.col("b_key").alias("key"),
            F.col("a_type").alias("to_type"), F.col("a_key").alias("to_key"),
        ),
    )
    return once.select(*DOCUMENT, F.inline(both))


def _with_target_index(links: DataFrame, graph_nodes: DataFrame) -> DataFrame:
    target = graph_nodes.select(
        *DOCUMENT, F.col("type").alias("to_type"), F.col("key").alias("to_key"), F.col("index").alias("dependency")
    )
    return join_same(links, target, [*DOCUMENT, "to_type", "to_key"])


def edges(numbered: DataFrame, graph_nodes: DataFrame | None = None) -> DataFrame:
    """(season, competition, index, dependency): symmetric, distinct, never between equal types."""
    graph_nodes = nodes(numbered) if graph_nodes is None else graph_nodes
    own = graph_nodes.select(*_NODE, "index")
    return join_same(_with_target_index(_links(numbered), graph_nodes), own, _NODE).select(*DOCUMENT, "index", "dependency")


def _sorted_list(condition: Column, entry: Column) -> Column:
    return F.sort_array(F.collect_list(F.when(condition, entry)))


def slices(
    numbered: DataFrame, page: int = PAGE, graph_nodes: DataFrame | None = None, block: int | None = None
) -> DataFrame:
    """One row per slice and part, with the sorted ``matches`` and ``dependencies`` of that part.

    With ``block``, the entries of a document block (:func:`documents`) are brought together before they are listed, so
    that neither the lists nor the blocks made of them are moved; the rows then have their ``block``.
    """
    graph_nodes = nodes(numbered) if graph_nodes is None else graph_nodes
    # Lists are moved under the index of their slice, not under its name: nodes are few, and both joins look them up.
    index_of = graph_nodes.select(*_NODE, "index")
    match_entries = join_same(occurrences(numbered), index_of, _NODE).select(
        *DOCUMENT, "type", "index", F.expr(f"ord div {page}").alias("part"), F.col("ord").alias("position"), "match_id"
    )
    dependency_entries = join_same(_with_target_index(_links(numbered), graph_nodes), index_of, _NODE).select(
        *DOCUMENT, "type", "index",
        F.expr(f"dependency div {page}").alias("part"),
        F.col("dependency").alias("position"),
        F.lit(None).cast(numbered.schema["match_id"].dataType).alias("match_id"),
    )
    entries = match_entries.unionByName(dependency_entries)
    together = [*DOCUMENT, "type", "index", "part"]
    if block is not None:
        entries = entries.withColumn("block", F.expr(f"index div {block}"))
        entries = entries.repartition(*DOCUMENT, "type", "block", "part")
        together.append("block")
    is_match = F.col("match_id").isNotNull()
    parts = (
        entries.groupBy(*together)
        .agg(
            _sorted_list(is_match, F.struct("position", "match_id")).alias("placed"),
            _sorted_list(~is_match, F.col("position")).alias("dependencies"),
        )
        .select(*together, F.col("placed.match_id").alias("matches"), "dependencies")
    )
    found = join_same(parts, graph_nodes.drop("type"), [*DOCUMENT, "index"])
    return found.select(
        *DOCUMENT, "index", "type", "key", "city", "image_path", "part", "n_matches", "matches", "dependencies",
        *([] if block is None else ["block"]),
    )


def linked_to(games: DataFrame, kind: str, key: str) -> DataFrame:
    """(season, competition, type, key, match_id) for the matches of one slice.

    Rows with type ``match`` are its matches; the others are the distinct slices linked to it. The slice
    only filters the games, so the graph of the other slices is never built.
    """
    columns = {"team": ("home_team", "away_team"), "place": ("stadium",), "stage": ("stage",), "date": ("game_date",)}
    selected = F.lit(False)
    for column in columns[kind]:
        selected = selected | (F.col(column) == key)
    linked = [
        F.struct(F.lit(other).alias("type"), F.col(column).alias("key"), F.lit(None).cast("bigint").alias("match_id"))
        for other, names in columns.items()
        if other != kind
        for column in names
    ]
    match = F.struct(
        F.lit("match").alias("type"), F.lit(None).cast("string").alias("key"),
        F.col("match_id").cast("bigint").alias("match_id"),
    )
    return games.where(selected).select(*DOCUMENT, F.inline(F.array(match, *linked))).distinct()


def of_index(graph: DataFrame, index: int) -> DataFrame:
    """(season, competition, part, matches, dependencies) of the slice with an index, out of the rows of ``slices``.

    Out of a stored graph (:func:`store_graph`), one bucket is read.
    """
    return graph.where(F.col("index") == index).select(*DOCUMENT, "part", "matches", "dependencies")


def store_graph(graph: DataFrame, name: str, path: str, buckets: int = 64) -> None:
    """Keep the rows of :func:`slices` as a table in buckets by index, sorted by document inside a bucket.

    Spark prunes buckets of one column only. Every document numbers its slices from 0, so the index spreads them evenly,
    and a document is found in its bucket by the statistics of the sorted row groups. The table stays at ``path`` for
    other sessions, which open it with :func:`open_graph`.
    """
    graph.repartition(buckets, "index").write.bucketBy(buckets, "index").sortBy(*DOCUMENT, "index").option(
        "path", path
    ).mode("overwrite").saveAsTable(name)


def open_graph(spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int = 64) -> DataFrame:
    """The stored graph, entered in the catalog if this session doesn't know it."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (index) "
            f"SORTED BY ({', '.join(DOCUMENT)}, index) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def of_slice(graph: DataFrame, season: int, competition: str, index: int) -> DataFrame:
    """The rows of one slice of one document; out of a stored graph, one bucket is read."""
    wanted = (F.col("season") == season) & (F.col("competition") == competition)
    return of_index(graph.where(wanted), index)


MATCH_FIELDS = (
    "match_id", "status", "year", "date", "time", "home_team", "away_team", "city", "stadium", "stage",
    "total_home_goals", "total_away_goals", "penalty_shootout_home_goals", "penalty_shootout_away_goals",
    "text", "image_path_home", "image_path_away", "result",
)


# Schedule columns the result rows of a document need beyond those of the graph.
RESULT_COLUMNS = (
    "status_id", "date", "total_home_goals", "total_away_goals",
    "penalty_shootout_home_goals", "penalty_shootout_away_goals",
)


def _slice_json() -> Column:
    kind = F.col("type")
    value = F.struct(
        F.when(kind.isin("team", "stage"), F.col("key")).alias("name"),
        F.col("city"),
        F.when(kind == "place", F.col("key")).alias("stadium"),
        F.when(kind == "date", F.col("key")).alias("date"),
    )
    # Fields that do not belong to the slice's type are NULL and therefore left out.
    return F.to_json(
        F.struct(
            "type", value.alias("value"), "index", "dependencies", "matches",
            F.col("image_path").alias("imagePath"), "part",
        )
    )


def _match_json() -> Column:
    return F.to_json(F.struct(*MATCH_FIELDS, "text_part"), {"ignoreNullFields": "false"})


def documents(graph: DataFrame, matches: DataFrame, block: int = BLOCK) -> DataFrame:
    """(season, competition, kind, block, part, n_entries, document): the JSON documents, in blocks of the same shape.

    ``graph`` are the rows of :func:`slices`, ``matches`` the result rows of the numbered games, keeping
    ``season`` and ``ord``. A block is {season, competition, slices, matches} with the entries of one ``kind``, a
    slice type or ``match``, that are numbered block*``block`` … and are the ``part`` of their list or text. The whole
    document is its blocks in the order of kind, block and part.
    """
    slice_entries = graph.select(
        *DOCUMENT,
        F.col("type").alias("kind"),
        F.col("block") if "block" in graph.columns else F.expr(f"index div {block}").alias("block"),
        "part",
        F.col("index").alias("at"),
        _slice_json().alias("entry"),
    )
    match_entries = matches.select(
        *DOCUMENT,
        F.lit("match").alias("kind"),
        F.expr(f"ord div {block}").alias("block"),
        F.col("text_part").alias("part"),
        F.col("ord").alias("at"),
        _match_json().alias("entry"),
    )
    # A block has entries of one kind, so slices and matches are put together apart.
    return _blocks(slice_entries, "slices").unionByName(_blocks(match_entries, "matches"))


def _blocks(entries: DataFrame, field: str) -> DataFrame:
    """The blocks of (season, competition, kind, block, part, at, entry) rows, whose entries go into ``field``."""
    listed = F.sort_array(F.collect_list(F.struct("at", "entry"))).alias("_listed")
    grouped = entries.groupBy(*DOCUMENT, "kind", "block", "part").agg(listed)
    head = F.to_json(F.struct(*DOCUMENT))
    text = F.array_join("_listed.entry", ",")
    lists = [F.concat(F.lit(f',"{name}":['), text if name == field else F.lit(""), F.lit("]")) for name in ("slices", "matches")]
    body = F.concat(F.expr("substring(head, 1, length(head) - 1)"), *lists, F.lit("}"))
    n_entries = F.size("_listed").cast("bigint").alias("n_entries")
    return grouped.withColumn("head", head).select(*DOCUMENT, "kind", "block", "part", n_entries, body.alias("document"))
