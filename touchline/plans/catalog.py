"""The registered queries: every operator over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import dates
from touchline.functions.cleaning import clean, reject_counts
from touchline.operators import quality, shaping, slices, staging, star
from touchline.plans import analog, flows
from touchline.plans.analog import table
from touchline.plans.models import MODELS, materialize
from touchline.schemas import CALENDAR_MATCH, GAME_MESSAGE, match_status_seed, stage_seed
from touchline.session import configure, exists, scratch_path
from touchline.sinks import lake as lake_sink
from touchline.sinks import tables as table_sink
from touchline.sinks.documents import DocumentSets
from touchline.sources import lake, landed, relational
from touchline.streaming import games as live

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir.rstrip("/"))

    configured.__name__ = query.__name__
    configured.__doc__ = query.__doc__
    _QUERIES[query.__name__] = configured
    return query


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _text(values: str | Column) -> Column:
    return F.concat_ws(",", F.col(values).cast("array<string>"))


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers that may be NULL as text, which every client compares the same way."""
    return df.withColumns({column: F.col(column).cast("string") for column in columns})


def _moment(df: DataFrame, column: str = "ts") -> DataFrame:
    """A time stamp as text to the microsecond."""
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# ---------------------------------------------------------------- lake scans and partition selection

_LAKE_DATA = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"
_LAKE_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "tournament_id", "year", "stage_name", "date")
_landed_lakes: dict[tuple[str, str], str] = {}


def land_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake of this session's orders, landed by the first query that reads it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed_lakes or not exists(spark, _landed_lakes[key]):
        path = scratch_path(spark, "lake")
        lake_sink.write_partitioned(analog.lake_rows(spark, sf_dir), path)
        _landed_lakes[key] = path
    return _landed_lakes[key]


def _lake_scan(spark: SparkSession, sf_dir: str, *folders: int) -> DataFrame:
    rows = lake.scan_lake(spark, land_lake(spark, sf_dir), lake.lake_schema(_LAKE_DATA), *folders)
    return rows.select(*_LAKE_COLUMNS)


@register
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lake.scan_glob(spark, land_lake(spark, sf_dir), schema=lake.lake_schema(_LAKE_DATA))
    return rows.select(*_LAKE_COLUMNS)


@register
def scan_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity file per region, written and found by its name at the end of the partition path."""
    root = scratch_path(spark, "entities")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for region in [row[0] for row in table(spark, sf_dir, "region").select("r_regionkey").collect()]:
        rows = nations.where(F.col("n_regionkey") == region).drop("n_regionkey")
        lake_sink.write_entity(rows, f"{root}/tournament_id={region}/nations.parquet")
    schema = lake.lake_schema("n_nationkey INT, n_name STRING", ("tournament_id",))
    return lake.scan_entity(spark, root, "nations", 1, schema)


@register
def scan_path_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = lake.scan_files(spark, [land_lake(spark, sf_dir)], _LAKE_DATA)
    return lake.path_columns(files).select(*_LAKE_COLUMNS)


@register
def select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.select_partitions(_lake_scan(spark, sf_dir), lake.SearchOption.ALL, tournament_id=1, year=2001)


@register
def select_tournament_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.select_partitions(_lake_scan(spark, sf_dir, 1, 2000), lake.SearchOption.TOURNAMENT_YEAR, 1, 2000)


@register
def select_tournament_year_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.select_partitions(
        _lake_scan(spark, sf_dir, 1, 2000), lake.SearchOption.TOURNAMENT_YEAR_DATE, 1, 2000, "20000401"
    )


# ---------------------------------------------------------------- landed feeds

_RESPONSE_ROWS = 500  # records per landed response


def _responses(df: DataFrame) -> DataFrame:
    """(records): rows of ``df`` in arrays of at most one response."""
    row = F.struct(*df.columns).alias("row")
    numbered = df.select(row, F.monotonically_increasing_id().alias("at"))
    return numbered.groupBy(F.expr(f"at div {_RESPONSE_ROWS}").alias("page")).agg(
        F.collect_list("row").alias("records")
    )


def _land_text(df: DataFrame, value: Column, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.select(value.alias("value")).write.text(path)
    return path


@register
def scan_csv_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("Country"), F.col("c_name").alias("Club"), F.col("c_acctbal").alias("Elo")
    )
    path = scratch_path(spark, "ratings-feed")
    feed.write.option("header", "true").csv(path)
    return landed.read_ratings(spark, path, feed.schema, "2023-01-01")


@register
def scan_json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    pages_ = _responses(records)
    path = _land_text(pages_, F.to_json(F.struct(F.col("records").alias("Results"))), "envelopes")
    return landed.read_envelopes(spark, path, records.schema, json_lines=True)


@register
def scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = _land_text(_responses(records), F.to_json("records"), "arrays")
    return landed.read_records(spark, path, records.schema, json_lines=True)


@register
def scan_json_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the records of one response folder per nation."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.col("c_nationkey").alias("tag")
    )
    path = scratch_path(spark, "keyed")
    rows.write.partitionBy("tag").json(path)
    return landed.read_keyed(spark, path, rows.drop("tag").schema, "tag INT", json_lines=True)


def _match_columns(rows: DataFrame) -> DataFrame:
    return rows.select("id", "tournament_id", "year", "stage_name", "date")


@register
def land_match_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with one match per line, through the landing flow into the lake."""
    records = analog.landed_matches(spark, sf_dir)
    feed = _land_text(records, F.to_json(F.struct(*records.columns)), "match-lines")
    target = scratch_path(spark, "landed")
    flows.land_matches(spark, feed, records.schema, target, 3, 2020, json_lines=True)
    return _match_columns(lake.scan_lake(spark, target, lake.lake_schema("id BIGINT")))


@register
def land_match_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with one array per file, through the landing flow into the lake."""
    records = analog.landed_matches(spark, sf_dir)
    feed, target = scratch_path(spark, "match-arrays"), scratch_path(spark, "landed")
    _responses(records).select("page", F.to_json("records").alias("value")).write.partitionBy("page").text(feed)
    flows.land_matches(spark, feed, records.schema, target, 3, 2020, json_lines=False)
    return _match_columns(lake.scan_lake(spark, target, lake.lake_schema("id BIGINT")))


@register
def land_calendars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar responses of all tournaments, whose matches are on the first two days of a quarter, through the flow."""
    stages = _calendar_stages(spark, sf_dir, F.date_trunc("QUARTER", "o_orderdate").cast("timestamp_ntz"))
    stages = stages.withColumn("tournament_id", analog.tournament(F.col("o_orderpriority")))
    feed, target = scratch_path(spark, "calendars"), scratch_path(spark, "landed")
    text = F.to_json(F.struct("stage_name", "matches")).alias("value")
    stages.select("tournament_id", text).write.partitionBy("tournament_id").text(feed)
    flows.land_calendar(spark, feed, CALENDAR_MATCH, target, json_lines=True)
    return _match_columns(lake.scan_lake(spark, target, lake.lake_schema("id BIGINT")))


@register
def land_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating feeds of two days, the first landed once more, with other ratings, through the landing flow."""
    target = scratch_path(spark, "landed")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("Country"),
        F.concat(F.lit("Club "), F.col("c_nationkey").cast("string")).alias("Club"),
        F.col("c_custkey").alias("Rank"),
        F.col("c_acctbal").alias("Elo"),
    )
    for day, factor in (("2023-01-01", 1), ("2023-01-02", 1), ("2023-01-01", -1)):
        feed = scratch_path(spark, "ratings-feed")
        customers.withColumn("Elo", factor * F.col("Elo")).write.option("header", "true").csv(feed)
        flows.land_ratings(spark, feed, customers.schema, target, day)
    schema = lake.lake_schema("Rank BIGINT, Elo DOUBLE", ())
    kinds = [T.StructField(name, T.StringType()) for name in lake_sink.RATING_PARTITION_COLUMNS]
    return lake.scan_lake(spark, target, T.StructType([*schema.fields, *kinds]))


def _named_records(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Records of a JSON feed of competitions, which are tournaments in a season, whose name contains a pattern."""
    records = analog.competitions(spark, sf_dir).select("id", F.concat_ws(" ", "caption", "year").alias("name"))
    path = _land_text(_responses(records), F.to_json("records"), "named")
    return landed.read_tournaments(spark, path, records.schema, name, json_lines=True)


@register
def tournaments_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_records(spark, sf_dir, "HIGH|LOW")


@register
def seasons_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_records(spark, sf_dir, "1998")


def _calendar_stages(spark: SparkSession, sf_dir: str, day: Column | None = None) -> DataFrame:
    """Orders as calendar stages of two matches, at noon and one minute after the next midnight."""
    seconds = analog.unix_seconds(F.col("o_orderdate") if day is None else day)
    noon = F.struct(F.col("o_orderkey").alias("id"), (seconds + 43200).alias("time"))
    late = F.struct((-F.col("o_orderkey") - 1).alias("id"), (seconds + 86460).alias("time"))
    stage = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        stage.alias("stage_name"), F.array(noon, late).alias("matches"), "o_orderpriority"
    )


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = _calendar_stages(spark, sf_dir)
    path = _land_text(stages, F.to_json(F.struct("stage_name", "matches")), "calendar")
    return landed.read_calendar(spark, path, CALENDAR_MATCH, json_lines=True)


@register
def calendar_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.explode_calendar(_calendar(spark, sf_dir))


@register
def calendar_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.explode_calendar(_calendar(spark, sf_dir), "1998-07-01")


@register
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return staging.named_like(staging.named_like(parts, "p_name", "widget"), "p_brand", "1")


# ---------------------------------------------------------------- relational scans and appends


@register
def relational_eq_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.rows_where(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
        {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"},
    )


@register
def relational_query_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.query_tables(
        spark,
        "SELECT n.n_name, r.r_name, CAST(count(*) AS BIGINT) AS n_customers FROM {customer} c "
        "JOIN {nation} n ON n.n_nationkey = c.c_nationkey JOIN {region} r ON r.r_regionkey = n.n_regionkey "
        "GROUP BY n.n_name, r.r_name",
        **{name: table(spark, sf_dir, name) for name in ("customer", "nation", "region")},
    )


@register
def pending_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit(0).alias("is_on_s3"))
    landed_rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return staging.pending(seasons, landed_rows).select("id")


@register
def pending_from_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasons of which the lake has no folder; only two of three have been landed, and no landed row is read."""
    path = scratch_path(spark, "seasons")
    rows = analog.lake_rows(spark, sf_dir).where("(tournament_id + year) % 3 <> 0")
    lake_sink.write_partitioned(rows, path)
    seasons = analog.competitions(spark, sf_dir).select(
        "id", F.expr("id div 10000").alias("tournament_id"), "year", F.lit(0).alias("is_on_s3")
    )
    return flows.pending_seasons(seasons, path, {"tournament_id": "tournament_id", "year": "year"}).drop("is_on_s3")


@register
def relational_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for _ in range(2):
        table_sink.append_table(table_sink.stamped(rows), path)
    return (
        spark.read.parquet(path)
        .groupBy("c_custkey", "c_name")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("dt_updated").alias("n_stamped"))
    )


# ---------------------------------------------------------------- lake sinks


@register
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "entity")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    lake_sink.write_entity(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@register
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write everything, then replace the partitions of one tournament and year only."""
    path = scratch_path(spark, "partitioned")
    rows = analog.lake_rows(spark, sf_dir)
    lake_sink.write_partitioned(rows, path)
    again = lake.select_partitions(rows, lake.SearchOption.TOURNAMENT_YEAR, 1, 2000)
    lake_sink.write_partitioned(again.withColumn("o_totalprice", -F.col("o_totalprice")), path)
    return lake.scan_lake(spark, path, lake.lake_schema(_LAKE_DATA)).select(*_LAKE_COLUMNS)


@register
def sink_partitioned_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the statistics of one match per nation."""
    path = scratch_path(spark, "by-match")
    block = F.expr("s_nationkey div 5")
    rows = table(spark, sf_dir, "supplier").select(
        "s_name",
        "s_acctbal",
        block.cast("bigint").alias("tournament_id"),
        (block + 2000).cast("int").alias("year"),
        F.concat(F.lit("Round "), F.col("s_nationkey").cast("string")).alias("stage_name"),
        F.lit("20200612").alias("date"),
        F.col("s_nationkey").cast("bigint").alias("match_id"),
    )
    lake_sink.write_partitioned_by_match(rows, path)
    schema = lake.lake_schema(rows.schema, lake.MATCH_PARTITION_COLUMNS)
    return lake.scan_glob(spark, path, "*/*/*/*/*/*.parquet", schema)


@register
def sink_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the ratings of one club per nation, two days written one after the other."""
    path = scratch_path(spark, "ratings")
    rated = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("country"), F.col("n_name").alias("club"),
            F.col("s_name").alias("name"), F.col("s_acctbal").alias("elo"),
        )
    )
    for day in ("20230101", "20230102"):
        dated = rated.withColumns({"year": F.lit(2023), "date": F.lit(day), "entity": F.lit("rating")})
        lake_sink.write_ratings(dated, path)
    return spark.read.schema(dated.schema).parquet(path)


# ---------------------------------------------------------------- warehouse


@register
def stadium_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = materialize(spark, "stadiums", {"timeline_all_uefa": analog.stadium_documents(spark, sf_dir)})
    return view.drop("stadium")


@register
def model_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result model as a view over staging rows that hold every event twice."""
    events = table(spark, sf_dir, "events")
    return _moment(materialize(spark, "match_results", {"game_results": events.union(events)}))


@register
def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model kept as a table, built twice: the second run replaces the first."""
    name = "link_" + scratch_path(spark, "model").rsplit("-", 1)[1]
    models = {name: MODELS["link_stadium_to_uefa"]}
    sources = {"uefa_stadiums": analog.stadiums(spark, sf_dir), "places": analog.places(spark, sf_dir)}
    for _ in range(2):
        rows = materialize(spark, name, sources, models=models)
    return rows


@register
def seed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "Upcoming").when(F.col("o_orderstatus") == "F", "FINISHED")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.coalesce(status, F.lit("abandoned")).alias("status"),
        F.concat(F.lit("Group "), F.substring("o_orderpriority", 1, 1)).alias("stage"),
    )
    return _as_text(star.with_stage_id(star.with_status_id(rows, match_status_seed(spark)), stage_seed(spark)), "status_id")


@register
def star_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.schedule(analog.star_tables(spark, sf_dir)).select(
        "match_id", "competition", "season", "date", "local_date", "home_team", "away_team", "city", "stadium", "stage"
    )


@register
def star_schedule_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.schedule(analog.star_tables(spark, sf_dir), season=1998).select(
        "match_id", "competition", "season", "date", "local_date", "home_team", "away_team", "city", "stadium", "stage"
    )


@register
def star_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.results(analog.star_tables(spark, sf_dir), goal_order=analog.GOAL_ORDER, page=3)
    return _as_text(rows, "penalty_shootout_home_goals", "penalty_shootout_away_goals")


@register
def goal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.goal_rows(analog.timeline(spark, sf_dir), analog.match_links(spark, sf_dir))


@register
def local_time_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = dates.kickoff_text(F.col("ts"))
    stored = F.when(F.col("event_type").isin("click", "view", "error"), F.concat(moment, F.lit("+00:00")))
    events = table(spark, sf_dir, "events")
    matches = events.select(F.col("event_id").alias("id"), F.coalesce(stored, moment).alias("date"))
    link = events.select(F.col("event_id").alias("match_id"), F.col("user_id").alias("match_id_uefa"))
    kickoff = F.when(F.col("o_orderstatus") != "P", dates.kickoff_text(F.col("o_orderdate")))
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), kickoff.alias("dateTime"), F.lit(3).alias("utcOffsetInHours")
    )
    return star.corrected_local_dates(matches, link, source)


@register
def local_time_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = F.when(F.col("event_type") != "view", (F.col("user_id") - 75).cast("int"))
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), dates.kickoff_text(F.col("ts")).alias("dateTime"),
        offset.alias("utcOffsetInHours"),
    )
    return _as_text(star.with_local_date(rows), "utcOffsetInHours")


@register
def stadium_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.link_stadiums(analog.stadiums(spark, sf_dir), analog.places(spark, sf_dir))


@register
def stadium_link_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The link as a table created from the query, plus one more inserted load of it."""
    links = star.link_stadiums(analog.stadiums(spark, sf_dir), analog.places(spark, sf_dir))
    path = scratch_path(spark, "link")
    name = "link_" + path.rsplit("-", 1)[1]
    table_sink.create_table(links, name, path=path)
    table_sink.insert_rows(links.select("stadium_id_uefa", "place_id"), name)
    return spark.table(name).groupBy("place_id", "stadium_id_uefa").agg(F.count(F.lit(1)).alias("n_loads"))


@register
def duplicate_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.duplicate_places(analog.places(spark, sf_dir))


@register
def place_from_stadium(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("Arena "), "s_name").alias("name"),
        F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("cityName"),
        (F.col("s_nationkey") * 1000).alias("capacity"),
        F.col("s_acctbal").alias("latitude"),
        F.col("s_nationkey").cast("double").alias("longitude"),
    )
    return star.place_rows(rows, F.col("s_suppkey"), F.lit(1476))


@register
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two competitions a year, so every match is loaded twice."""
    tables = analog.star_tables(spark, sf_dir)
    years = analog.orders(spark, sf_dir).select(
        (F.col("season") * 10 + (F.col("o_orderstatus") == "P").cast("int")).cast("bigint").alias("id"),
        F.col("season").alias("year"),
    ).distinct()
    tables = star.Star(
        matches=tables.matches, competitions=years, stages=tables.stages, teams=tables.teams, places=tables.places,
        match_status=tables.match_status,
    )
    links = star.link_stadiums(analog.stadiums(spark, sf_dir), tables.places)
    rows = flows.fact_load(analog.source_matches(spark, sf_dir), tables, links)
    types = F.concat_ws(",", *[F.typeof(column) for column in rows.columns])
    nullable = ("place_id", "status_id", "penalty_shootout_home_goals", "penalty_shootout_away_goals")
    return _as_text(rows.withColumn("types", types), *nullable)


@register
def fact_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.crowded_seasons(analog.competitions(spark, sf_dir))


# ---------------------------------------------------------------- staging


@register
def stage_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.stage_and_day(analog.landed_matches(spark, sf_dir)).select("id", "stage_name", "date")


@register
def incremental_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moment(staging.recent_rows(table(spark, sf_dir, "events"), "ts", 30, "2024-02-10"))


def _undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events; errors have no time stamp."""
    return table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))


@register
def retention_n_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moment(staging.retained_rows(_undated(spark, sf_dir), 10, "ts", "2024-01-31"))


@register
def staging_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table by event type and load day after the days older than ten were dropped, twice."""
    path = scratch_path(spark, "staging")
    flows.append_staging(_undated(spark, sf_dir), path, "ts", ["event_type"])
    for _ in range(2):
        flows.clear_staging(spark, path, 10, "2024-01-31")
    return _moment(spark.read.parquet(path).drop(flows.LOAD_DAY))


@register
def results_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last thirty days of doubled staging rows, once each in the production table after runs on two days."""
    path = scratch_path(spark, "results")
    events = table(spark, sf_dir, "events")
    for day in ("2024-02-10", "2024-02-11"):
        flows.update_game_results(events.union(events), path, "ts", as_of=day)
    return _moment(flows.game_results(spark, path, events.schema).drop(flows.GAME_DAY))


@register
def results_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production results after two runs; a day that lies in the window of both has no staged rows in the second."""
    path = scratch_path(spark, "results")
    events = table(spark, sf_dir, "events")
    flows.update_game_results(events, path, "ts", as_of="2024-02-10")
    left = events.where(F.col("ts").cast("date") != F.lit("2024-01-20").cast("date"))
    flows.update_game_results(left, path, "ts", as_of="2024-02-11")
    return _moment(flows.game_results(spark, path, events.schema).drop(flows.GAME_DAY))


@register
def model_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental model of game results after two runs, the second one without a day of the first."""
    name = "results_" + scratch_path(spark, "model").rsplit("-", 1)[1]
    models = {name: MODELS["game_results"]}
    events = table(spark, sf_dir, "events").withColumn("game_date", F.col("ts").cast("date"))
    left = events.where("game_date <> DATE'2024-01-25'")
    materialize(spark, name, {"match_results": events}, models=models, as_of="2024-02-05")
    rows = materialize(spark, name, {"match_results": left}, models=models, as_of="2024-02-10")
    return _moment(rows.drop("game_date"))


@register
def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a raw load that can be typed; the load stamp is left out."""
    good, _ = flows.staging_rows(analog.raw_orders(spark, sf_dir, broken=True), {"row_id": "int", **analog.RAW_TYPES})
    return _as_text(good.drop("dt_updated"), "day", "known")


@register
def staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the same load that can't, with the names of the failing columns."""
    _, bad = flows.staging_rows(analog.raw_orders(spark, sf_dir, broken=True), {"row_id": "int", **analog.RAW_TYPES})
    return bad.select("row_id", _text("rejected").alias("rejected"))


@register
def json_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(shaping.scorers(analog.player_events(spark, sf_dir)), "minute", "second")


@register
def dedup_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _moment(staging.drop_copies(events.union(events)))


@register
def match_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.match_days(shaping.stage_and_day(analog.landed_matches(spark, sf_dir)))


@register
def stage_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.stage_names(shaping.stage_and_day(analog.landed_matches(spark, sf_dir)))


@register
def bucket_stage_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = shaping.stage_day_buckets(shaping.stage_and_day(analog.landed_matches(spark, sf_dir)), page=2)
    return buckets.withColumn("match_ids", _text("match_ids"))


@register
def seasons_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = analog.competitions(spark, sf_dir).select(
        "id", F.expr("id div 10000").alias("tournament_id"), F.col("year").cast("string").alias("name")
    )
    return staging.rank_seasons(seasons)


@register
def seasons_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = analog.competitions(spark, sf_dir).select(
        "id", F.expr("id div 10000").alias("tournament_id"), F.col("year").cast("string").alias("name")
    )
    return staging.order_seasons(seasons, 199)


@register
def latest_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = analog.competitions(spark, sf_dir).select(
        "id", F.expr("id div 10000").alias("tournament_id"), F.col("year").cast("string").alias("name")
    )
    return staging.latest_season(seasons)


@register
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return staging.union_differing([customers, suppliers])


@register
def clean_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {"row_id": "int", **analog.RAW_TYPES}
    return _as_text(clean(analog.raw_orders(spark, sf_dir), config), "day", "known")


@register
def clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(analog.raw_orders(spark, sf_dir, broken=True), analog.RAW_TYPES)


@register
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds, iso = analog.unix_seconds(F.col("ts")), dates.kickoff_text(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        seconds.alias("unix_seconds"),
        dates.unix_day(seconds).alias("unix_day"),
        dates.unix_year(seconds).alias("unix_year"),
        dates.compact_day(dates.kickoff_day(iso)).alias("compact_day"),
        dates.kickoff_day(iso).alias("day"),
        dates.kickoff_clock(iso).alias("clock"),
    )


# ---------------------------------------------------------------- quality reports


@register
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key checks of the driver's tables; orders have to be of customers not in debt, so there are orphans."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    tables = {name: table(spark, sf_dir, name) for name in names}
    tables["solvent"] = tables["customer"].where(F.col("c_acctbal") > 0)
    keys = (
        ("nation", "n_regionkey", "region", "r_regionkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("supplier", "s_nationkey", "nation", "n_nationkey"),
        ("orders", "o_custkey", "solvent", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    )
    return quality.foreign_key_violations(tables, keys)


@register
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_violations(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


@register
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to lines and line-less orders: line columns are NULL there."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("suppkey"), F.min("l_partkey").alias("partkey")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    events = table(spark, sf_dir, "events")
    return quality.null_violations(
        {"goals": joined, "events": events},
        {"goals": ("o_orderkey", "o_custkey", "suppkey", "partkey"), "events": ("event_id", "ts", "props")},
    )


# ---------------------------------------------------------------- aggregation


@register
def ordered_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.goals_per_match(analog.goals(spark, sf_dir), analog.GOAL_ORDER, page=2)


@register
def goals_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    goals = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("match_id")).agg(
        F.sum(F.floor("l_quantity")).alias("n_goals")
    )
    return star.goals_by_season(analog.matches(spark, sf_dir), analog.competitions(spark, sf_dir), goals)


# ---------------------------------------------------------------- slice graph


# Short lists and blocks, so that the documents of the smallest tables have several of each.
_LIST, _BLOCK = 5, 20


def _games(spark: SparkSession, sf_dir: str, images: str = "flag") -> DataFrame:
    return slices.slice_games(star.schedule(analog.star_tables(spark, sf_dir)), images)


def _scored_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.games_with_goals(_games(spark, sf_dir), analog.goals(spark, sf_dir))


def _listed(graph: DataFrame) -> DataFrame:
    return graph.withColumns({"matches": _text("matches"), "dependencies": _text("dependencies")})


@register
def slice_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(slices.slices(slices.number_games(_scored_games(spark, sf_dir))))


@register
def slice_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.edges(slices.number_games(_scored_games(spark, sf_dir)))


@register
def slice_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = slices.slices(slices.number_games(_games(spark, sf_dir, "team")))
    return _listed(graph).orderBy("season", "competition", "index", "part")


@register
def slice_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(slices.linked_to(_scored_games(spark, sf_dir), "team", "NATION_1"), "match_id")


_stored_graphs: dict[tuple[str, str], tuple[str, str]] = {}


def _stored_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of this session's games, stored by the first query that looks something up in it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored_graphs or not exists(spark, _stored_graphs[key][1]):
        path = scratch_path(spark, "graph")
        _stored_graphs[key] = "graph_" + path.rsplit("-", 1)[1], path
        graph = slices.slices(slices.number_games(_scored_games(spark, sf_dir)), _LIST)
        slices.store_graph(graph, *_stored_graphs[key])
    return spark.table(_stored_graphs[key][0])


@register
def slice_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches and linked slices of the slice with index 3 of every document, out of one bucket of the stored graph."""
    return _listed(slices.of_index(_stored_graph(spark, sf_dir), 3))


@register
def slice_of_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slice of one document out of the stored graph."""
    return _listed(slices.of_slice(_stored_graph(spark, sf_dir), 1995, "3-MEDIUM", 7))


_SLICE_JSON = (
    "slices ARRAY<STRUCT<type: STRING, value: STRUCT<name: STRING, city: STRING, stadium: STRING, date: STRING>, "
    "index: BIGINT, dependencies: ARRAY<BIGINT>, matches: ARRAY<BIGINT>, imagePath: STRING, part: BIGINT>>"
)


def _landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document text after a round trip through JSON line files."""
    documents = flows.season_documents(
        analog.star_tables(spark, sf_dir), goal_order=analog.GOAL_ORDER, page=_LIST, block=_BLOCK
    )
    path = scratch_path(spark, "documents")
    table_sink.write_documents(documents, path)
    return spark.read.text(path)


@register
def slice_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices read back out of the JSON documents."""
    schema = f"season INT, competition STRING, {_SLICE_JSON}"
    parsed = _landed_documents(spark, sf_dir).select(F.from_json("value", schema).alias("d"))
    entry = parsed.select("d.season", "d.competition", F.inline("d.slices"))
    key = F.coalesce("value.name", "value.stadium", "value.date")
    return entry.select(
        "season", "competition", "index", "type", key.alias("key"), F.col("value.city").alias("city"),
        F.col("imagePath").alias("image_path"), "part", _text("matches").alias("matches"),
        _text("dependencies").alias("dependencies"),
    )


@register
def slice_document_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches read back out of the JSON documents."""
    numbers = ("match_id", "year", "total_home_goals", "total_away_goals", "text_part")
    numbers += ("penalty_shootout_home_goals", "penalty_shootout_away_goals")
    fields = (*slices.MATCH_FIELDS, "text_part")
    match = ", ".join(f"{name}: {'BIGINT' if name in numbers else 'STRING'}" for name in fields)
    schema = f"season INT, competition STRING, matches ARRAY<STRUCT<{match}>>"
    parsed = _landed_documents(spark, sf_dir).select(F.from_json("value", schema).alias("d"))
    rows = parsed.select("d.season", "d.competition", F.inline("d.matches"))
    return _as_text(rows, "penalty_shootout_home_goals", "penalty_shootout_away_goals")


@register
def slice_document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many entries the blocks of the documents have."""
    documents = flows.season_documents(
        analog.star_tables(spark, sf_dir), goal_order=analog.GOAL_ORDER, page=_LIST, block=_BLOCK
    )
    # Both lists come out of one reading of the text; their entries stay text.
    read = documents.withColumn("d", F.from_json("document", "slices ARRAY<STRING>, matches ARRAY<STRING>"))
    entries = [F.size(F.col("d").getField(name)).alias(f"n_{name}") for name in ("slices", "matches")]
    return read.select("season", "competition", "kind", "block", "part", *entries)


@register
def slice_document_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published documents of all seasons, one of them published again: how many entries the blocks read back have."""
    sets = DocumentSets(spark, scratch_path(spark, "sets"))
    tables = analog.star_tables(spark, sf_dir)
    for season in (None, 1998):
        documents = flows.season_documents(tables, season, goal_order=analog.GOAL_ORDER, page=_LIST, block=_BLOCK)
        sets.publish(documents, "season")
    schema = "season INT, competition STRING, slices ARRAY<STRUCT<type: STRING>>, matches ARRAY<STRUCT<match_id: BIGINT>>"
    read = sets.read().select(F.from_json("value", schema).alias("d")).select("d.*")
    return read.groupBy("season", "competition").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(F.size("slices")).alias("n_slices"),
        F.sum(F.size("matches")).alias("n_matches"),
    )


# ---------------------------------------------------------------- streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return analog.as_games(live.file_source(spark, f"{sf_dir}/events*.parquet", schema))


def _run(stream: DataFrame, target: str, checkpoint: str, output_mode: str = "append") -> None:
    live.write_batches(stream, target, checkpoint, output_mode=output_mode).awaitTermination()


@register
def stream_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games to topic messages and back to columns."""
    target, checkpoint = scratch_path(spark, "messages"), scratch_path(spark, "checkpoint")
    messages = live.to_messages(_event_stream(spark, sf_dir))
    _run(messages, target, checkpoint)
    return live.read_messages(live.read_batches(spark, target, messages.schema), GAME_MESSAGE)


@register
def stream_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message bytes to {value} documents; the game id is read back for the comparison."""
    target, checkpoint = scratch_path(spark, "envelopes"), scratch_path(spark, "checkpoint")
    as_bytes = live.to_messages(_event_stream(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    documents = live.envelopes(as_bytes)
    _run(documents, target, checkpoint)
    return live.read_batches(spark, target, documents.schema).select("value")


def _event_batches(spark: SparkSession, sf_dir: str, batches: int) -> DataFrame:
    """The events as a stream of so many batches, in the order of their time: one landed file each."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "event-files")
    events.repartitionByRange(batches, "ts", "event_id").write.parquet(path)
    return analog.as_games(live.file_source(spark, path, events.schema, files_per_batch=1))


@register
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after six batches, most of whose games are known from batches before."""
    target, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "checkpoint")
    stream = _event_batches(spark, sf_dir, 6)
    live.keep_latest(stream, target, checkpoint, ["ts", "event_id"]).awaitTermination()
    return live.read_state(spark, target, stream.schema).select("id", "team1", "team2", "score", "event_id")


@register
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of ten batches out of the few pieces they were merged into; the last batch is repeated."""
    target, checkpoint = scratch_path(spark, "compacted"), scratch_path(spark, "checkpoint")
    stream = _event_batches(spark, sf_dir, 10)
    _run(stream, target, checkpoint)
    live.forget_commit(spark, checkpoint, 9)
    _run(stream, target, checkpoint)
    return live.read_batches(spark, target, stream.schema).select("id", "team1", "team2", "score", "event_id")


@register
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that ended after writing a batch but before committing it: the batch is repeated, not added."""
    target, checkpoint = scratch_path(spark, "restart"), scratch_path(spark, "checkpoint")
    projected = live.project_games(_event_stream(spark, sf_dir))
    _run(projected, target, checkpoint)
    live.forget_commit(spark, checkpoint, 0)
    _run(projected, target, checkpoint)
    return live.read_batches(spark, target, projected.schema).drop("batch_id")
