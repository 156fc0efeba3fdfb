"""The platform's tables, derived from the driver's TPC-H-like tables.

An order is a match: the customer's nation plays at home against the nation of its first supplier, the
first part is the place, the home region the stage, priority and order year the competition. Lines are
goals. Orders without lines are games without goals; they meet supplier 0 at part 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.functions import dates
from touchline.functions.cleaning import NO_BREAK_SPACE
from touchline.operators.star import Star
from touchline.schemas import match_status_seed

GOAL_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "text")


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables. Its schema is read from the file once, then declared."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def unix_seconds(moment: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, moment)


def tournament(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("bigint")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns(
        {"tournament_id": tournament(F.col("o_orderpriority")), "season": F.year("o_orderdate")}
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("suppkey"),
            F.min("l_partkey").alias("partkey"),
            F.count_if(flag == "R").alias("home"),
            F.count_if(flag == "A").alias("away"),
            F.count_if((flag == "R") & (status == "O")).alias("regular_home"),
            F.count_if((flag == "A") & (status == "O")).alias("regular_away"),
            F.count_if((flag == "N") & (status == "F")).alias("shootout_home"),
            F.count_if((flag == "N") & (status == "O")).alias("shootout_away"),
        )
    )
    o = orders(spark, sf_dir)
    home = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_nationkey", "n_regionkey")
    )
    away = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("int")

    tie = F.col("home") == F.col("away")
    return (
        o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
        .join(home, F.col("o_custkey") == F.col("c_custkey"))
        .join(away, F.coalesce("suppkey", F.lit(0)) == F.col("s_suppkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            (F.col("tournament_id") * 10000 + F.col("season")).alias("competition_id"),
            F.coalesce("partkey", F.lit(0)).alias("place_id"),
            F.col("n_regionkey").alias("stage_id"),
            F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3).alias("status_id"),
            dates.kickoff_text(F.col("o_orderdate")).alias("date"),
            dates.kickoff_text(dates.shift_hours(F.col("o_orderdate"), 2)).alias("local_date"),
            F.col("c_nationkey").cast("bigint").alias("home_team_id"),
            F.col("s_nationkey").cast("bigint").alias("away_team_id"),
            count("regular_home").alias("goals_home_team"),
            count("regular_away").alias("goals_away_team"),
            count("home").alias("total_home_goals"),
            count("away").alias("total_away_goals"),
            F.when(tie, count("shootout_home")).alias("penalty_shootout_home_goals"),
            F.when(tie, count("shootout_away")).alias("penalty_shootout_away_goals"),
            F.col("o_orderkey").cast("int").alias("game_order"),
        )
    )


def competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = orders(spark, sf_dir).select("tournament_id", "o_orderpriority", "season").distinct()
    return seasons.select(
        (F.col("tournament_id") * 10000 + F.col("season")).alias("id"),
        F.col("o_orderpriority").alias("caption"),
        F.col("season").alias("year"),
        F.col("o_orderpriority").alias("league"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.concat(F.lit("T"), key).alias("short_name"),
        F.concat(F.lit("N"), key).alias("short_name2"),
        F.col("n_name").alias("name"),
    )


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("stadium"),
        F.col("p_type").alias("city"),
        F.col("p_size").alias("capacity"),
        F.col("p_retailprice").alias("lat"),
        F.col("p_size").cast("double").alias("lng"),
    )


def goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.col("l_linenumber").cast("string"), F.lit("` "), "l_returnflag", "l_linestatus")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        line.alias("text"),
    )


def star_tables(spark: SparkSession, sf_dir: str) -> Star:
    return Star(
        matches=matches(spark, sf_dir),
        competitions=competitions(spark, sf_dir),
        stages=stages(spark, sf_dir),
        teams=teams(spark, sf_dir),
        places=places(spark, sf_dir),
        match_status=match_status_seed(spark),
        goals=goals(spark, sf_dir),
    )


def landed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed match records: most have a group, all a round, whose name may be empty."""
    group = F.when(
        F.col("o_orderpriority") != "4-NOT SPECIFIED",
        F.struct(F.struct(F.col("o_orderpriority").alias("groupName")).alias("metaData")),
    )
    round_name = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        group.alias("group"),
        F.struct(F.struct(round_name.alias("name")).alias("metaData")).alias("round"),
        F.struct(F.col("o_orderdate").cast("date").cast("string").alias("date")).alias("kickOffTime"),
    )


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the lake's partition columns; the day is the first of the order's quarter."""
    quarter = F.date_trunc("QUARTER", "o_orderdate").cast("date").cast("string")
    return orders(spark, sf_dir).select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "tournament_id",
        F.col("season").alias("year"),
        F.concat(F.lit("Group/"), "o_orderstatus", F.lit(" +1")).alias("stage_name"),
        dates.compact_day(quarter).alias("date"),
    )


def source_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches in the shape of the source staging table of the fact load."""
    m, s = matches(spark, sf_dir).alias("m"), stages(spark, sf_dir).alias("s")
    status = F.when(F.col("m.status_id") == 1, "Upcoming").when(F.col("m.status_id") == 2, "FINISHED")
    return m.join(s, F.col("m.stage_id") == F.col("s.id")).select(
        F.col("m.id").alias("id"),
        F.col("m.date").alias("dateTime"),
        (F.col("m.home_team_id") - 12).cast("int").alias("utcOffsetInHours"),
        F.when(F.col("m.status_id") != 3, F.col("s.title")).alias("groupName"),
        F.col("s.title").alias("roundName"),
        F.substring("m.date", 1, 4).cast("int").alias("seasonYear"),
        F.concat(F.lit("T"), F.col("m.home_team_id").cast("string")).alias("homeTeamcountryCode"),
        F.concat(F.lit("T"), F.col("m.away_team_id").cast("string")).alias("awayTeamcountryCode"),
        F.col("m.place_id").alias("stadiumId"),
        F.coalesce(status, F.lit("abandoned")).alias("status"),
        F.col("m.goals_home_team").alias("scoreRegularHome"),
        F.col("m.goals_away_team").alias("scoreRegularAway"),
        F.col("m.total_home_goals").alias("scoreTotalHome"),
        F.col("m.total_away_goals").alias("scoreTotalAway"),
        F.col("m.penalty_shootout_home_goals").alias("scorePenaltyHome"),
        F.col("m.penalty_shootout_away_goals").alias("scorePenaltyAway"),
        F.col("m.game_order").alias("matchNumber"),
    )


def stadiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the source's stadiums; small ones lack coordinates, so that some matches lack a place."""
    latitude = F.when(F.col("capacity") >= 10, F.col("lat")).alias("latitude")
    return places(spark, sf_dir).select("id", latitude, F.col("lng").alias("longitude"))


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as match events with a described first entry."""
    sentence = F.concat(
        F.lit("Supp O'"), F.col("l_suppkey").cast("string"), F.lit(" (N"), F.col("l_partkey").cast("string"),
        F.when(F.col("l_linestatus") == "F", ") scores!!").otherwise(") successfully converts the penalty!"),
    )
    kind = (
        F.when(F.col("l_returnflag") == "R", "Goal!")
        .when(F.col("l_linestatus") == "F", "Attempt at Goal")
        .when(F.col("l_returnflag") == "A", "Penalty GOAL")
    )
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("EventId"),
        F.col("l_orderkey").alias("IdMatch"),
        F.col("l_suppkey").alias("IdPlayer"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("'")).alias("MatchMinute"),
        F.to_json(F.array(F.struct(F.lit("en").alias("Locale"), sentence.alias("Description")))).alias("EventDescription"),
        kind.alias("TypeLocalized"),
    )


def match_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source ids of the matches that are not of status P."""
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select(
        (F.col("o_orderkey") + 1000000).alias("match_id"), F.col("o_orderkey").alias("match_id_fifa")
    )


def player_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as player-events documents: two scorers, the second one bare on open lines, or none."""
    def scorer(name: Column, code: Column, minute: Column, second: Column) -> Column:
        known = F.struct(
            F.struct(F.struct(name.alias("EN")).alias("name")).alias("translations"), code.alias("countryCode")
        )
        return F.struct(known.alias("player"), F.struct(minute.alias("minute"), second.alias("second")).alias("time"))

    def when_closed(value: Column) -> Column:
        return F.when(F.col("l_linestatus") == "F", value)

    part = F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))
    supplier = F.concat(F.lit("Supp "), F.col("l_suppkey").cast("string"))
    two = F.array(
        scorer(part, F.col("l_returnflag"), F.col("l_linenumber"), F.lit(7)),
        scorer(
            when_closed(supplier), F.col("l_returnflag"),
            when_closed(F.col("l_linenumber") + 45), when_closed(F.lit(30)),
        ),
    )
    document = F.when(F.col("l_returnflag") != "N", F.to_json(F.struct(two.alias("scorers")))).when(
        F.col("l_linestatus") == "F", "{}"
    )
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), document.alias("playerEvents"))


def stadium_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as stadium documents by season; every (part, supplier, season) repeats freely."""
    def english(value: Column) -> Column:
        return F.struct(F.struct(value.alias("EN")).alias("name"))

    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    document = F.struct(
        part.alias("id"),
        F.struct(
            supplier.alias("id"), english(F.concat(F.lit("City "), supplier)).alias("translations")
        ).alias("city"),
        english(F.concat(F.lit("Arena "), part)).alias("translations"),
        F.struct(
            (F.col("l_partkey") * 0.25).cast("double").alias("latitude"),
            (F.col("l_suppkey") * 0.5 - 90).cast("double").alias("longitude"),
        ).alias("geolocation"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.to_json(document).alias("stadium"), F.year("l_shipdate").alias("seasonYear")
    )


RAW_TYPES = {"id": "int", "price": "float", "day": "date", "known": "bool", "clerk": "string"}


def raw_orders(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Orders as untyped feed text, with blanks, commas and no-break spaces; ``broken`` adds bad cells."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    spaced = F.concat(F.substring(price, 1, 1), F.lit(NO_BREAK_SPACE), F.substring(price, F.lit(2), F.length(price)))
    key = F.when(status == "P", "").otherwise(F.col("o_orderkey").cast("string"))
    amount = F.when(status == "F", F.replace(spaced, F.lit("."), F.lit(","))).when(status == "O", price)
    day = F.when(status != "P", F.col("o_orderdate").cast("date").cast("string"))
    if broken:
        key = F.when(priority == "1-URGENT", F.concat(F.col("o_orderkey").cast("string"), F.lit(".5"))).otherwise(key)
        amount = F.when(priority == "2-HIGH", "x").otherwise(amount)
        day = F.when(status == "O", F.replace(day, F.lit("-"), F.lit(""))).otherwise(day)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        key.alias("id"),
        amount.alias("price"),
        day.alias("day"),
        F.when(status == "O", "").when(status == "F", "x").alias("known"),
        priority.alias("clerk"),
        F.when(status != "P", priority).alias("extra"),
        F.struct(F.col("o_custkey").alias("cust"), status.alias("state")).alias("detail"),
    )


def as_games(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("team1"),
        F.concat(F.lit("v-"), "event_type").alias("team2"),
        F.get_json_object("props", "$.k").alias("score"),
        "ts",
        "event_id",
    )
