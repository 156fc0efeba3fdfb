"""ANSI SQL twins of the registered queries over the driver's tables, for DuckDB."""

from __future__ import annotations

_LAKE = """SELECT o_orderkey, o_custkey, o_totalprice,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS tournament_id, CAST(year(o_orderdate) AS INT) AS year,
  'Group/' || o_orderstatus || ' +1' AS stage_name, strftime(date_trunc('quarter', o_orderdate), '%Y%m%d') AS date
  FROM orders"""

_LINES = """lines AS (SELECT l_orderkey, min(l_suppkey) AS suppkey, min(l_partkey) AS partkey,
    count(*) FILTER (l_returnflag = 'R') AS home, count(*) FILTER (l_returnflag = 'A') AS away,
    count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS regular_home,
    count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'O') AS regular_away,
    count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS shootout_home,
    count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS shootout_away
  FROM lineitem GROUP BY l_orderkey)"""

# Every match with names, before the status filter.
_GAME = f"""{_LINES}, game AS (SELECT o.o_orderkey AS match_id, CAST(year(o.o_orderdate) AS INT) AS season,
    o.o_orderpriority AS competition, o.o_orderstatus AS status, strftime(o.o_orderdate, '%Y-%m-%d') AS game_date,
    strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS date,
    strftime(o.o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS local_date,
    nh.n_nationkey AS home_id, na.n_nationkey AS away_id,
    nh.n_name AS home_team, na.n_name AS away_team, p.p_partkey AS place_id, p.p_type AS city, p.p_brand AS stadium,
    r.r_regionkey AS stage_id, r.r_name AS stage, l.l_orderkey IS NOT NULL AS scored,
    CAST(coalesce(regular_home, 0) AS INT) AS regular_home, CAST(coalesce(regular_away, 0) AS INT) AS regular_away,
    CAST(coalesce(home, 0) AS INT) AS home, CAST(coalesce(away, 0) AS INT) AS away,
    CAST(CASE WHEN home = away THEN shootout_home END AS INT) AS shootout_home,
    CAST(CASE WHEN home = away THEN shootout_away END AS INT) AS shootout_away,
    'n' || nh.n_nationkey || '.svg' AS image_path_home, 'n' || na.n_nationkey || '.svg' AS image_path_away
  FROM orders o LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation nh ON nh.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = coalesce(l.suppkey, 0) JOIN nation na ON na.n_nationkey = s.s_nationkey
  JOIN region r ON r.r_regionkey = nh.n_regionkey JOIN part p ON p.p_partkey = coalesce(l.partkey, 0))"""

_GOAL_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, text"



def _goals(page: int) -> str:
    return f"""goal AS (SELECT l_orderkey AS match_id, l_linenumber || '` ' || l_returnflag || l_linestatus AS text,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem),
  goal_part AS (SELECT *, (row_number() OVER (PARTITION BY match_id ORDER BY {_GOAL_ORDER}) - 1) // {page} AS text_part
    FROM goal),
  goal_text AS (SELECT match_id, CAST(text_part AS BIGINT) AS text_part,
    string_agg(text, ',' ORDER BY {_GOAL_ORDER}) AS text FROM goal_part GROUP BY match_id, text_part)"""

_RESULT = """CASE WHEN shootout_home <> 0
  THEN home || '(' || shootout_home || '):' || away || '(' || shootout_away || ')'
  ELSE home || ':' || away END"""


def _graph(
    condition: str, home_image: str = "image_path_home", away_image: str = "image_path_away", page: int = 10_000
) -> str:
    return f"""WITH {_GAME}, g AS (SELECT *, {home_image} AS image_home, {away_image} AS image_away,
    row_number() OVER (PARTITION BY season, competition ORDER BY game_date, match_id) - 1 AS ord
    FROM game WHERE {condition}),
  occ AS (
    SELECT season, competition, match_id, ord, 0 AS slot, 'team' AS type, home_team AS key, NULL AS city,
      image_home AS image FROM g
    UNION ALL SELECT season, competition, match_id, ord, 1, 'team', away_team, NULL, image_away FROM g
    UNION ALL SELECT season, competition, match_id, ord, 2, 'place', stadium, city, NULL FROM g
    UNION ALL SELECT season, competition, match_id, ord, 3, 'stage', stage, NULL, NULL FROM g
    UNION ALL SELECT season, competition, match_id, ord, 4, 'date', game_date, NULL, NULL FROM g),
  first_seen AS (SELECT season, competition, type, key, min(ord * 8 + slot) AS seen, count(*) AS n_matches,
    arg_min(city, ord * 8 + slot) AS city, arg_min(image, ord * 8 + slot) AS image_path
    FROM occ GROUP BY season, competition, type, key),
  node AS (SELECT *, row_number() OVER (PARTITION BY season, competition ORDER BY seen) - 1 AS index FROM first_seen),
  edge AS (SELECT DISTINCT a.season, a.competition, a.type, a.key, nb.index AS dependency
    FROM occ a JOIN occ b ON a.season = b.season AND a.competition = b.competition AND a.match_id = b.match_id
      AND a.type <> b.type
    JOIN node nb ON nb.season = b.season AND nb.competition = b.competition AND nb.type = b.type AND nb.key = b.key),
  entry AS (
    SELECT season, competition, type, key, ord // {page} AS part, ord AS place, match_id, NULL AS dependency FROM occ
    UNION ALL SELECT season, competition, type, key, dependency // {page}, dependency, NULL, dependency FROM edge),
  listed AS (SELECT season, competition, type, key, CAST(part AS BIGINT) AS part,
    coalesce(string_agg(CAST(match_id AS VARCHAR), ',' ORDER BY place), '') AS matches,
    coalesce(string_agg(CAST(dependency AS VARCHAR), ',' ORDER BY place), '') AS dependencies
    FROM entry GROUP BY season, competition, type, key, part)"""


_FLAGS = _graph("status = 'F' AND scored")
_SHORT = _graph("status = 'F' AND scored", page=5)
_PICTURES = _graph(
    "status = 'F'", "'assets/images/' || home_team || '.png'", "'assets/images/' || away_team || '.png'"
)
_SLICES = """SELECT season, competition, CAST(index AS BIGINT) AS index, type, key, city, image_path, part,
  CAST(n_matches AS BIGINT) AS n_matches, matches, dependencies
  FROM listed JOIN node USING (season, competition, type, key)"""

_SCHEDULE = """SELECT match_id, competition, season, date, local_date, home_team, away_team, city, stadium, stage
  FROM game WHERE status = 'F'"""

_LANDED = """landed AS (SELECT o_orderkey AS id, CASE
    WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority
    WHEN o_orderstatus = 'P' THEN 'no_stage_name' ELSE o_orderstatus END AS stage_name,
    strftime(o_orderdate, '%Y%m%d') AS date FROM orders)"""

_SEASONS = """season AS (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 10000
    + CAST(year(o_orderdate) AS BIGINT) AS id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS tournament_id,
    CAST(year(o_orderdate) AS VARCHAR) AS name FROM orders)"""

_NAMED = """SELECT * FROM (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 10000
    + CAST(year(o_orderdate) AS BIGINT) AS id, o_orderpriority || ' ' || year(o_orderdate) AS name FROM orders)"""

_TYPED = """SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END AS id,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS DOUBLE) END AS price,
  CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE o_orderstatus WHEN 'O' THEN 'false' WHEN 'F' THEN 'true' END AS known, o_orderpriority AS clerk,
  CASE WHEN o_orderstatus = 'P' THEN '""' ELSE '"' || o_orderpriority || '"' END AS extra,
  '{"cust":' || o_custkey || ',"state":"' || o_orderstatus || '"}' AS detail FROM orders"""

_CALENDAR = """raw AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'no_stage_name' ELSE o_orderpriority END AS stage_name,
    o_orderkey AS id, CAST(epoch(o_orderdate) AS BIGINT) + 43200 AS time FROM orders
  UNION ALL SELECT CASE WHEN o_orderstatus = 'P' THEN 'no_stage_name' ELSE o_orderpriority END,
    -o_orderkey - 1, CAST(epoch(o_orderdate) AS BIGINT) + 86460 FROM orders),
  calendar AS (SELECT stage_name, id, time,
    strftime(TIMESTAMP '1970-01-01' + to_seconds(time), '%Y-%m-%d') AS date,
    CAST(year(TIMESTAMP '1970-01-01' + to_seconds(time)) AS INT) AS year FROM raw)"""

_EVENT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props"
_UNDATED = """(SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts, user_id, event_type, value, props
  FROM events)"""

_GAME_EVENTS = """SELECT user_id AS id, event_type AS team1, 'v-' || event_type AS team2,
  json_extract_string(props, '$.k') AS score"""

_NEW_STATUS = """CASE o_orderstatus WHEN 'O' THEN 'Upcoming' WHEN 'F' THEN 'FINISHED' ELSE 'abandoned' END"""
_STATUS_SEED = "(VALUES (1, 'upcoming'), (2, 'finished'), (3, 'canceled')) ms(id, status)"

_STAGE_SEED = """(VALUES (3, 'Group A'), (4, 'Group 1'), (5, 'Group B'), (6, 'Group 2'), (7, 'Group C'), (8, 'Group 3'),
  (9, 'Group D'), (10, 'Group 4'), (11, 'Group E'), (12, 'Group 5'), (21, 'Final')) st(id, title)"""


def _orphans(child: str, column: str, parent: str, parent_column: str, source: str | None = None) -> str:
    return f"""SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,
  CAST({column} AS BIGINT) AS key_value, count(*) AS n_rows FROM {child}
  WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {source or parent}) GROUP BY {column}"""


_DOCUMENT_BLOCKS = f"""{_SHORT}, {_goals(5)}, item AS (
    SELECT season, competition, type AS kind, index // 20 AS block, part, 1 AS s, 0 AS m
    FROM listed JOIN node USING (season, competition, type, key)
    UNION ALL SELECT season, competition, 'match', ord // 20, text_part, 0, 1 FROM g JOIN goal_text USING (match_id))
  SELECT season, competition, kind, CAST(block AS BIGINT) AS block, CAST(part AS BIGINT) AS part,
    CAST(sum(s) AS INT) AS n_slices, CAST(sum(m) AS INT) AS n_matches
  FROM item GROUP BY season, competition, kind, block, part"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "scan_glob": _LAKE,
        "scan_entity": "SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS tournament_id FROM nation",
        "scan_path_columns": _LAKE,
        "select_all": f"SELECT * FROM ({_LAKE}) WHERE tournament_id = 1 OR year = 2001",
        "select_tournament_year": f"SELECT * FROM ({_LAKE}) WHERE tournament_id = 1 AND year = 2000",
        "select_tournament_year_date": f"SELECT * FROM ({_LAKE}) "
        "WHERE tournament_id = 1 AND year = 2000 AND date = '20000401'",
        "scan_csv_ratings": """SELECT c_mktsegment AS country, c_name AS club, c_acctbal AS "Elo",
          CAST(2023 AS INT) AS year, '20230101' AS date, 'rating' AS entity FROM customer""",
        "scan_json_envelope": "SELECT c_custkey, c_name, c_nationkey FROM customer",
        "scan_json_array": "SELECT p_partkey, p_name, p_size, p_retailprice FROM part",
        "scan_json_keyed": "SELECT c_custkey, c_name, c_acctbal, c_nationkey AS tag FROM customer",
        "land_match_lines": f"""WITH {_LANDED} SELECT id, CAST(3 AS BIGINT) AS tournament_id, CAST(2020 AS INT) AS year,
          stage_name, date FROM landed""",
        "land_match_arrays": f"""WITH {_LANDED} SELECT id, CAST(3 AS BIGINT) AS tournament_id,
          CAST(2020 AS INT) AS year, stage_name, date FROM landed""",
        "land_calendars": """WITH stage AS (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS tournament_id,
            CASE WHEN o_orderstatus = 'P' THEN 'no_stage_name' ELSE o_orderpriority END AS stage_name,
            date_trunc('quarter', o_orderdate) AS day FROM orders)
          SELECT CASE late WHEN 0 THEN o_orderkey ELSE -o_orderkey - 1 END AS id, tournament_id,
            CAST(year(day) AS INT) AS year, stage_name, strftime(day + to_days(late), '%Y%m%d') AS date
          FROM stage CROSS JOIN (VALUES (0), (1)) l(late)""",
        "land_ratings": """SELECT c_custkey AS "Rank", CASE day WHEN '20230101' THEN -c_acctbal ELSE c_acctbal END AS "Elo",
          '2023' AS year, c_mktsegment AS country, 'Club ' || c_nationkey AS club, day AS date, 'rating' AS entity
          FROM customer CROSS JOIN (VALUES ('20230101'), ('20230102')) d(day)""",
        "tournaments_by_name": f"{_NAMED} WHERE name LIKE '%HIGH%' OR name LIKE '%LOW%'",
        "seasons_by_name": f"{_NAMED} WHERE name LIKE '%1998%'",
        "calendar_explode": f"WITH {_CALENDAR} SELECT * FROM calendar",
        "calendar_one_day": f"WITH {_CALENDAR} SELECT * FROM calendar WHERE date = '1998-07-01'",
        "filter_contains": """SELECT p_partkey, p_name, p_brand FROM part
          WHERE p_name LIKE '%widget%' AND p_brand LIKE '%1%'""",
        "relational_eq_scan": """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
          WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""",
        "relational_query_scan": """SELECT n.n_name, r.r_name, count(*) AS n_customers FROM customer c
          JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
          GROUP BY n.n_name, r.r_name""",
        "pending_seasons": """SELECT o_orderkey AS id FROM orders
          WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
        "pending_from_folders": f"""SELECT DISTINCT tournament_id * 10000 + year AS id, tournament_id, year
          FROM ({_LAKE}) WHERE (tournament_id + year) % 3 = 0""",
        "relational_append": """SELECT c_custkey, c_name, 2 * count(*) AS n_rows, 2 * count(*) AS n_stamped
          FROM customer GROUP BY c_custkey, c_name""",
        "sink_roundtrip": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
        "sink_partitioned": f"""SELECT o_orderkey, o_custkey, CASE WHEN tournament_id = 1 AND year = 2000
          THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, tournament_id, year, stage_name, date
          FROM ({_LAKE})""",
        "sink_partitioned_match": """SELECT s_name, s_acctbal, CAST(s_nationkey // 5 AS BIGINT) AS tournament_id,
          2000 + s_nationkey // 5 AS year, 'Round ' || s_nationkey AS stage_name, '20200612' AS date,
          CAST(s_nationkey AS BIGINT) AS match_id FROM supplier""",
        "sink_ratings": """SELECT r_name AS country, n_name AS club, s_name AS name, s_acctbal AS elo, 2023 AS year,
          day AS date, 'rating' AS entity FROM supplier JOIN nation ON n_nationkey = s_nationkey
          JOIN region ON r_regionkey = n_regionkey CROSS JOIN (VALUES ('20230101'), ('20230102')) d(day)""",
        "stadium_dim": """SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS city_id,
          'City ' || l_suppkey AS city_name, 'Arena ' || l_partkey AS name,
          CAST(l_partkey * 0.25 AS DOUBLE) AS lat, CAST(l_suppkey * 0.5 - 90 AS DOUBLE) AS lng,
          CAST(year(l_shipdate) AS INT) AS "seasonYear" FROM lineitem""",
        "model_view": "SELECT DISTINCT " + _EVENT + " FROM events",
        "model_table": """SELECT p.id AS place_id, s.p_partkey AS stadium_id_uefa FROM part s
          JOIN (SELECT p_retailprice, p_size, min(p_partkey) AS id FROM part GROUP BY p_retailprice, p_size) p
          ON p.p_retailprice = s.p_retailprice AND p.p_size = s.p_size WHERE s.p_size >= 10""",
        "seed_lookup": f"""SELECT o_orderkey, {_NEW_STATUS} AS status, CAST(ms.id AS VARCHAR) AS status_id,
          'Group ' || substr(o_orderpriority, 1, 1) AS stage, st.id AS stage_id FROM orders
          LEFT JOIN {_STATUS_SEED} ON ms.status = lower({_NEW_STATUS})
          LEFT JOIN {_STAGE_SEED} ON st.title = 'Group ' || substr(o_orderpriority, 1, 1)""",
        "star_schedule": f"WITH {_GAME} {_SCHEDULE}",
        "star_schedule_season": f"WITH {_GAME} {_SCHEDULE} AND season = 1998",
        "star_results": f"""WITH {_GAME}, {_goals(3)} SELECT g.match_id, competition, 'finished' AS status,
          season AS year, game_date AS date, substr(date, 12, 8) AS time, home_team, away_team, city, stadium, stage,
          home AS total_home_goals, away AS total_away_goals,
          CAST(shootout_home AS VARCHAR) AS penalty_shootout_home_goals,
          CAST(shootout_away AS VARCHAR) AS penalty_shootout_away_goals, text_part, text, image_path_home, image_path_away,
          {_RESULT} AS result FROM game g JOIN goal_text t ON t.match_id = g.match_id WHERE g.status = 'F'""",
        "goal_text": """SELECT l_orderkey * 10 + l_linenumber AS id, o_orderkey + 1000000 AS match_id,
          l_suppkey AS player_id, l_linenumber || '` Supp O` ' || l_suppkey || ' (N' || l_partkey
          || CASE WHEN l_linestatus = 'F' THEN ') ' ELSE ') pen' END AS text
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'
          WHERE l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'O')""",
        "local_time_fixed": """SELECT event_id AS id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "dateTime",
          CAST(3 AS INT) AS "utcOffsetInHours",
          strftime(o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS date_local
          FROM events JOIN orders ON o_orderkey = user_id AND o_orderstatus <> 'P'
          WHERE event_type IN ('click', 'view', 'error')""",
        "local_time_offset": """SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "dateTime",
          CAST(CASE WHEN event_type <> 'view' THEN user_id - 75 END AS VARCHAR) AS "utcOffsetInHours",
          strftime(ts + to_hours(CAST(CASE WHEN event_type <> 'view' THEN user_id - 75 END AS BIGINT)),
            '%Y-%m-%dT%H:%M:%SZ') AS local_date FROM events""",
        "stadium_link": """SELECT p.id AS place_id, s.p_partkey AS stadium_id_uefa FROM part s
          JOIN (SELECT p_retailprice, p_size, min(p_partkey) AS id FROM part GROUP BY p_retailprice, p_size) p
          ON p.p_retailprice = s.p_retailprice AND p.p_size = s.p_size WHERE s.p_size >= 10""",
        "stadium_link_table": """SELECT p.id AS place_id, s.p_partkey AS stadium_id_uefa, 2 * count(*) AS n_loads
          FROM part s JOIN (SELECT p_retailprice, p_size, min(p_partkey) AS id FROM part GROUP BY p_retailprice, p_size) p
          ON p.p_retailprice = s.p_retailprice AND p.p_size = s.p_size WHERE s.p_size >= 10 GROUP BY ALL""",
        "duplicate_places": """SELECT p_partkey AS id, p_brand AS stadium, p_type AS city, p_size AS capacity,
          p_retailprice AS lat, CAST(p_size AS DOUBLE) AS lng, n_places FROM part JOIN
          (SELECT p_retailprice, p_size, count(*) AS n_places FROM part GROUP BY ALL HAVING count(*) > 1) d
          USING (p_retailprice, p_size)""",
        "place_from_stadium": """SELECT s_suppkey AS id, 'Arena ' || s_name AS stadium, 'City ' || s_nationkey AS city,
          lower(replace('Arena ' || s_name, ' ', '')) AS short_name, s_nationkey * 1000 AS capacity,
          CAST(1476 AS BIGINT) AS competition_id, s_acctbal AS lat, CAST(s_nationkey AS DOUBLE) AS lng
          FROM supplier""",
        "fact_load": f"""WITH {_GAME}, canonical AS (SELECT p_retailprice, p_size, min(p_partkey) AS id FROM part
            GROUP BY p_retailprice, p_size),
          link AS (SELECT c.id AS place_id, s.p_partkey AS stadium_id FROM part s JOIN canonical c
            ON c.p_retailprice = s.p_retailprice AND c.p_size = s.p_size WHERE s.p_size >= 10),
          season AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year,
            CAST(year(o_orderdate) * 10 + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) AS id FROM orders)
          SELECT CAST(match_id AS INT) AS id, c.id AS competition_id, CAST(link.place_id AS VARCHAR) AS place_id, stage_id,
            CASE status WHEN 'O' THEN '1' WHEN 'F' THEN '2' END AS status_id, date,
            strftime(strptime(date, '%Y-%m-%dT%H:%M:%SZ') + to_hours(home_id - 12), '%Y-%m-%dT%H:%M:%SZ') AS local_date,
            CAST(home_id AS BIGINT) AS home_team_id, CAST(away_id AS BIGINT) AS away_team_id,
            regular_home AS goals_home_team, regular_away AS goals_away_team,
            home AS total_home_goals, away AS total_away_goals,
            CAST(shootout_home AS VARCHAR) AS penalty_shootout_home_goals,
            CAST(shootout_away AS VARCHAR) AS penalty_shootout_away_goals, CAST(match_id AS INT) AS game_order, 
            'int,bigint,bigint,int,int,string,string,bigint,bigint,int,int,int,int,int,int,int' AS types
          FROM game JOIN season c ON c.year = game.season LEFT JOIN link ON link.stadium_id = game.place_id""",
        "fact_fanout": """SELECT CAST(year(o_orderdate) AS INT) AS year, count(DISTINCT o_orderpriority)
          AS n_competitions FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1""",
        "stage_fallback": f"WITH {_LANDED} SELECT * FROM landed",
        "incremental_30d": f"SELECT {_EVENT} FROM events WHERE ts > TIMESTAMP '2024-01-11'",
        "retention_n_days": f"SELECT {_EVENT} FROM {_UNDATED} WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-21'",
        "staging_cleared": f"SELECT {_EVENT} FROM {_UNDATED} WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-21'",
        "results_updated": f"SELECT DISTINCT {_EVENT} FROM events WHERE ts >= TIMESTAMP '2024-01-12'",
        "results_emptied": f"""SELECT DISTINCT {_EVENT} FROM events
          WHERE ts >= TIMESTAMP '2024-01-12' AND CAST(ts AS DATE) <> DATE '2024-01-20'""",
        "model_incremental": f"""SELECT {_EVENT} FROM events
          WHERE ts >= TIMESTAMP '2024-01-07' AND CAST(ts AS DATE) <> DATE '2024-01-25'""",
        "json_scorers": """WITH scorer AS (SELECT l_orderkey AS id, 'Part ' || l_partkey AS player,
            l_returnflag AS code, l_linenumber AS minute, 7 AS second FROM lineitem WHERE l_returnflag <> 'N'
          UNION ALL SELECT l_orderkey, CASE WHEN l_linestatus = 'F' THEN 'Supp ' || l_suppkey END, l_returnflag,
            CASE WHEN l_linestatus = 'F' THEN l_linenumber + 45 END, CASE WHEN l_linestatus = 'F' THEN 30 END
            FROM lineitem WHERE l_returnflag <> 'N')
          SELECT id, player, code AS "countryCode", CAST(minute AS VARCHAR) AS minute, CAST(second AS VARCHAR) AS second,
            minute || '` ' || player || '(' || code || ')' AS text FROM scorer""",
        "dedup_staging": f"SELECT DISTINCT {_EVENT} FROM (SELECT * FROM events UNION ALL SELECT * FROM events)",
        "match_days": f"WITH {_LANDED} SELECT DISTINCT date FROM landed",
        "stage_names": f"WITH {_LANDED} SELECT DISTINCT stage_name FROM landed",
        "bucket_stage_date": f"""WITH {_LANDED}, placed AS (SELECT *,
            (row_number() OVER (PARTITION BY stage_name, date ORDER BY id) - 1) // 2 AS part FROM landed)
          SELECT stage_name, date, CAST(part AS BIGINT) AS part, count(*) AS n_rows,
            string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS match_ids FROM placed GROUP BY stage_name, date, part""",
        "seasons_ranked": f"""WITH {_SEASONS} SELECT *,
          row_number() OVER (PARTITION BY tournament_id ORDER BY name DESC) AS season_rank FROM season""",
        "seasons_ordered": f"WITH {_SEASONS} SELECT * FROM season WHERE name LIKE '%199%'",
        "latest_season": f"""WITH {_SEASONS} SELECT * FROM season s
          WHERE name = (SELECT max(name) FROM season t WHERE t.tournament_id = s.tournament_id)""",
        "union_by_name": """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
          CAST(NULL AS DOUBLE) AS balance FROM customer
          UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
        "clean_types": _TYPED,
        "staging_load": _TYPED + " WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'O'",
        "staging_rejects": """SELECT row_id, rejected FROM (SELECT o_orderkey AS row_id, concat_ws(',',
            CASE WHEN o_orderpriority = '1-URGENT' THEN 'id' END, CASE WHEN o_orderpriority = '2-HIGH' THEN 'price' END,
            CASE WHEN o_orderstatus = 'O' THEN 'day' END) AS rejected FROM orders) WHERE rejected <> ''""",
        "clean_rejects": """SELECT 'id' AS column_name, count(*) AS n_rejected FROM orders
            WHERE o_orderpriority = '1-URGENT'
          UNION ALL SELECT 'price', count(*) FROM orders WHERE o_orderpriority = '2-HIGH'
          UNION ALL SELECT 'day', count(*) FROM orders WHERE o_orderstatus = 'O'""",
        "scalar_dates": """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS unix_seconds,
          strftime(ts, '%Y-%m-%d') AS unix_day, CAST(year(ts) AS INT) AS unix_year,
          strftime(ts, '%Y%m%d') AS compact_day, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS clock
          FROM events""",
        "fk_violations": " UNION ALL ".join(
            [
                _orphans("nation", "n_regionkey", "region", "r_regionkey"),
                _orphans("customer", "c_nationkey", "nation", "n_nationkey"),
                _orphans("supplier", "s_nationkey", "nation", "n_nationkey"),
                _orphans("orders", "o_custkey", "solvent", "c_custkey", "customer WHERE c_acctbal > 0"),
                _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
                _orphans("lineitem", "l_partkey", "part", "p_partkey"),
                _orphans("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ]
        ),
        "unique_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
          GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "null_violations": """SELECT 'goals' AS table_name, c.column_name, count(*) AS n_null FROM orders
          CROSS JOIN (VALUES ('suppkey'), ('partkey')) c(column_name)
          WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY c.column_name""",
        "ordered_concat": f"WITH {_goals(2)} SELECT * FROM goal_text",
        "goals_by_season": f"""WITH {_GAME}, scored_lines AS (SELECT l_orderkey,
            sum(CAST(floor(l_quantity) AS BIGINT)) AS n FROM lineitem GROUP BY l_orderkey)
          SELECT competition, season, CAST(sum(n) AS BIGINT) AS n_goals, count(*) AS n_matches,
            CAST(sum(n) AS DOUBLE) / count(*) AS goals_per_match
          FROM game JOIN scored_lines ON l_orderkey = match_id GROUP BY competition, season""",
        "slice_nodes": f"{_FLAGS} {_SLICES}",
        "slice_edges": f"""{_FLAGS} SELECT season, competition, CAST(node.index AS BIGINT) AS index,
          CAST(dependency AS BIGINT) AS dependency FROM edge JOIN node USING (season, competition, type, key)""",
        "slice_schedule": f"{_PICTURES} {_SLICES}",
        "slice_lookup": f"""WITH {_GAME}, hit AS (SELECT * FROM game WHERE status = 'F' AND scored
            AND (home_team = 'NATION_1' OR away_team = 'NATION_1'))
          SELECT season, competition, 'match' AS type, NULL AS key, CAST(match_id AS VARCHAR) AS match_id FROM hit
          UNION SELECT season, competition, 'place', stadium, NULL FROM hit
          UNION SELECT season, competition, 'stage', stage, NULL FROM hit
          UNION SELECT season, competition, 'date', game_date, NULL FROM hit""",
        "slice_by_index": f"""{_SHORT} SELECT season, competition, part, matches, dependencies
          FROM listed JOIN node USING (season, competition, type, key) WHERE index = 3""",
        "slice_of_document": f"""{_SHORT} SELECT season, competition, part, matches, dependencies
          FROM listed JOIN node USING (season, competition, type, key)
          WHERE index = 7 AND season = 1995 AND competition = '3-MEDIUM'""",
        "slice_document": f"""{_SHORT} SELECT season, competition, CAST(index AS BIGINT) AS index, type, key, city,
          image_path, part, matches, dependencies FROM listed JOIN node USING (season, competition, type, key)""",
        "slice_document_matches": f"""WITH {_GAME}, {_goals(5)} SELECT season, competition, g.match_id,
          'finished' AS status, CAST(season AS BIGINT) AS year, game_date AS date, substr(date, 12, 8) AS time,
          home_team, away_team, city, stadium, stage, CAST(home AS BIGINT) AS total_home_goals,
          CAST(away AS BIGINT) AS total_away_goals, CAST(shootout_home AS VARCHAR) AS penalty_shootout_home_goals,
          CAST(shootout_away AS VARCHAR) AS penalty_shootout_away_goals, text, text_part, image_path_home,
          image_path_away, {_RESULT} AS result
          FROM game g JOIN goal_text t ON t.match_id = g.match_id WHERE g.status = 'F'""",
        "slice_document_blocks": _DOCUMENT_BLOCKS,
        "slice_document_sets": f"""SELECT season, competition, count(*) AS n_blocks,
          CAST(sum(n_slices) AS BIGINT) AS n_slices, CAST(sum(n_matches) AS BIGINT) AS n_matches
          FROM ({_DOCUMENT_BLOCKS}) GROUP BY season, competition""",
        "stream_project": f"{_GAME_EVENTS} FROM events",
        "stream_envelope": f"""SELECT '{{"id":' || id || ',"team1":"' || team1 || '","team2":"' || team2
          || '","score":"' || score || '"}}' AS value FROM ({_GAME_EVENTS} FROM events)""",
        "stream_latest": f"""{_GAME_EVENTS}, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
        "stream_compacted": f"{_GAME_EVENTS}, event_id FROM events",
        "stream_restart": f"{_GAME_EVENTS} FROM events",
    }
    return sql
