"""Oracle SQL (DuckDB dialect) for the query catalogue.

Each statement computes, directly from the source views, what the matching
query in ``zoneflow.plans.queries`` must return; column names match.  The
synonym rules are applied here one after another (nested CASE), independent
of the folded map the Spark side uses, and the country fill is written as a
correlated "latest season up to this one" lookup.
"""

from __future__ import annotations

# --- fixed values, written out here on their own ---------------------------------
EXCLUDED_SEASON = "1999-00"
REPLACED_SEASON = "1997-98"
NAME_STOP_TOKENS = ("sc", "bc", "acf", "afc", "fc", "cf", "club", "de", "la", "fútbol", "football", "04")
STANDARD_MATCH_COLUMNS = (
    ("round", "string"), ("ft", "string"), ("ht", "string"), ("agg_ft", "string"),
    ("et", "string"), ("p", "string"), ("stage", "string"), ("group", "string"),
    ("day", "string"), ("week", "int"), ("dateonly", "string"), ("temporada", "string"),
    ("round_type", "string"), ("team_name_1", "string"), ("country_1", "string"), ("team_name_2", "string"),
    ("country_2", "string"), ("team1score", "int"), ("team2score", "int"), ("comments", "string"),
    ("partition_0", "string"), ("partition_1", "string"),
)
TEAM_SYNONYM_RULES = (
    ("FC Barcelona", "Barcelona"),
    ("Barça", "Barcelona"),
    ("Manchester Utd", "Manchester United"),
    ("Man U", "Manchester United"),
    ("Real Madrid CF", "Real Madrid"),
    ("Los Blancos", "Real Madrid"),
    ("Bayern München", "Bayern Munich"),
    ("FC Bayern", "Bayern Munich"),
    ("Juventus FC", "Juventus"),
    ("La Vecchia Signora", "Juventus"),
    ("Paris Saint-Germain", "PSG"),
    ("PSG", "Paris Saint-Germain"),
    ("Chelsea FC", "Chelsea"),
    ("The Blues", "Chelsea"),
    ("Liverpool FC", "Liverpool"),
    ("The Reds", "Liverpool"),
    ("Manchester City FC", "Manchester City"),
    ("Man City", "Manchester City"),
    ("Inter Milano", "Inter Milan"),
    ("Inter Milan", "Inter Milan"),
    ("Atletico Madrid", "Atlético Madrid"),
    ("Atletico", "Atlético Madrid"),
    ("AC Milan", "Milan"),
    ("Milan AC", "Milan"),
    ("Tottenham Hotspur", "Tottenham"),
    ("Spurs", "Tottenham"),
    ("Sevilla FC", "Sevilla"),
    ("Benfica Lisbon", "Benfica"),
    ("SL Benfica", "Benfica"),
    ("Borussia Dortmund", "Dortmund"),
    ("BVB", "Dortmund"),
    ("Olympique de Marseille", "Marseille"),
    ("OM", "Marseille"),
    ("AS Roma", "Roma"),
    ("Giallorossi", "Roma"),
    ("Shakhtar Donetsk", "Shakhtar"),
    ("FC Shakhtar", "Shakhtar"),
    ("Ajax Amsterdam", "Ajax"),
    ("AFC Ajax", "Ajax"),
    ("RB Leipzig", "Leipzig"),
    ("RasenBallsport Leipzig", "Leipzig"),
    ("Zenit St. Petersburg", "Zenit"),
    ("FC Zenit", "Zenit"),
    ("Lazio Roma", "Lazio"),
    ("SS Lazio", "Lazio"),
    ("FC Porto", "Porto"),
    ("The Dragons", "Porto"),
    ("Sporting CP", "Sporting"),
    ("Sporting Lisbon", "Sporting"),
    ("Galatasaray SK", "Galatasaray"),
    ("Gala", "Galatasaray"),
    ("Red Star Belgrade", "Crvena Zvezda"),
    ("FK Crvena Zvezda", "Crvena Zvezda"),
    ("Celtic FC", "Celtic"),
    ("The Hoops", "Celtic"),
)
# ----------------------------------------------------------------------------------

_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def season(x: str) -> str:
    return f"(cast(year({x}) AS VARCHAR) || '-' || lpad(cast((year({x}) + 1) % 100 AS VARCHAR), 2, '0'))"


def letters(x: str) -> str:
    return f"('k' || translate(cast({x} AS VARCHAR), '0123456789', 'abcdefghij'))"


def team_pool() -> list[str]:
    return list(dict.fromkeys([label for rule in TEAM_SYNONYM_RULES for label in rule] + ["psg", "Unknown FC"]))


def text_date(x: str) -> str:
    return (f"('(' || strftime({x}, '%a') || ') ' || strftime({x}, '%-d %b %Y') || ' (W' "
            f"|| cast(weekofyear({x}) AS VARCHAR) || ')')")


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def week(x: str) -> str:
    return f"cast(weekofyear({x}) AS INTEGER)"


def std_nulls(present: set[str]) -> str:
    return ", ".join(f'cast(NULL AS {_DUCK_TYPES[t]}) AS "{c}"' for c, t in STANDARD_MATCH_COLUMNS if c not in present)


def normalize(x: str) -> str:
    """The name normalisation with Java regex semantics, in RE2 terms.

    Java's ``\\b`` treats any Unicode letter or decimal digit (or ``_``) as a
    word character and ``\\s`` includes the vertical tab; RE2 differs, so the
    boundary is spelled out and applied twice (adjacent stop words share one
    separator).
    """
    nonword = r"[^\p{L}\p{Nd}\p{Mn}_]"
    tokens = "|".join(NAME_STOP_TOKENS)
    pattern = f"(^|{nonword})({tokens})($|{nonword})"
    out = f"lower({x})"
    for _ in range(2):
        out = f"regexp_replace({out}, '{pattern}', '\\1\\3', 'g')"
    out = f"regexp_replace({out}, '[^a-z \\t\\n\\x0B\\f\\r]', '', 'g')"
    out = f"regexp_replace({out}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"
    return f"trim({out}, ' ')"


def sequential_synonyms(frame: str, column: str) -> str:
    """Wrap ``frame`` once per rule, each level rewriting ``column`` (rules in order)."""
    out = frame
    for src, dst in TEAM_SYNONYM_RULES:
        out = (f"SELECT * REPLACE (CASE WHEN {column} = {_q(src)} THEN {_q(dst)} ELSE {column} END AS {column}) "
               f"FROM ({out})")
    return out


def pick_team(x: str) -> str:
    pool = team_pool()
    return f"([{', '.join(_q(t) for t in pool)}])[({x} % {len(pool)}) + 1]"


MATCH_FRAME = f"""
SELECT o.o_orderkey, c.c_name AS team_name_1,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL
            WHEN o.o_orderpriority = '5-LOW' THEN 'NA'
            WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN n.n_name
            ELSE lower(n.n_name) END AS country_1,
       {season('o.o_orderdate')} AS season, c.c_custkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def fill_sql(frame: str) -> str:
    """Country fill: value of the latest season <= own season with a real value (max in it)."""
    return f"""
WITH m AS ({frame}),
known AS (SELECT team_name_1, season, max(country_1) AS country_1 FROM m
          WHERE country_1 IS NOT NULL AND country_1 <> 'NA' GROUP BY team_name_1, season)
SELECT m.o_orderkey, m.team_name_1,
       CASE WHEN m.country_1 IS NULL OR m.country_1 = 'NA' THEN coalesce((
            SELECT k.country_1 FROM known k
            WHERE k.team_name_1 IS NOT DISTINCT FROM m.team_name_1 AND k.season = (
                SELECT max(k2.season) FROM known k2
                WHERE k2.team_name_1 IS NOT DISTINCT FROM m.team_name_1 AND k2.season <= m.season)), 'NA')
            ELSE m.country_1 END AS country_1,
       m.season
FROM m"""


ENTITIES = f"""
WITH c AS (SELECT {letters('c_custkey')} AS name,
                  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS nationkey,
                  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance,
                  c_mktsegment AS segment FROM customer),
     s AS (SELECT {letters('s_suppkey')} AS name, s_nationkey AS nationkey, s_acctbal AS balance FROM supplier),
     p AS (SELECT {letters('p_partkey')} AS name, p_retailprice AS balance, p_size AS size, p_brand AS brand FROM part)
SELECT coalesce(c.name, s.name, p.name) AS name, coalesce(c.nationkey, s.nationkey) AS nationkey,
       coalesce(c.balance, s.balance, p.balance) AS balance, c.segment AS segment, p.size AS size, p.brand AS brand
FROM c FULL JOIN s ON c.name = s.name FULL JOIN p ON coalesce(c.name, s.name) = p.name
"""

CUST_SUPP_UNION = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment
FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
"""

ORDERS_TEXT = """cast(o_orderkey AS VARCHAR) AS o_orderkey, cast(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, cast(o_totalprice AS VARCHAR) AS o_totalprice,
       cast(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority"""

MATCH_DATES = f"""
SELECT o_orderpriority AS "round", cast(o_orderkey AS VARCHAR) AS comments,
       {iso('o_orderdate')} AS dateonly, strftime(o_orderdate, '%a') AS "day", {week('o_orderdate')} AS week,
       {std_nulls({'round', 'comments', 'dateonly', 'day', 'week'})},
       {season('o_orderdate')} AS season
FROM orders"""

MATCH_SCORES = f"""
SELECT cast(l_orderkey AS VARCHAR) || '-' || cast(l_linenumber AS VARCHAR) AS comments,
       CASE WHEN l_linenumber % 3 = 0 THEN cast(l_quantity AS INTEGER) ELSE l_linenumber END AS team1score,
       CASE WHEN l_linenumber % 2 = 0 THEN cast(l_partkey % 5 AS INTEGER) ELSE cast(l_suppkey % 10 AS INTEGER) END
           AS team2score,
       CASE WHEN l_returnflag IN ('R', 'A') THEN 'g' ELSE l_returnflag END AS round_type,
       {std_nulls({'comments', 'team1score', 'team2score', 'round_type'})},
       {season('l_shipdate')} AS season
FROM lineitem"""

PARTS_TEXT = """CASE WHEN o_orderstatus = 'F'
            THEN '(W' || cast(weekofyear(o_orderdate) AS VARCHAR) || ') (' || strftime(o_orderdate, '%a') || ') '
                 || strftime(o_orderdate, '%-d %b %Y')
            ELSE '(' || strftime(o_orderdate, '%a') || ') ' || strftime(o_orderdate, '%-d %b %Y') || ' (W'
                 || cast(weekofyear(o_orderdate) AS VARCHAR) || ')' END"""

TEAMS_RAW = f"""
WITH s AS (SELECT {letters('s_suppkey')} AS name, cast(s_suppkey AS INTEGER) AS "index",
                  s_nationkey AS matches_played, cast(s_suppkey % 10 AS INTEGER) AS wins,
                  cast(s_nationkey % 3 AS INTEGER) AS draws, 1 AS losses,
                  cast(s_nationkey AS VARCHAR) || '-' || cast(s_suppkey % 7 AS VARCHAR) AS total_goals,
                  cast(s_nationkey - s_suppkey % 7 AS INTEGER) AS goal_difference,
                  cast((s_suppkey % 10) * 3 + s_nationkey % 3 AS INTEGER) AS points FROM supplier),
     c AS (SELECT {letters('c_custkey')} AS name, c_custkey AS key, cast(1900 + c_nationkey AS INTEGER) AS foundation_year,
                  c_mktsegment AS status, c_name AS coach_first_name, {letters('c_nationkey')} AS coach_last_name,
                  cast(c_nationkey AS VARCHAR) AS coach_nationality, '1970-01-01' AS coach_date_of_birth
           FROM customer)
SELECT coalesce(s.name, c.name) AS name, s."index", s.matches_played, s.wins, s.draws, s.losses, s.total_goals,
       s.goal_difference, s.points, c.key, c.foundation_year, c.status, c.coach_first_name, c.coach_last_name,
       c.coach_nationality, c.coach_date_of_birth
FROM s FULL JOIN c ON s.name = c.name"""

TEAM_GOALS = f"""
WITH g AS (SELECT l_suppkey, cast(sum(l_quantity) AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY l_suppkey)
SELECT {letters('l_suppkey')} AS name, cast(q AS VARCHAR) || '-' || cast(n AS VARCHAR) AS total_goals,
       cast(q AS INTEGER) AS total_goals_scored, cast(n AS INTEGER) AS total_goals_against
FROM g"""

SUPPLIER_TEXT = """SELECT cast(s_suppkey AS VARCHAR) AS s_suppkey, s_name, cast(s_nationkey AS VARCHAR) AS s_nationkey,
       cast(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier"""

CUSTOMER_TEXT = """SELECT cast(c_custkey AS VARCHAR) AS c_custkey, c_name, cast(c_nationkey AS VARCHAR) AS c_nationkey,
       cast(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"""

SUPPLIER_JSON = """SELECT cast(to_json([cast(s_suppkey AS VARCHAR), s_name, cast(s_nationkey AS VARCHAR),
       cast(s_acctbal AS VARCHAR)]) AS VARCHAR) AS data FROM supplier"""

ENRICH_BASE = f"""
SELECT o.o_orderkey, {pick_team('c.c_custkey')} AS team_name_1,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL
            WHEN o.o_orderpriority = '5-LOW' THEN 'NA'
            WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN n.n_name
            ELSE lower(n.n_name) END AS country_1,
       {season('o.o_orderdate')} AS season
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE {season('o.o_orderdate')} <> '{EXCLUDED_SEASON}'"""
ENRICH_FRAME = sequential_synonyms(ENRICH_BASE, "team_name_1")
ENRICH_ALL_FRAME = sequential_synonyms(ENRICH_BASE[:ENRICH_BASE.index("WHERE")], "team_name_1")

ENRICH_SKIPPED = f"""
SELECT o.o_orderkey, {pick_team('c.c_custkey')} AS team_name_1,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL
            WHEN o.o_orderpriority = '5-LOW' THEN 'NA'
            WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN n.n_name
            ELSE lower(n.n_name) END AS country_1,
       {season('o.o_orderdate')} AS season
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE {season('o.o_orderdate')} = '{EXCLUDED_SEASON}'"""


PART_NAME = f"CASE WHEN p_size % 10 <> 0 THEN {letters('p_size')} END"

MERGE_DUPLICATES = f"""
WITH a AS (SELECT {PART_NAME} AS name, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS brand, p_retailprice AS price FROM part),
     b AS (SELECT {PART_NAME} AS name, p_brand AS brand, p_type AS container FROM part),
     a1 AS (SELECT * FROM a WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY brand IS NULL,
            CASE WHEN brand IS NULL THEN '{{"price":' ELSE '{{"brand":"' || brand || '","price":' END
            || cast(price AS VARCHAR) || '}}') = 1),
     b1 AS (SELECT * FROM b WHERE name IS NOT NULL QUALIFY row_number() OVER (
            PARTITION BY name ORDER BY '{{"brand":"' || brand || '","container":"' || container || '"}}') = 1)
SELECT coalesce(a1.name, b1.name) AS name, coalesce(a1.brand, b1.brand) AS brand, a1.price AS price, b1.container AS container
FROM a1 FULL JOIN b1 ON a1.name = b1.name
UNION ALL SELECT name, brand, price, NULL FROM a WHERE name IS NULL
UNION ALL SELECT name, brand, NULL, container FROM b WHERE name IS NULL"""

TEAM_FILES = f"""
WITH s AS (SELECT s_suppkey AS k, s_nationkey AS nation FROM supplier),
     named AS (SELECT {letters('k')} AS name, cast(k AS INTEGER) AS i, CASE WHEN k % 3 <> 0 THEN nation ELSE 77 END AS m,
                      cast(k % 10 AS BIGINT) AS w FROM s WHERE k % 5 <> 0),
     c AS (SELECT {letters('c_custkey')} AS name, c_custkey AS w, cast(1900 + c_nationkey AS INTEGER) AS y,
                  'Arena ' || c_nationkey AS stadium FROM customer),
     nameless AS (SELECT cast(k AS INTEGER) AS i, CASE WHEN k % 3 <> 0 THEN nation END AS m, k % 10 AS w FROM s WHERE k % 5 = 0
                  UNION ALL SELECT cast(k AS INTEGER), NULL, 99 FROM s WHERE k % 5 = 0
                  UNION ALL SELECT cast(k AS INTEGER), 77, k % 10 + 50 FROM s WHERE k % 5 = 0)
SELECT coalesce(n.name, c.name) AS name, n.i AS "index", cast(n.m AS INTEGER) AS matches_played,
       cast(coalesce(n.w, c.w) AS BIGINT) AS wins, c.y AS foundation_year, c.stadium AS stadium
FROM named n FULL JOIN c ON n.name = c.name
UNION ALL SELECT NULL, i, cast(m AS INTEGER), cast(w AS BIGINT), NULL, NULL FROM nameless"""

PAGES = """
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS n, count(*) OVER () AS total,
                  cast(to_json([cast(c_custkey AS VARCHAR), c_name, cast(c_nationkey AS VARCHAR), c_mktsegment]) AS VARCHAR) AS row
           FROM customer)
SELECT '{"columns":["c_custkey","c_name","c_nationkey","c_mktsegment"],"data":[' || string_agg(row, ',' ORDER BY c_custkey) || ']}'
           AS document,
       CASE WHEN max(total) > max(n) THEN max(c_custkey) END AS next, cast((n - 1) // 50 + 1 AS INTEGER) AS page
FROM r WHERE n <= 100 GROUP BY (n - 1) // 50"""


ORACLES: dict[str, str] = {
    # scans
    "season_folder_scan": f"SELECT {season('o_orderdate')} AS season, count(*) AS n_rows FROM orders GROUP BY 1",
    "season_exclude": f"SELECT * FROM (SELECT *, {season('o_orderdate')} AS season FROM orders) "
                      f"WHERE season <> '{EXCLUDED_SEASON}'",
    "csv_scan_strings": CUSTOMER_TEXT,
    "csv_scan_schema": "SELECT * FROM supplier",
    "json_multiline_scan": "SELECT * FROM customer",
    "json_arrays_split": "SELECT * FROM customer",
    "parquet_scan": "SELECT * FROM part",
    "parquet_recursive_merge": CUST_SUPP_UNION,
    "parquet_merge_conflicting_types": """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE 'n' || c_nationkey END AS c_nationkey,
       CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE floor(c_acctbal) END AS c_acctbal,
       CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "mixed_format_scan": "SELECT * FROM customer",
    "tolerant_scan": "SELECT * FROM supplier",
    "catalog_select_all": "SELECT * FROM customer",
    # sinks
    "parquet_overwrite": "SELECT * FROM orders",
    "parquet_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "single_file_parquet": "SELECT * FROM supplier",
    "single_csv_export": SUPPLIER_TEXT,
    "single_csv_export_text": """SELECT cast(doc_id AS VARCHAR) AS doc_id, text, lang, source,
                                        cast(n_chars AS VARCHAR) AS n_chars FROM documents""",
    "serve_page_document": PAGES,
    "season_partition_overwrite": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN {season('o_orderdate')} = '{REPLACED_SEASON}' THEN o_totalprice * 2 ELSE o_totalprice END
                   AS o_totalprice,
               o_orderdate, o_orderpriority, {season('o_orderdate')} AS season
        FROM orders""",
    "write_if_nonempty": "SELECT * FROM orders",
    "json_rows_export": SUPPLIER_JSON,
    "preview_rows": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
    # projections and schema
    "rename_columns": "SELECT c_custkey, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
    "drop_columns": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "standardize_columns": f"SELECT *, {std_nulls(set())} FROM orders",
    "align_to_schema": """
        SELECT p_partkey, p_name,
               try_cast(CASE WHEN p_size > 40 THEN cast(p_size AS VARCHAR) || 'x' ELSE cast(p_size AS VARCHAR) END
                        AS INTEGER) AS p_size,
               cast(NULL AS VARCHAR) AS p_container
        FROM part""",
    "unify_schemas": CUST_SUPP_UNION,
    "union_by_name_lenient": CUST_SUPP_UNION,
    "union_by_name_strict": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "flatten_struct": """
        SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS props_k,
               json_extract_string(props, '$.z') AS props_z, cast(NULL AS VARCHAR) AS props_w
        FROM events""",
    "date_from_first_source": f"""
        SELECT 'both' AS src, o_orderkey, {iso('o_orderdate')} AS dateonly, strftime(o_orderdate, '%a') AS "day",
               {week('o_orderdate')} AS week FROM orders
        UNION ALL
        SELECT 'text' AS src, o_orderkey, {iso('o_orderdate')} AS dateonly, strftime(o_orderdate, '%a') AS "day",
               {week('o_orderdate')} AS week FROM orders""",
    "date_from_timestamp": f"""SELECT event_id, {iso('ts')} AS dateonly, strftime(ts, '%a') AS "day",
                                      {week('ts')} AS week FROM events""",
    "date_from_text": f"""SELECT o_orderkey, {iso('o_orderdate')} AS dateonly, strftime(o_orderdate, '%a') AS "day",
                                 {week('o_orderdate')} AS week FROM orders""",
    "date_text_parts": f"""
        SELECT o_orderkey, regexp_extract({PARTS_TEXT}, '\\((\\w{{3}})\\)', 1) AS day_txt,
               try_cast(regexp_extract({PARTS_TEXT}, '\\(W(\\d{{1,2}})\\)', 1) AS INTEGER) AS week_txt
        FROM orders""",
    # scalar functions
    "normalize_name": f"""SELECT p_partkey, {normalize("concat_ws(' ', 'FC', p_name, 'de la', p_brand, p_type, 'Club 04')")}
                                 AS name FROM part""",
    "normalize_name_documents": f"SELECT doc_id, {normalize('text')} AS name FROM documents",
    "synonym_canonicalize": sequential_synonyms(
        f"SELECT c_custkey, {pick_team('c_custkey')} AS team, {pick_team('c_custkey')} AS canonical FROM customer",
        "canonical"),
    "split_pair_to_ints": """
        WITH g AS (SELECT o_orderkey, o_orderpriority,
                          CASE WHEN o_orderstatus = 'F'
                               THEN cast(o_custkey % 10 AS VARCHAR) || '-' || cast(o_orderkey % 7 AS VARCHAR)
                               WHEN o_orderstatus = 'O' THEN cast(o_custkey % 10 AS VARCHAR)
                               ELSE '-' || cast(o_custkey % 10 AS VARCHAR) || '-' || cast(o_orderkey % 7 AS VARCHAR)
                          END AS goals FROM orders)
        SELECT o_orderkey,
               try_cast(split_part(o_orderpriority, '-', 1) AS INTEGER) AS prio_1,
               try_cast(split_part(o_orderpriority, '-', 2) AS INTEGER) AS prio_2,
               try_cast(split_part(goals, '-', 1) AS INTEGER) AS scored,
               try_cast(split_part(goals, '-', 2) AS INTEGER) AS against
        FROM g""",
    "score_backfill": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber % 3 = 0 THEN cast(l_quantity AS INTEGER) ELSE l_linenumber END AS team1score,
               cast(l_suppkey % 10 AS INTEGER) AS team2score
        FROM lineitem""",
    "null_token_default": """
        SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'F') THEN 'g' ELSE o_orderpriority END AS round_type
        FROM orders""",
    # aggregates, merge, fill
    "known_pairs": f"SELECT DISTINCT team_name_1, country_1 FROM ({MATCH_FRAME}) WHERE country_1 IS NOT NULL",
    "latest_known_value": f"""
        WITH m AS ({MATCH_FRAME}),
             r AS (SELECT * FROM m WHERE country_1 IS NOT NULL AND country_1 <> 'NA'),
             last AS (SELECT team_name_1, max(season) AS season FROM r GROUP BY team_name_1)
        SELECT r.team_name_1, r.season, max(r.country_1) AS country_1
        FROM r JOIN last USING (team_name_1, season) GROUP BY r.team_name_1, r.season""",
    "season_row_counts": f"SELECT {season('o_orderdate')} AS season, count(*) AS n_rows FROM orders GROUP BY 1",
    "outer_merge_first_non_null": ENTITIES,
    "outer_merge_grouped": ENTITIES,
    "outer_merge_duplicates": MERGE_DUPLICATES,
    "lookup_fill_asof": fill_sql(MATCH_FRAME),
    "lookup_fill_asof_window": fill_sql(MATCH_FRAME),
    # jobs
    "pipe_season_raw": f"SELECT {ORDERS_TEXT}, {season('o_orderdate')} AS season FROM orders",
    "pipe_season_raw_layouts": f"""
WITH o AS (SELECT *, {season('o_orderdate')} AS season FROM orders),
     bad AS (SELECT season, CAST(count(*) AS INTEGER) AS rejected FROM o WHERE o_orderkey % 50 = 7 GROUP BY season)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 <> 1 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority, o.season, bad.rejected
FROM o LEFT JOIN bad ON o.season = bad.season""",
    "pipe_season_raw_changed": f"""
SELECT * REPLACE (CASE WHEN season = '{REPLACED_SEASON}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
FROM (SELECT {ORDERS_TEXT}, {season('o_orderdate')} AS season FROM orders)""",
    "pipe_match_enrich_late": fill_sql(ENRICH_ALL_FRAME),
    "pipe_all_seasons_csv_broken": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN year(o_orderdate) % 2 = 0 THEN '' ELSE 'c' END || o_custkey AS code,
       CASE WHEN year(o_orderdate) % 2 = 1 THEN o_orderstatus END AS o_orderstatus, {season('o_orderdate')} AS season,
       CAST(1 AS INTEGER) AS rejected FROM orders""",
    "synonym_rules_closed": """
WITH RECURSIVE rules AS (
  SELECT o_orderkey AS position, 'v' || (o_custkey % 997) AS source, 'v' || (o_orderkey * 31 % 1009) AS target FROM orders),
following AS (
  SELECT a.position, a.source, a.target, min(b.position) AS next FROM rules a LEFT JOIN rules b
    ON b.source = a.target AND b.position > a.position GROUP BY ALL),
starts AS (SELECT source, min(position) AS position FROM rules GROUP BY source),
chain AS (
  SELECT s.source, f.target, f.next FROM starts s JOIN following f ON s.position = f.position
  UNION ALL
  SELECT c.source, f.target, f.next FROM chain c JOIN following f ON c.next = f.position),
closed AS (SELECT source, target FROM chain WHERE next IS NULL)
SELECT c_custkey, coalesce(target, 'v' || (c_custkey % 1200)) AS team
FROM customer LEFT JOIN closed ON source = 'v' || (c_custkey % 1200)""",
    "stream_season_raw": f"SELECT {ORDERS_TEXT}, {season('o_orderdate')} AS season FROM orders",
    "pipe_match_dates": MATCH_DATES,
    "pipe_match_scores": MATCH_SCORES,
    "pipe_match_dates_mixed_layouts": f"""
        SELECT cast(o_orderkey AS VARCHAR) AS comments,
               CASE WHEN year(o_orderdate) % 3 < 2 THEN {iso('o_orderdate')} END AS dateonly,
               CASE WHEN year(o_orderdate) % 3 < 2 THEN strftime(o_orderdate, '%a') ELSE 'Fri' END AS "day",
               CASE WHEN year(o_orderdate) % 3 < 2 THEN {week('o_orderdate')} ELSE 7 END AS week,
               {season('o_orderdate')} AS season FROM orders""",
    "pipe_match_scores_mixed_layouts": f"""
        SELECT cast(o_orderkey AS VARCHAR) AS comments,
               cast(CASE WHEN year(o_orderdate) % 2 = 0 AND o_orderstatus = 'O' THEN o_custkey % 9 ELSE o_custkey % 4 END
                    AS INTEGER) AS team1score,
               CASE WHEN year(o_orderdate) % 2 = 0 THEN CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'g' END END
                   AS round_type,
               {season('o_orderdate')} AS season FROM orders""",
    "pipe_teams_multi_file": TEAM_FILES,
    "pipe_countries_bad_file": """
        SELECT cast(s_suppkey AS VARCHAR) AS s_suppkey, s_name, 'csv' AS origin, cast(NULL AS DOUBLE) AS s_acctbal,
               1 AS rejected FROM supplier
        UNION ALL SELECT cast(s_suppkey AS VARCHAR), s_name, NULL, s_acctbal, 1 FROM supplier""",
    "pipe_countries_json_types": """SELECT s_suppkey, s_name, s_acctbal, cast(s_nationkey AS BIGINT) AS nation FROM supplier""",
    "pipe_match_enrich": f"SELECT * FROM ({fill_sql(ENRICH_FRAME)}) UNION ALL BY NAME SELECT * FROM ({ENRICH_SKIPPED})",
    "pipe_match_enrich_incremental": fill_sql(ENRICH_ALL_FRAME),
    "pipe_fact_matches": f"""
        SELECT *, 'dates' AS source FROM ({MATCH_DATES})
        UNION ALL BY NAME
        SELECT *, 'scores' AS origin FROM ({MATCH_SCORES})""",
    "pipe_teams_raw": TEAMS_RAW,
    "pipe_players_raw": f"""SELECT *, cast(NULL AS VARCHAR) AS player_name, cast(NULL AS VARCHAR) AS team,
                                   cast(NULL AS INTEGER) AS goals FROM ({TEAMS_RAW})""",
    "pipe_dim_teams": TEAM_GOALS,
    "pipe_countries_raw": SUPPLIER_TEXT,
    "pipe_dim_countries": "SELECT s_name AS country_id, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier",
    "pipe_general_dims": f"""
        SELECT *, 'DimCountries' AS dim FROM ({SUPPLIER_TEXT})
        UNION ALL BY NAME
        SELECT *, 'DimTeams' AS dim FROM ({CUSTOMER_TEXT})""",
    "pipe_all_seasons_csv": f"SELECT {ORDERS_TEXT}, {season('o_orderdate')} AS season FROM orders",
    "pipe_serve_table": SUPPLIER_JSON,
}
