"""Zone stand-ins built from the driver tables.

The reference's real inputs (season CSV folders, team standings, team JSON,
country files) are not shipped, so these builders derive equivalent zones
from the TPC-H-like tables with Spark jobs.  Everything is written below the
session's shared checkpoint folder and grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.names import TEAM_SYNONYM_RULES
from zoneflow.session import scratch_dir
from zoneflow.sinks.writers import filesystem, move_path, write_parquet

CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
JSON_CHUNK_ROWS = 10_000      # rows per multi-line JSON array file
EXCLUDED_SEASON = "1999-00"   # the season the stand-in queries skip
REPLACED_SEASON = "1997-98"   # the season the partition-replace query rewrites


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def season_of(ts: Column | str) -> Column:
    """``1995-96`` style season of a timestamp (stand-in rule: calendar year + next)."""
    y = F.year(F.col(ts) if isinstance(ts, str) else ts)
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def letters(key: Column | str) -> Column:
    """A digit-free unique name for a numeric key of any length: 12 -> ``kbc`` (never a stop word)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("k"), F.translate(k.cast("string"), "0123456789", "abcdefghij"))


def team_pool() -> list[str]:
    """Team labels for synonym tests: every rule source and target plus unknowns."""
    pool = []
    for src, dst in TEAM_SYNONYM_RULES:
        pool += [src, dst]
    pool += ["psg", "Unknown FC"]
    return list(dict.fromkeys(pool))


def pick_team(key: Column | str) -> Column:
    """Deterministic team label for a numeric key, cycling through ``team_pool``."""
    pool = team_pool()
    k = F.col(key) if isinstance(key, str) else key
    return F.element_at(F.array(*[F.lit(t) for t in pool]), (k % len(pool) + 1).cast("int"))


def text_date(ts: Column | str) -> Column:
    """``(Tue) 14 Sep 2021 (W37)`` text of a timestamp."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.lit("("), F.date_format(t, "EEE"), F.lit(") "), F.date_format(t, "d MMM yyyy"),
                    F.lit(" (W"), F.weekofyear(t).cast("string"), F.lit(")"))


# -- writers of landing layouts ------------------------------------------------

def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def write_json_arrays(df: DataFrame, path: str, chunk_key: str, rows_per_file: int = JSON_CHUNK_ROWS) -> str:
    """Multi-line JSON: files holding one array of at most ``rows_per_file`` objects.

    ``chunk_key`` must be a unique numeric key, so every chunk is bounded.
    """
    chunk = F.floor(F.col(chunk_key) / rows_per_file).alias("_chunk")
    docs = (df.select(chunk, F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("_doc"))
            .groupBy("_chunk")
            .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("_doc"), ",\n"), F.lit("\n]")).alias("value")))
    # one array per file; the text writer names files *.txt, JSON files are found by extension
    docs.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    fs, root = filesystem(df.sparkSession, path)
    hpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path
    for status in fs.globStatus(hpath(root, "*.txt")) or []:
        fs.rename(status.getPath(), hpath(root, status.getPath().getName()[:-4] + ".json"))
    return path


def land_by_season(spark: SparkSession, df: DataFrame, base: str, season_col: str = "season",
                   batch: str = "batch") -> str:
    """CSV files in ``<base>/<season>/<batch>/`` folders (the landing layout).

    One parallel write partitioned by season, then one folder rename per season
    (metadata only) from ``season=X`` to ``X``.
    """
    stage = f"{base}/_incoming"
    df.write.mode("overwrite").options(**CSV_OPTIONS).partitionBy(season_col).csv(stage)
    jvm = spark.sparkContext._jvm
    stage_path = jvm.org.apache.hadoop.fs.Path(stage)
    fs = stage_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(stage_path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{season_col}="):
            move_path(spark, status.getPath().toString(), f"{base}/{name.split('=', 1)[1]}/{batch}")
    return base


def add_landing_noise(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Folders a season scan must ignore: a subject folder and a malformed season name."""
    nation = table(spark, sf_dir, "nation")
    write_csv(nation, f"{base}/COUNTRIES")
    write_csv(nation, f"{base}/1995-1996")


# -- stand-in zones ---------------------------------------------------------------

def landing_orders(spark: SparkSession, sf_dir: str, date_column: str = "o_orderdate",
                   date_as_text: bool = False) -> str:
    """Orders as landing CSV season folders, plus noise folders.

    ``date_as_text`` writes the order date as ``(Tue) 14 Sep 2021 (W37)`` text.
    """
    base = scratch_dir(spark, "landing")
    orders = table(spark, sf_dir, "orders").withColumn("season", season_of("o_orderdate"))
    if date_as_text:
        orders = orders.withColumn("o_orderdate", text_date("o_orderdate"))
    land_by_season(spark, orders.withColumnRenamed("o_orderdate", date_column), base)
    add_landing_noise(spark, sf_dir, base)
    return base


def rename_text_files(spark: SparkSession, folder: str, suffix: str) -> None:
    """``*.txt`` files of a folder get another suffix (metadata only)."""
    fs, root = filesystem(spark, folder)
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.globStatus(hpath(root, "*.txt")) or []:
        fs.rename(status.getPath(), hpath(root, status.getPath().getName()[:-4] + suffix))


def landing_layouts(spark: SparkSession, sf_dir: str) -> str:
    """Orders as landing season folders whose files differ in columns and their order (by the key's remainder
    of 3), with records that have too few or too many cells among them."""
    base = scratch_dir(spark, "landing-layouts")
    orders = table(spark, sf_dir, "orders").withColumn("season", season_of("o_orderdate"))
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "season")
    rest = F.pmod("o_orderkey", F.lit(3))
    for k, columns in enumerate((["o_orderkey", "o_custkey", "o_orderstatus"], ["o_orderstatus", "o_orderkey"],
                                 ["o_orderpriority", "o_custkey", "O_ORDERKEY"])):
        land_by_season(spark, orders.filter(rest == k).select(*columns, "season"), base, batch=f"layout-{k}")
    odd = orders.filter(F.pmod("o_orderkey", F.lit(50)) == 7).select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), F.lit("x"), F.lit("y"), F.lit("z")).alias("value"),
        "o_orderkey", "season")
    odd = odd.select(F.when(F.col("o_orderkey") % 4 < 2, "short").otherwise(F.col("value")).alias("value"), "season")
    stage = f"{base}/_odd"
    # blank lines before the header
    head = odd.select("season").distinct().select(F.lit("\n\no_orderkey,o_custkey,o_orderstatus").alias("value"), "season")
    lines = head.withColumn("n", F.lit(0)).unionByName(odd.withColumn("n", F.lit(1)))
    lines.repartition("season").sortWithinPartitions("season", "n").drop("n").write.partitionBy("season").text(stage)
    fs, root = filesystem(spark, stage)
    for status in fs.listStatus(root):
        if status.isDirectory():
            move_path(spark, status.getPath().toString(), f"{base}/{status.getPath().getName().split('=', 1)[1]}/odd")
    return base


def building_conflicting(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a ``season=`` table whose seasons hold a status as text, a price as number or text, and a broken file."""
    path = scratch_dir(spark, "building-conflicting")
    o = table(spark, sf_dir, "orders").withColumn("season", season_of("o_orderdate"))
    even = F.year("o_orderdate") % 2 == 0
    base = ["o_orderkey", "season"]
    write_parquet(o.filter(even).select(*base, F.col("o_custkey").alias("code")), path, mode="append", partition_by=("season",))
    write_parquet(o.filter(~even).select(*base, F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("code"), "o_orderstatus"),
                  path, mode="append", partition_by=("season",))
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("value")).coalesce(1).write.text(f"{path}/_broken")
    rename_text_files(spark, f"{path}/_broken", ".parquet")
    fs, root = filesystem(spark, f"{path}/_broken")
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.globStatus(hpath(root, "*.parquet")):
        move_path(spark, status.getPath().toString(), f"{path}/season={REPLACED_SEASON}/{status.getPath().getName()}")
    return path


def orders_by_season(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a ``season=`` partitioned parquet table."""
    path = scratch_dir(spark, "orders-by-season")
    orders = table(spark, sf_dir, "orders").withColumn("season", season_of("o_orderdate"))
    return write_parquet(orders, path, partition_by=("season",))


def raw_match_dates(spark: SparkSession, sf_dir: str) -> str:
    """Raw match rows for W2: ``Date`` text, ``index``, ``matchday``, ``∑ft`` helpers."""
    path = scratch_dir(spark, "raw-dates")
    o = table(spark, sf_dir, "orders")
    df = o.select(
        F.col("o_orderkey").alias("index"),
        F.col("o_orderstatus").alias("matchday"),
        text_date("o_orderdate").alias("Date"),
        F.col("o_orderpriority").alias("∑ft"),
        F.col("o_orderpriority").alias("round"),
        F.col("o_orderkey").cast("string").alias("comments"),
        season_of("o_orderdate").alias("season"))
    return write_parquet(df, path, partition_by=("season",))


def raw_match_scores(spark: SparkSession, sf_dir: str) -> str:
    """Raw match rows for W3: partial ``score1/2``, text ``team1/2score``, ``round_type`` tokens."""
    path = scratch_dir(spark, "raw-scores")
    li = table(spark, sf_dir, "lineitem")
    df = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("comments"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(F.col("l_linenumber")).cast("int").alias("score1"),
        F.col("l_quantity").cast("int").cast("string").alias("team1score"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(None)).otherwise((F.col("l_suppkey") % 10).cast("string")).alias("score2"),
        (F.col("l_partkey") % 5).cast("string").alias("team2score"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).when(F.col("l_returnflag") == "A", F.lit("NA"))
         .otherwise(F.col("l_returnflag")).alias("round_type"),
        season_of("l_shipdate").alias("season"))
    return write_parquet(df, path, partition_by=("season",))


def match_frame(spark: SparkSession, sf_dir: str, team: Column | None = None) -> DataFrame:
    """(o_orderkey, team_name_1, country_1, season) rows with null and ``NA`` countries.

    Countries come from the customer's nation; their spelling depends on the
    order priority, so one team can show several values within a season.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    country = (F.when(F.col("o_orderstatus") == "P", F.lit(None))
               .when(F.col("o_orderpriority") == "5-LOW", F.lit("NA"))
               .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("n_name"))
               .otherwise(F.lower("n_name")))
    return joined.select(
        "o_orderkey",
        (team if team is not None else F.col("c_name")).alias("team_name_1"),
        country.alias("country_1"),
        season_of("o_orderdate").alias("season"))


def raw_match_teams(spark: SparkSession, sf_dir: str) -> str:
    """Raw match rows for W4: synonym-pool team labels, countries with gaps."""
    path = scratch_dir(spark, "raw-teams")
    df = match_frame(spark, sf_dir, team=pick_team("c_custkey"))
    return write_parquet(df, path, partition_by=("season",))


def raw_dates_by_layout(spark: SparkSession, sf_dir: str) -> str:
    """Raw match rows for W2 whose seasons differ in columns, by the year's remainder of 3:
    a ``datetime``; a ``Date`` text; neither, but ``day`` and ``week``."""
    path = scratch_dir(spark, "raw-dates-layouts")
    o = table(spark, sf_dir, "orders")
    kind = F.year("o_orderdate") % 3
    own = (
        [F.col("o_orderdate").cast("string").alias("datetime"), F.lit("old").alias("day")],
        [text_date("o_orderdate").alias("Date"), F.col("o_orderkey").alias("index")],
        [F.lit("Fri").alias("day"), F.lit(7).alias("week")],
    )
    for rest, columns in enumerate(own):
        rows = o.filter(kind == rest).select(F.col("o_orderkey").cast("string").alias("comments"), *columns,
                                             season_of("o_orderdate").alias("season"))
        write_parquet(rows, path, mode="append", partition_by=("season",))
    return path


def raw_scores_by_layout(spark: SparkSession, sf_dir: str) -> str:
    """Raw match rows for W3: even years have ``round_type`` (null or a value) and ``score1``, odd ones neither."""
    path = scratch_dir(spark, "raw-scores-layouts")
    o = table(spark, sf_dir, "orders")
    base = [F.col("o_orderkey").cast("string").alias("comments"), (F.col("o_custkey") % 4).cast("string").alias("team1score"),
            season_of("o_orderdate").alias("season")]
    even = F.year("o_orderdate") % 2 == 0
    own = [F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("round_type"),
           F.when(F.col("o_orderstatus") == "O", (F.col("o_custkey") % 9).cast("int")).alias("score1")]
    write_parquet(o.filter(even).select(*base, *own), path, mode="append", partition_by=("season",))
    write_parquet(o.filter(~even).select(*base), path, mode="append", partition_by=("season",))
    return path


def building_mixed(spark: SparkSession, sf_dir: str) -> str:
    """A building zone whose season partitions hold W2- and W3-shaped files, plus COUNTRIES."""
    from zoneflow.operators.matches import clean_match_dates, clean_match_scores
    from zoneflow.sources.seasons import read_season_table

    base = scratch_dir(spark, "building")
    dates = clean_match_dates(read_season_table(spark, raw_match_dates(spark, sf_dir)))
    scores = clean_match_scores(read_season_table(spark, raw_match_scores(spark, sf_dir)))
    write_parquet(dates.withColumn("source", F.lit("dates")), base, partition_by=("season",))
    write_parquet(scores.withColumn("origin", F.lit("scores")), base, mode="append", partition_by=("season",))
    write_parquet(table(spark, sf_dir, "nation"), f"{base}/COUNTRIES")
    return base


def landing_teams(spark: SparkSession, sf_dir: str) -> str:
    """TEAMS landing folder: supplier standings as CSV, customer teams as JSON, a decoy."""
    base = scratch_dir(spark, "landing-teams")
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    standing = s.select(
        k.cast("int").alias("idx"),
        F.concat(F.lit("FC "), letters(k)).alias("team"),
        F.col("s_nationkey").alias("m"),
        (k % 10).cast("int").alias("w"),
        (F.col("s_nationkey") % 3).alias("d"),
        F.lit(1).alias("l"),
        F.concat(F.col("s_nationkey").cast("string"), F.lit("-"), (k % 7).cast("string")).alias("g"),
        (F.col("s_nationkey") - (k % 7)).cast("int").alias("dif"),
        ((k % 10) * 3 + F.col("s_nationkey") % 3).cast("int").alias("pt"))
    write_csv(standing, f"{base}/standings")
    c = table(spark, sf_dir, "customer")
    teams = c.select(
        F.col("c_custkey").alias("key"),
        F.concat(letters("c_custkey"), F.lit(" Club")).alias("name"),
        (F.lit(1900) + F.col("c_nationkey")).cast("bigint").alias("founded"),
        F.col("c_mktsegment").alias("status"),
        F.struct(F.col("c_name").alias("first_name"), letters("c_nationkey").alias("last_name"),
                 F.col("c_nationkey").cast("string").alias("nationality"),
                 F.lit("1970-01-01").alias("date_of_birth")).alias("coach"))
    write_json_arrays(teams, f"{base}/clubs", "key")
    nation = table(spark, sf_dir, "nation")
    nation.select(F.col("n_name").alias("value")).write.mode("overwrite").text(f"{base}/standings_notes")
    return base


def landing_team_files(spark: SparkSession, sf_dir: str) -> str:
    """TEAMS landing folder of several files whose paths interleave CSV and JSON, with repeated and
    missing names, further JSON columns, a year as text, and a broken JSON file."""
    base = scratch_dir(spark, "landing-team-files")
    s, c = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    k = F.col("s_suppkey")

    def standing(rows: DataFrame, matches: Column, wins: Column) -> DataFrame:
        return rows.select(
            k.cast("int").alias("idx"), F.when(k % 5 != 0, F.concat(F.lit("FC "), letters(k))).alias("team"),
            matches.cast("int").alias("m"), wins.cast("int").alias("w"), F.lit(2).alias("d"), F.lit(1).alias("l"),
            F.lit("1-1").alias("g"), F.lit(0).alias("dif"), F.lit(9).alias("pt"))

    # a-csv: every supplier twice in a file, the second row with more gaps; c-csv: other wins, no gaps
    twice = s.withColumn("again", F.explode(F.array(F.lit(False), F.lit(True))))
    write_csv(standing(twice, F.when(~F.col("again") & (k % 3 != 0), F.col("s_nationkey")),
                       F.when(F.col("again"), F.lit(99)).otherwise(k % 10)), f"{base}/a-csv")
    write_csv(standing(s, F.lit(77), k % 10 + 50), f"{base}/c-csv")
    clubs = c.select(F.col("c_custkey").alias("key"), letters("c_custkey").alias("name"),
                     (F.lit(1900) + F.col("c_nationkey")).cast("string").alias("founded"), F.col("c_custkey").alias("wins"),
                     F.concat(F.lit("Arena "), F.col("c_nationkey").cast("string")).alias("stadium"))
    write_json_arrays(clubs, f"{base}/b-json", "key")
    table(spark, sf_dir, "nation").select(F.concat(F.lit('{"name": "x", '), F.col("n_name")).alias("value")).coalesce(1) \
        .write.text(f"{base}/d-broken")
    fs, root = filesystem(spark, f"{base}/d-broken")
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.globStatus(hpath(root, "*.txt")):
        fs.rename(status.getPath(), hpath(root, "broken.json"))
    return base


def raw_team_goals(spark: SparkSession, sf_dir: str) -> str:
    """Raw TEAMS table for W7: per supplier ``total_goals`` = "quantity-lines"."""
    path = scratch_dir(spark, "raw-team-goals")
    li = table(spark, sf_dir, "lineitem")
    df = li.groupBy("l_suppkey").agg(
        F.sum("l_quantity").cast("bigint").alias("_q"), F.count(F.lit(1)).alias("_n"))
    df = df.select(
        F.col("l_suppkey").cast("int").alias("index"), letters("l_suppkey").alias("name"),
        F.concat(F.col("_q").cast("string"), F.lit("-"), F.col("_n").cast("string")).alias("total_goals"))
    return write_parquet(df, path)


def landing_mixed(spark: SparkSession, df: DataFrame, key: str, base: str) -> str:
    """Half of ``df`` as CSV, the other half as JSON arrays (split by key parity), plus a decoy."""
    even = F.coalesce(F.pmod(F.col(key), F.lit(2)) == 0, F.lit(True))  # every row is in one of the halves
    write_csv(df.filter(even), f"{base}/part_a")
    write_json_arrays(df.filter(~even), f"{base}/part_b/nested", key)
    df.select(F.col(df.columns[1]).cast("string").alias("value")).write.mode("overwrite").text(f"{base}/notes")
    return base


def landing_countries(spark: SparkSession, sf_dir: str) -> str:
    """COUNTRIES landing folder from supplier rows (CSV + JSON halves)."""
    return landing_mixed(spark, table(spark, sf_dir, "supplier"), "s_suppkey", scratch_dir(spark, "landing-countries"))


def landing_countries_typed(spark: SparkSession, sf_dir: str, broken: bool) -> str:
    """COUNTRIES landing folder: JSON with numbers and a nested value; ``broken`` adds CSV rows and a broken file."""
    base = scratch_dir(spark, "landing-countries-typed")
    s = table(spark, sf_dir, "supplier")
    rows = s.select("s_suppkey", "s_name", "s_acctbal", F.struct(F.col("s_nationkey").alias("nation")).alias("place"))
    write_json_arrays(rows, f"{base}/json", "s_suppkey")
    if broken:
        write_csv(s.select("s_suppkey", "s_name", F.lit("csv").alias("origin")), f"{base}/csv")
        s.select(F.concat(F.lit("[{"), F.col("s_name")).alias("value")).coalesce(1).write.text(f"{base}/broken")
        fs, root = filesystem(spark, f"{base}/broken")
        hpath = spark._jvm.org.apache.hadoop.fs.Path
        for status in fs.globStatus(hpath(root, "*.txt")):
            fs.rename(status.getPath(), hpath(root, "broken.json"))
    return base


def raw_general(spark: SparkSession, sf_dir: str) -> str:
    """Raw general-data zone: TEAMS (customer) and COUNTRIES (supplier) mixed folders."""
    base = scratch_dir(spark, "raw-general")
    landing_mixed(spark, table(spark, sf_dir, "customer"), "c_custkey", f"{base}/TEAMS")
    landing_mixed(spark, table(spark, sf_dir, "supplier"), "s_suppkey", f"{base}/COUNTRIES")
    return base


def raw_countries(spark: SparkSession, sf_dir: str) -> str:
    """Raw countries parquet for W9: ``id``, ``fifa_name`` and attributes."""
    path = scratch_dir(spark, "raw-countries")
    s = table(spark, sf_dir, "supplier")
    df = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("fifa_name"),
                  F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return write_parquet(df, path)


__all__ = [
    "EXCLUDED_SEASON", "REPLACED_SEASON", "add_landing_noise", "building_conflicting", "building_mixed",
    "land_by_season", "landing_countries", "landing_countries_typed", "landing_layouts", "landing_mixed", "landing_orders",
    "landing_team_files", "landing_teams", "letters", "match_frame", "orders_by_season", "pick_team", "raw_countries",
    "raw_dates_by_layout", "raw_general", "raw_scores_by_layout",
    "raw_match_dates", "raw_match_scores", "raw_match_teams", "raw_team_goals", "season_of",
    "table", "team_pool", "text_date", "write_csv", "write_json_arrays",
]
