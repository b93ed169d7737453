"""Query catalogue over the driver tables: one entry per operator / job.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Queries that exercise scans or sinks first build their input zone
(below the shared checkpoint folder) and then read the written data back, so
the result can be compared with plain SQL over the source tables
(``ORACLES``, DuckDB dialect).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from zoneflow.functions import (
    canonicalize,
    canonicalize_by_join,
    close_rules,
    date_from_text,
    date_from_timestamp,
    day_from_iso,
    day_from_text,
    normalize_name,
    null_token_default,
    pair_part,
    week_from_iso,
    week_from_text,
)
from zoneflow.functions.scores import backfill_int
from zoneflow.operators import (
    STANDARD_MATCH_COLUMNS,
    align_to_schema,
    drop_columns,
    fill_from_knowledge,
    fill_from_latest_known,
    flatten_struct,
    known_pairs,
    latest_known_value,
    merge_grouped,
    merge_stored,
    period_knowledge,
    rename_columns,
    row_counts,
    standardize_columns,
    store_by_key,
    unify_schemas,
    union_by_name_lenient,
    union_by_name_strict,
)
from zoneflow.operators.matches import derive_match_dates
from zoneflow.plans import jobs, standins
from zoneflow.plans.standins import EXCLUDED_SEASON, REPLACED_SEASON, letters, season_of, table
from zoneflow.session import scratch_dir
from zoneflow.streaming import incremental_landing_to_raw
from zoneflow.sinks import (
    append_parquet,
    export_single_csv,
    page_document,
    preview_rows,
    replace_partitions,
    write_if_nonempty,
    write_json_rows,
    write_parquet,
    write_single_parquet,
)
from zoneflow.sources import (
    catalog_select_all,
    exclude_seasons,
    read_csv_quoted,
    read_csv_strings,
    read_csv_with_schema,
    read_json_arrays,
    read_json_multiline,
    read_mixed_format,
    read_parquet,
    read_parquet_recursive_merged,
    read_season_table,
    register_table,
    row_counts_from_footers,
    season_folder_scan,
    season_partitions,
    tolerant_scan,
)

from zoneflow.sources.json_arrays import SOURCE_FILE

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType())])
SUPPLIER_SCHEMA = StructType([
    StructField("s_suppkey", LongType()), StructField("s_name", StringType()),
    StructField("s_nationkey", IntegerType()), StructField("s_acctbal", DoubleType())])


def _entities(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three sources keyed by a shared ``name``, with gaps in the shared columns."""
    c = table(spark, sf, "customer")
    s = table(spark, sf, "supplier")
    p = table(spark, sf, "part")
    cust = c.select(
        letters("c_custkey").alias("name"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nationkey"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    supp = s.select(letters("s_suppkey").alias("name"), F.col("s_nationkey").alias("nationkey"),
                    F.col("s_acctbal").alias("balance"))
    part = p.select(letters("p_partkey").alias("name"), F.col("p_retailprice").alias("balance"),
                    F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    return cust, supp, part


def _cust_supp(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    return c, s


# -- scans ---------------------------------------------------------------------

def q_season_folder_scan(spark, sf):
    return row_counts(season_folder_scan(spark, standins.landing_orders(spark, sf)), "season")


def q_season_exclude(spark, sf):
    df = read_season_table(spark, standins.orders_by_season(spark, sf))
    return exclude_seasons(df.withColumn("season", F.col("season").cast("string")), EXCLUDED_SEASON)


def q_csv_scan_strings(spark, sf):
    path = scratch_dir(spark, "csv-strings")
    standins.write_csv(table(spark, sf, "customer"), f"{path}/nested/deeper")
    return read_csv_strings(spark, path)


def q_csv_scan_schema(spark, sf):
    path = scratch_dir(spark, "csv-schema")
    s = table(spark, sf, "supplier")
    # header names differ from the schema: the schema is positional
    standins.write_csv(s.toDF("col_a", "col_b", "col_c", "col_d"), path)
    return read_csv_with_schema(spark, path, SUPPLIER_SCHEMA)


def q_json_multiline_scan(spark, sf):
    path = scratch_dir(spark, "json-multiline")
    standins.write_json_arrays(table(spark, sf, "customer"), path, "c_custkey")
    return read_json_multiline(spark, path, CUSTOMER_SCHEMA)


def q_json_arrays_split(spark, sf):
    """O6 with arrays cut by byte ranges, so that a large file is read by many tasks."""
    path = scratch_dir(spark, "json-arrays")
    standins.write_json_arrays(table(spark, sf, "customer"), path, "c_custkey")
    return read_json_arrays(spark, path, CUSTOMER_SCHEMA, "*.json")[0].drop(SOURCE_FILE)


def q_parquet_scan(spark, sf):
    return read_parquet(spark, f"{sf.rstrip('/')}/part.parquet")


def q_parquet_recursive_merge(spark, sf):
    base = scratch_dir(spark, "recursive")
    c, s = _cust_supp(spark, sf)
    write_parquet(c, f"{base}/a/x")
    write_parquet(s, f"{base}/b")
    return read_parquet_recursive_merged(spark, base)


def q_parquet_merge_conflicting_types(spark, sf):
    """O8 where files hold a column as number or text, and another as whole or broken number."""
    base = scratch_dir(spark, "conflicting")
    c = table(spark, sf, "customer")
    even = F.coalesce(F.pmod("c_custkey", F.lit(2)) == 0, F.lit(True))
    write_parquet(c.filter(even).select("c_custkey", "c_nationkey", "c_acctbal"), f"{base}/a")
    write_parquet(c.filter(~even).select("c_custkey", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("c_nationkey"),
                                         F.floor("c_acctbal").cast("bigint").alias("c_acctbal"), "c_mktsegment"), f"{base}/b/nested")
    return read_parquet_recursive_merged(spark, base)


def q_mixed_format_scan(spark, sf):
    base = standins.landing_mixed(spark, table(spark, sf, "customer"), "c_custkey", scratch_dir(spark, "mixed"))
    csv_df, json_df = read_mixed_format(spark, base, csv_schema=CUSTOMER_SCHEMA, json_schema=CUSTOMER_SCHEMA)
    return csv_df.unionByName(json_df)


def q_tolerant_scan(spark, sf):
    path = scratch_dir(spark, "tolerant")
    s = table(spark, sf, "supplier")
    standins.write_csv(s, path)
    junk = s.select(F.concat(F.col("s_suppkey").cast("string"), F.lit(",broken,not-a-number,"),
                             F.col("s_acctbal").cast("string")).alias("value"))
    junk.write.mode("append").text(path)
    good, _bad = tolerant_scan(spark, path, SUPPLIER_SCHEMA)
    return good


def q_catalog_select_all(spark, sf):
    register_table(table(spark, sf, "customer"), "zf_customer")
    return catalog_select_all(spark, "zf_customer")


# -- sinks -----------------------------------------------------------------------

def q_parquet_overwrite(spark, sf):
    path = scratch_dir(spark, "overwrite")
    write_parquet(table(spark, sf, "customer"), path)
    write_parquet(table(spark, sf, "orders"), path)
    return read_parquet(spark, path)


def q_parquet_append(spark, sf):
    path = scratch_dir(spark, "append")
    write_parquet(table(spark, sf, "customer"), path)
    append_parquet(table(spark, sf, "customer"), path)
    return read_parquet(spark, path)


def q_single_file_parquet(spark, sf):
    path = write_single_parquet(table(spark, sf, "supplier"), scratch_dir(spark, "single-parquet"))
    return read_parquet(spark, path)


def q_single_csv_export(spark, sf):
    path = export_single_csv(table(spark, sf, "supplier"), scratch_dir(spark, "single-csv"))
    return read_csv_strings(spark, path)


def q_single_csv_export_text(spark, sf):
    """K6 on whole texts: line breaks, quotes, blanks and empty strings read back as they were."""
    path = export_single_csv(table(spark, sf, "documents"), scratch_dir(spark, "single-csv-text"))
    return read_csv_quoted(spark, path)


def q_season_partition_overwrite(spark, sf):
    path = standins.orders_by_season(spark, sf)
    orders = table(spark, sf, "orders").withColumn("season", season_of("o_orderdate"))
    doubled = (orders.filter(F.col("season") == REPLACED_SEASON)
               .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    replace_partitions(doubled, path, ("season",))
    return read_season_table(spark, path).withColumn("season", F.col("season").cast("string"))


def q_write_if_nonempty(spark, sf):
    path = scratch_dir(spark, "nonempty")
    orders = table(spark, sf, "orders")
    skipped = write_if_nonempty(orders.filter(F.col("o_orderkey") < 0), write_parquet, f"{path}/empty")
    assert skipped is None
    write_if_nonempty(orders, write_parquet, f"{path}/full")
    return read_parquet(spark, f"{path}/full")


def q_json_rows_export(spark, sf):
    path = write_json_rows(table(spark, sf, "supplier"), scratch_dir(spark, "json-rows"))
    return spark.read.text(path).withColumnRenamed("value", "data")


def q_serve_page_document(spark, sf):
    """Two pages of the table, the second from where the first one ends (the page size is the feature)."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    first = page_document(rows, "c_custkey", 50)
    second = page_document(rows, "c_custkey", 50, after=first.first()["next"])
    return first.withColumn("page", F.lit(1)).unionByName(second.withColumn("page", F.lit(2)))


def q_preview_rows(spark, sf):
    return preview_rows(table(spark, sf, "customer"), "c_custkey", 5)


# -- projections and schema --------------------------------------------------------

def q_rename_columns(spark, sf):
    return rename_columns(table(spark, sf, "customer"),
                          {"c_name": "name", "C_ACCTBAL": "balance", "c_missing": "never"})


def q_drop_columns(spark, sf):
    return drop_columns(table(spark, sf, "customer"), "c_mktsegment", "C_NATIONKEY", "c_missing")


def q_standardize_columns(spark, sf):
    return standardize_columns(table(spark, sf, "orders"), STANDARD_MATCH_COLUMNS)


def q_align_to_schema(spark, sf):
    p = table(spark, sf, "part")
    text_size = F.when(F.col("p_size") > 40, F.concat(F.col("p_size").cast("string"), F.lit("x"))) \
                 .otherwise(F.col("p_size").cast("string"))
    df = p.select("p_partkey", "p_name", text_size.alias("p_size"))
    return align_to_schema(df, {"p_partkey": "bigint", "p_size": "int", "p_container": "string"})


def q_unify_schemas(spark, sf):
    return union_by_name_strict(unify_schemas(list(_cust_supp(spark, sf))))


def q_union_by_name_lenient(spark, sf):
    return union_by_name_lenient(list(_cust_supp(spark, sf)))


def q_union_by_name_strict(spark, sf):
    c = table(spark, sf, "customer")
    return union_by_name_strict([c, c.select(*reversed(c.columns))])


def q_flatten_struct(spark, sf):
    e = table(spark, sf, "events")
    df = e.select("event_id", F.from_json("props", "k int, z string").alias("props"))
    return flatten_struct(df, "props", ("k", "z", "w"))


def q_date_from_first_source(spark, sf):
    o = table(spark, sf, "orders")
    both = o.select(F.lit("both").alias("src"), "o_orderkey",
                    F.col("o_orderdate").cast("string").alias("datetime"),
                    standins.text_date("o_orderdate").alias("Date"))
    text_only = o.select(F.lit("text").alias("src"), "o_orderkey",
                         standins.text_date("o_orderdate").alias("date"))
    keep = ["src", "o_orderkey", "dateonly", "day", "week"]
    return derive_match_dates(both).select(*keep).unionByName(derive_match_dates(text_only).select(*keep))


def q_date_from_timestamp(spark, sf):
    e = table(spark, sf, "events")
    d = e.select("event_id", date_from_timestamp(F.col("ts").cast("string")).alias("dateonly"))
    return d.select("event_id", "dateonly", day_from_iso("dateonly").alias("day"), week_from_iso("dateonly").alias("week"))


def q_date_from_text(spark, sf):
    o = table(spark, sf, "orders")
    d = o.select("o_orderkey", date_from_text(standins.text_date("o_orderdate")).alias("dateonly"))
    return d.select("o_orderkey", "dateonly", day_from_iso("dateonly").alias("day"), week_from_iso("dateonly").alias("week"))


def _parts_text():
    t = F.col("o_orderdate")
    day = F.concat(F.lit("("), F.date_format(t, "EEE"), F.lit(")"))
    week = F.concat(F.lit("(W"), F.weekofyear(t).cast("string"), F.lit(")"))
    body = F.date_format(t, "d MMM yyyy")
    return F.when(F.col("o_orderstatus") == "F", F.concat_ws(" ", week, day, body)) \
            .otherwise(F.concat_ws(" ", day, body, week))


def q_date_text_parts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _parts_text().alias("txt"))
    return o.select("o_orderkey", day_from_text("txt").alias("day_txt"), week_from_text("txt").alias("week_txt"))


# -- scalar functions ----------------------------------------------------------------

def q_normalize_name(spark, sf):
    p = table(spark, sf, "part")
    raw = F.concat_ws(" ", F.lit("FC"), F.col("p_name"), F.lit("de la"), F.col("p_brand"), F.col("p_type"), F.lit("Club 04"))
    return p.select("p_partkey", normalize_name(raw).alias("name"))


def q_normalize_name_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", normalize_name("text").alias("name"))


def q_synonym_canonicalize(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", standins.pick_team("c_custkey").alias("team"))
    return c.select("c_custkey", "team", canonicalize("team").alias("canonical"))


def q_synonym_rules_closed(spark, sf):
    """Ordered rules that are data (one per order), closed into a lookup table and joined."""
    o = table(spark, sf, "orders")
    rules = o.select(F.col("o_orderkey").alias("position"), F.concat(F.lit("v"), (F.col("o_custkey") % 997).cast("string")).alias("source"),
                     F.concat(F.lit("v"), (F.col("o_orderkey") * 31 % 1009).cast("string")).alias("target"))
    c = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("v"), (F.col("c_custkey") % 1200).cast("string")).alias("team"))
    return canonicalize_by_join(c, "team", close_rules(rules))


def q_split_pair_to_ints(spark, sf):
    o = table(spark, sf, "orders")
    a = (o.o_custkey % 10).cast("string")
    b = (o.o_orderkey % 7).cast("string")
    goals = (F.when(o.o_orderstatus == "F", F.concat(a, F.lit("-"), b))
             .when(o.o_orderstatus == "O", a)
             .otherwise(F.concat(F.lit("-"), a, F.lit("-"), b)))
    return o.select("o_orderkey",
                    pair_part("o_orderpriority", 0).alias("prio_1"), pair_part("o_orderpriority", 1).alias("prio_2"),
                    pair_part(goals, 0).alias("scored"), pair_part(goals, 1).alias("against"))


def q_score_backfill(spark, sf):
    li = table(spark, sf, "lineitem")
    score1 = F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(F.col("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber",
                     backfill_int(score1, F.col("l_quantity").cast("int").cast("string"), "int", "string")
                     .alias("team1score"),
                     backfill_int(F.lit(None).cast("string"), F.col("l_suppkey") % 10, "string", "bigint")
                     .alias("team2score"))


def q_null_token_default(spark, sf):
    o = table(spark, sf, "orders")
    rt = (F.when(o.o_orderstatus == "P", F.lit(None)).when(o.o_orderstatus == "F", F.lit("NA"))
          .otherwise(o.o_orderpriority))
    return o.select("o_orderkey", null_token_default(rt).alias("round_type"))


# -- aggregates, merge, fill --------------------------------------------------------------

def q_known_pairs(spark, sf):
    return known_pairs(standins.match_frame(spark, sf), "team_name_1", "country_1")


def q_latest_known_value(spark, sf):
    return latest_known_value(standins.match_frame(spark, sf), "team_name_1", "country_1", "season")


def q_season_row_counts(spark, sf):
    """Rows with a date per season of the cleaned table, counted from file footers."""
    return row_counts_from_footers(spark, _dated_building(spark, sf), "season", filled="dateonly").withColumn(
        "season", F.col("season").cast("string"))


def q_outer_merge_first_non_null(spark, sf):
    """The join form of the merge: sources stored in buckets of their key, then joined without an exchange."""
    path = scratch_dir(spark, "stored-by-key")
    name = f"zf_{path.rsplit('-', 1)[-1]}"
    return merge_stored(store_by_key(list(_entities(spark, sf)), "name", path, name, buckets=16), "name")


def q_outer_merge_grouped(spark, sf):
    return merge_grouped(list(_entities(spark, sf)), "name")


def q_outer_merge_duplicates(spark, sf):
    """Sources with repeated and missing names: whole rows per source, first non-null across them."""
    p = table(spark, sf, "part")
    name = F.when(F.col("p_size") % 10 != 0, letters("p_size"))
    first = p.select(name.alias("name"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("brand"),
                     F.col("p_retailprice").alias("price"))
    second = p.select(name.alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("container"))
    return merge_grouped([first, second], "name")


def q_lookup_fill_asof(spark, sf):
    return fill_from_latest_known(standins.match_frame(spark, sf), "team_name_1", "country_1", "season")


def q_lookup_fill_asof_window(spark, sf):
    """The fill from a table of what each season knows of each team, which late seasons can change."""
    rows = standins.match_frame(spark, sf)
    knowledge = period_knowledge(rows, "team_name_1", "country_1", "season")
    return fill_from_knowledge(rows, knowledge, "team_name_1", "country_1", "season")


# -- jobs ------------------------------------------------------------------------------------

def q_pipe_season_raw(spark, sf):
    raw = scratch_dir(spark, "raw")
    jobs.landing_to_raw(spark, standins.landing_orders(spark, sf), raw)
    return read_season_table(spark, raw).withColumn("season", F.col("season").cast("string"))


def q_pipe_season_raw_layouts(spark, sf):
    """W1 over files that differ in their columns within a season, and how many records did not fit their header."""
    raw = scratch_dir(spark, "raw-layouts")
    jobs.landing_to_raw(spark, standins.landing_layouts(spark, sf), raw)
    rejected = read_parquet(spark, f"{raw}_rejects").groupBy("season").agg(F.count(F.lit(1)).cast("int").alias("rejected"))
    rows = read_season_table(spark, raw).withColumn("season", F.col("season").cast("string"))
    return rows.join(rejected.withColumn("season", F.col("season").cast("string")), "season", "left")


def q_pipe_season_raw_changed(spark, sf):
    """W1 run twice for changed seasons only: between the runs one season's files are replaced."""
    landing, raw = standins.landing_orders(spark, sf), scratch_dir(spark, "raw-changed")
    jobs.landing_to_raw(spark, landing, raw, only_changed=True)
    orders = table(spark, sf, "orders").withColumn("season", season_of("o_orderdate")).filter(F.col("season") == REPLACED_SEASON)
    standins.write_csv(orders.drop("season").withColumn("o_orderstatus", F.lit("X")), f"{landing}/{REPLACED_SEASON}/batch")
    jobs.landing_to_raw(spark, landing, raw, only_changed=True)
    return read_season_table(spark, raw).withColumn("season", F.col("season").cast("string"))


def q_pipe_match_dates(spark, sf):
    dst = scratch_dir(spark, "building-dates")
    jobs.match_dates_job(spark, standins.raw_match_dates(spark, sf), dst)
    return read_season_table(spark, dst).withColumn("season", F.col("season").cast("string"))


def q_pipe_match_scores(spark, sf):
    dst = scratch_dir(spark, "building-scores")
    jobs.match_scores_job(spark, standins.raw_match_scores(spark, sf), dst)
    return read_season_table(spark, dst).withColumn("season", F.col("season").cast("string"))


def q_pipe_match_dates_mixed_layouts(spark, sf):
    dst = scratch_dir(spark, "building-dates-layouts")
    jobs.match_dates_job(spark, standins.raw_dates_by_layout(spark, sf), dst)
    return read_season_table(spark, dst).select("comments", "dateonly", "day", "week", F.col("season").cast("string"))


def q_pipe_match_scores_mixed_layouts(spark, sf):
    dst = scratch_dir(spark, "building-scores-layouts")
    jobs.match_scores_job(spark, standins.raw_scores_by_layout(spark, sf), dst)
    return read_season_table(spark, dst).select("comments", "team1score", "round_type", F.col("season").cast("string"))


def q_pipe_match_enrich(spark, sf):
    dst = scratch_dir(spark, "building-enriched")
    jobs.match_enrich_job(spark, standins.raw_match_teams(spark, sf), dst, skip_seasons=(EXCLUDED_SEASON,))
    return read_season_table(spark, dst).withColumn("season", F.col("season").cast("string"))


def q_pipe_match_enrich_incremental(spark, sf):
    """W4 run twice on consecutive halves of the seasons, carrying the team state."""
    src = standins.raw_match_teams(spark, sf)
    dst = scratch_dir(spark, "building-enriched-incremental")
    seasons = season_partitions(spark, src)
    half = len(seasons) // 2
    first_state = scratch_dir(spark, "team-state")
    jobs.match_enrich_incremental_job(spark, src, dst, seasons[:half], None, first_state)
    jobs.match_enrich_incremental_job(spark, src, dst, seasons[half:], first_state, scratch_dir(spark, "team-state"))
    return read_season_table(spark, dst).withColumn("season", F.col("season").cast("string"))


def q_pipe_match_enrich_late(spark, sf):
    """W4 with one season late and another first delivered wrong, then corrected: equal to one run over all."""
    src, dst, knowledge = standins.raw_match_teams(spark, sf), scratch_dir(spark, "building-late"), scratch_dir(spark, "knowledge")
    seasons = season_partitions(spark, src)
    wrong, late = seasons[0], seasons[len(seasons) // 2]
    rows = read_season_table(spark, src)
    right = write_parquet(rows.filter(F.col("season") == wrong), scratch_dir(spark, "right-season"))
    replace_partitions(read_parquet(spark, right).withColumn("country_1", F.lit("WRONG")), src, ("season",))
    jobs.match_enrich_late_job(spark, src, dst, [s for s in seasons if s != late], knowledge)
    replace_partitions(read_parquet(spark, right), src, ("season",))
    jobs.match_enrich_late_job(spark, src, dst, [late], knowledge)
    jobs.match_enrich_late_job(spark, src, dst, [wrong], knowledge)
    return read_season_table(spark, dst).withColumn("season", F.col("season").cast("string"))


def q_pipe_fact_matches(spark, sf):
    master = scratch_dir(spark, "master-facts")
    jobs.fact_matches_job(spark, standins.building_mixed(spark, sf), master)
    return read_parquet(spark, master).withColumn("season", F.col("season").cast("string"))


def q_pipe_teams_raw(spark, sf):
    raw = scratch_dir(spark, "raw-teams-out")
    jobs.teams_to_raw(spark, standins.landing_teams(spark, sf), raw)
    return read_parquet(spark, raw)


def q_pipe_teams_multi_file(spark, sf):
    """W6 over several CSV and JSON files, in path order, one of them broken."""
    raw = scratch_dir(spark, "raw-teams-files")
    jobs.teams_to_raw(spark, standins.landing_team_files(spark, sf), raw)
    return read_parquet(spark, raw).select("name", "index", "matches_played", "wins", "foundation_year", "stadium")


def q_pipe_players_raw(spark, sf):
    """W6 for PLAYERS: the team parser, then the PLAYERS schema (player columns typed null)."""
    raw = scratch_dir(spark, "raw-players-out")
    jobs.teams_to_raw(spark, standins.landing_teams(spark, sf), raw, subject="PLAYERS")
    return read_parquet(spark, raw)


def q_pipe_dim_teams(spark, sf):
    dim = scratch_dir(spark, "dim-teams")
    jobs.teams_to_dim(spark, standins.raw_team_goals(spark, sf), dim)
    return read_parquet(spark, dim)


def q_pipe_countries_raw(spark, sf):
    raw = scratch_dir(spark, "raw-countries-out")
    path = jobs.countries_to_raw(spark, standins.landing_countries(spark, sf), raw)
    return read_parquet(spark, path)


def q_pipe_countries_bad_file(spark, sf):
    """W8 over CSV, JSON and a broken file: the good rows, and how many files were put aside."""
    raw = scratch_dir(spark, "raw-countries-bad")
    path = jobs.countries_to_raw(spark, standins.landing_countries_typed(spark, sf, broken=True), raw)
    rejected = read_parquet(spark, f"{raw}_rejects").count()
    return read_parquet(spark, path).drop("place").withColumn("rejected", F.lit(rejected).cast("int"))


def q_pipe_countries_json_types(spark, sf):
    raw = scratch_dir(spark, "raw-countries-types")
    path = jobs.countries_to_raw(spark, standins.landing_countries_typed(spark, sf, broken=False), raw)
    return read_parquet(spark, path).select("s_suppkey", "s_name", "s_acctbal", F.col("place.nation").alias("nation"))


def q_pipe_dim_countries(spark, sf):
    out = scratch_dir(spark, "building-countries")
    jobs.countries_to_building(spark, standins.raw_countries(spark, sf), out)
    return read_parquet(spark, out)


def q_pipe_general_dims(spark, sf):
    master = scratch_dir(spark, "master-dims")
    written = jobs.general_dims_job(spark, standins.raw_general(spark, sf), master)
    dims = [read_parquet(spark, path).withColumn("dim", F.lit(dim)) for dim, path in sorted(written.items())]
    return union_by_name_lenient(dims)


def q_pipe_all_seasons_csv(spark, sf):
    dest = scratch_dir(spark, "combined-csv")
    jobs.all_seasons_csv_job(spark, standins.orders_by_season(spark, sf), dest)
    return read_csv_strings(spark, dest)


def q_pipe_all_seasons_csv_broken(spark, sf):
    """W11 over seasons of differing types with a broken file among them: the export, and how many files were left out."""
    dest = scratch_dir(spark, "combined-csv-broken")
    jobs.all_seasons_csv_job(spark, standins.building_conflicting(spark, sf), dest)
    rejected = read_parquet(spark, f"{dest}_rejects").count()
    return read_csv_strings(spark, dest).withColumn("rejected", F.lit(rejected).cast("int"))


def q_pipe_serve_table(spark, sf):
    register_table(table(spark, sf, "supplier"), "zf_supplier")
    path = jobs.serve_table_job(spark, "zf_supplier", scratch_dir(spark, "served"))
    return spark.read.text(path).withColumnRenamed("value", "data")


def q_stream_season_raw(spark, sf):
    """W1 run incrementally: orders land in two arrivals, each ingested exactly once."""
    base = scratch_dir(spark, "landing-stream")
    raw = scratch_dir(spark, "raw-stream")
    checkpoint = scratch_dir(spark, "raw-stream-checkpoint")
    orders = table(spark, sf, "orders").withColumn("season", season_of("o_orderdate"))
    schema = StructType([StructField(c, StringType()) for c in orders.columns if c != "season"])
    even = F.coalesce(F.pmod("o_orderkey", F.lit(2)) == 0, F.lit(True))
    for arrival, rows in (("arrival-1", orders.filter(even)), ("arrival-2", orders.filter(~even))):
        standins.land_by_season(spark, rows, base, batch=arrival)
        incremental_landing_to_raw(spark, base, raw, schema, checkpoint)
    return read_parquet(spark, raw).withColumn("season", F.col("season").cast("string"))


def _dated_building(spark: SparkSession, sf: str) -> str:
    """Landing CSV seasons -> raw (W1) -> text dates cleaned (W2); returns the cleaned table's path."""
    raw = scratch_dir(spark, "flagship-raw")
    building = scratch_dir(spark, "flagship-building")
    jobs.landing_to_raw(spark, standins.landing_orders(spark, sf, date_column="Date", date_as_text=True), raw)
    jobs.match_dates_job(spark, raw, building)
    return building


def _flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned table's rows with a date, per season."""
    cleaned = read_season_table(spark, _dated_building(spark, sf)).filter(F.col("dateonly").isNotNull())
    return row_counts(cleaned, "season").withColumn("season", F.col("season").cast("string"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagship(spark, sf_dir)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
