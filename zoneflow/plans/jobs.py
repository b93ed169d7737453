"""The zone jobs (W1-W12): landing -> raw -> building -> master, and serving.

Every job takes its paths as arguments and writes once to a location it does not
read.  All seasons are handled by one plan per stage; seasons are Hive partitions so
later stages prune them.  What can't be read -- CSV records that do not fit their header, files that
are no JSON or no parquet -- goes to ``<target>_rejects``, which every run replaces (also by nothing);
the rest is written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from zoneflow.functions.names import TEAM_SYNONYM_RULES, canonicalize, normalize_name
from zoneflow.functions.scores import split_pair_to_ints
from zoneflow.operators.enrich import GAPS, KNOWN, fill_from_knowledge, period_knowledge, periods_that_move
from zoneflow.operators.matches import (
    clean_match_dates,
    clean_match_scores,
    enrich_matches,
    enrich_matches_incremental,
)
from zoneflow.operators.merge import ROWS, duplicate_rows, merge_picked, picked_rows
from zoneflow.operators.schema import (
    COACH_FIELDS,
    STANDING_CSV_SCHEMA,
    STANDING_RENAMES,
    SUBJECT_SCHEMAS,
    align_to_schema,
    drop_columns,
    flatten_struct,
    rename_columns,
    resolve,
    unify_schemas,
    union_by_name_lenient,
    union_by_name_strict,
)
from zoneflow.sinks.writers import (
    export_csv,
    path_exists,
    publish,
    replace_partitions,
    replace_side_table,
    write_if_nonempty,
    write_json_rows,
    write_parquet,
)
from zoneflow.sources.catalog import catalog_select_all
from zoneflow.sources.files import (
    BAD_RECORD_COLUMN,
    RAGGED,
    ragged_records,
    read_csv_by_header,
    read_csv_folder,
    read_json_folder,
    read_mixed_format,
    read_or_none,
    read_parquet,
    split_rejects,
    well_formed,
)
from zoneflow.sources.json_arrays import SOURCE_FILE, read_json_arrays
from zoneflow.sources.manifests import file_path, written
from zoneflow.sources.changes import changed_seasons, note_inputs
from zoneflow.sources.seasons import PATH, SKIPPED_SEASON, read_season_table, season_folder_records, season_folders, season_partitions
from zoneflow.sources.tables import SOURCE_COLUMNS, scan_season_table, untagged

# -- W1 ---------------------------------------------------------------------

def landing_to_raw(spark: SparkSession, landing: str, raw: str, seasons: Iterable[str] | None = None,
                   only_changed: bool = False) -> str | None:
    """Every ``<landing>/<yyyy-yy>/`` CSV folder -> ``<raw>/season=yyyy-yy/`` parquet.

    Only the seasons present in the landing zone (or the given ``seasons``)
    are replaced; nothing is touched when there is no season folder.  Records with more or fewer cells than
    their file's header are counted while the others are written, and listed if there are any.  Where files differ
    in their columns, rows note their own (``tables.SOURCE_COLUMNS``).

    ``only_changed`` leaves out seasons whose files are those of the last such run (``sources.changes``).
    """
    if only_changed:
        folders = {s: p for s, p in season_folders(spark, landing) if seasons is None or s in set(seasons)}
        seasons, inputs = changed_seasons(spark, folders, landing, raw)
        if not seasons:
            return None
    records = season_folder_records(spark, landing, seasons, with_source=True)
    if records is None:
        return None
    seen = Observation()
    counted = records.observe(seen, F.count(RAGGED).alias("ragged"))
    replace_partitions(well_formed(counted.drop(PATH)), raw, ("season",))
    _list_rejects(spark, raw, ragged_records(records.drop(SOURCE_COLUMNS), PATH, "season") if seen.get["ragged"] else None)
    if only_changed:
        note_inputs(spark, inputs, raw)
    return raw


def _list_rejects(spark: SparkSession, target: str, *found: DataFrame | None) -> None:
    """Replace ``<target>_rejects`` by what this run found, also by nothing."""
    rows = [df for df in found if df is not None]
    replace_side_table(spark, union_by_name_lenient(rows) if rows else None, f"{target.rstrip('/')}_rejects")


# -- W2 / W3 / W4 -------------------------------------------------------------

def _stage(spark: SparkSession, src: str, dst: str, transform, seasons: Iterable[str] | None = None,
           tagged: bool = False, only_changed: bool = False) -> str | None:
    """Row-preserving stage: nothing to do when the footers count no row, else one write.

    ``transform(rows, has)`` returns the new rows; with ``tagged``, ``has(column)`` tells of each row whether its file has
    the column.  With ``seasons`` only those folders are listed, read and replaced, so a newly arrived season
    is processed without touching the history; ``only_changed`` leaves out seasons whose files are those of the last
    such run (``sources.changes``).
    """
    if only_changed:
        wanted = None if seasons is None else set(seasons)
        folders = {s: f"{src.rstrip('/')}/season={s}" for s in season_partitions(spark, src) if wanted is None or s in wanted}
        seasons, inputs = changed_seasons(spark, folders, src, dst)
        if not seasons:
            return None
    scan = scan_season_table(spark, src, seasons, tagged)
    if scan is None:
        return None
    _list_rejects(spark, dst, scan.rejects() if scan.broken else None)
    if not scan.n_rows:
        return None
    replace_partitions(untagged(transform(scan.rows, scan.has)), dst, ("season",))
    if only_changed:
        note_inputs(spark, inputs, dst)
    return dst


def match_dates_job(spark: SparkSession, src: str, dst: str, seasons: Iterable[str] | None = None,
                    only_changed: bool = False) -> str | None:
    """Date normalisation + standard columns, season partitions replaced."""
    return _stage(spark, src, dst, lambda df, has: clean_match_dates(df, has=has), seasons, True, only_changed)


def match_scores_job(spark: SparkSession, src: str, dst: str, seasons: Iterable[str] | None = None,
                     only_changed: bool = False) -> str | None:
    """Score back-fill + round type + standard columns."""
    return _stage(spark, src, dst, lambda df, has: clean_match_scores(df, has=has), seasons, True, only_changed)


def match_enrich_job(spark: SparkSession, src: str, dst: str, skip_seasons: Iterable[str] = (SKIPPED_SEASON,),
                     rules: Iterable[tuple[str, str]] = TEAM_SYNONYM_RULES) -> str | None:
    """Team synonyms + country fill over the whole history; skipped seasons copied unchanged.

    For newly arrived seasons use ``match_enrich_incremental_job``.
    """
    return _stage(spark, src, dst, lambda df, _: enrich_matches(df, skip_seasons, rules))


def match_enrich_incremental_job(spark: SparkSession, src: str, dst: str, seasons: Iterable[str],
                                 state_in: str | None, state_out: str,
                                 rules: Iterable[tuple[str, str]] = TEAM_SYNONYM_RULES) -> str | None:
    """W4 for newly arrived seasons only, carrying team knowledge in a small state table.

    Reads just the given season partitions of ``src`` plus ``state_in`` (one
    row per team), replaces those seasons in ``dst`` and writes the next state
    to ``state_out`` -- a different path from ``state_in``, so no plan reads
    what it overwrites.  Seasons must arrive in order; re-running an older
    season after newer ones needs the full ``match_enrich_job``.
    """
    wanted = list(seasons)
    scan = scan_season_table(spark, src, wanted)
    if scan is None or not scan.n_rows:
        return None
    _list_rejects(spark, dst, scan.rejects() if scan.broken else None)
    state = read_parquet(spark, state_in) if state_in else None
    enriched, new_state = enrich_matches_incremental(scan.rows, state, rules)
    replace_partitions(enriched, dst, ("season",))
    write_parquet(new_state, state_out)
    return dst


def match_enrich_late_job(spark: SparkSession, src: str, dst: str, seasons: Iterable[str], knowledge: str,
                          rules: Iterable[tuple[str, str]] = TEAM_SYNONYM_RULES, team: str = "team_name_1",
                          country: str = "country_1") -> list[str]:
    """W4 for seasons that arrive in any order, late or corrected; returns the seasons it rewrote.

    ``knowledge`` is a table with one row per team and season (``period_knowledge``, partitioned by season) that
    this job keeps; a new one is begun where there is none.  The given seasons of ``src`` are read, their knowledge is
    compared with what the table held, and of all other seasons only those are read and rewritten in which
    a fill changes.  The result equals ``match_enrich_job`` over the whole history (no season skipped).

    ``knowledge`` is replaced last: a job that fails half-way is run again with the same seasons.
    """
    wanted = sorted(set(seasons))
    scan = scan_season_table(spark, src, wanted)
    if scan is None or scan.rows is None:
        return []
    season = F.col("season").cast("string").alias("season")

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.withColumns({team: canonicalize(team, rules), "season": season})

    fresh = written(period_knowledge(labelled(scan.rows), team, country, "season"), spark, "late-knowledge")
    before = read_season_table(spark, knowledge) if path_exists(spark, knowledge) else None
    before = fresh.limit(0) if before is None else before.select(team, season, KNOWN, GAPS)
    after = before.filter(~F.col("season").isin(wanted)).unionByName(fresh.select(team, "season", KNOWN, GAPS))
    moved = sorted(r["season"] for r in periods_that_move(before, after, team, "season").collect())  # seasons, not rows
    rewrite = sorted(set(wanted) | set(moved))
    touched = scan if rewrite == wanted else scan_season_table(spark, src, rewrite)
    _list_rejects(spark, dst, touched.rejects() if touched.broken else None)
    replace_partitions(fill_from_knowledge(labelled(touched.rows), after, team, country, "season"), dst, ("season",))
    replace_partitions(fresh, knowledge, ("season",))
    return rewrite


# -- W5 ---------------------------------------------------------------------

def fact_matches_job(spark: SparkSession, building: str, master: str,
                     seasons: Iterable[str] | None = None) -> str | None:
    """All season partitions (unlike column sets merged) -> the fact table.

    Only ``season=`` folders are read; other folders of the zone are not facts.
    A column that seasons hold in different types gets the type they agree on.
    An empty building zone leaves the fact table as it is.  With ``seasons``
    only those partitions of the fact table are replaced.
    """
    scan = scan_season_table(spark, building, seasons)
    if scan is None:
        return None
    _list_rejects(spark, master, scan.rejects() if scan.broken else None)
    if not scan.n_rows:
        return None
    if seasons is not None:
        return replace_partitions(scan.rows, master, ("season",))
    return write_parquet(scan.rows, master, partition_by=("season",))


# -- W6 / W7 ----------------------------------------------------------------

def conform_standing(df: DataFrame, subject: str = "TEAMS") -> DataFrame:
    """Standing CSV rows -> domain names, normalised team name, subject schema."""
    df = rename_columns(df, STANDING_RENAMES)
    return align_to_schema(df.withColumn("name", normalize_name("name")), SUBJECT_SCHEMAS[subject])


def conform_team_json(df: DataFrame, subject: str = "TEAMS") -> DataFrame:
    """Team JSON rows -> flat coach columns, ``foundation_year``, normalised name."""
    df = flatten_struct(df, "coach", COACH_FIELDS)
    df = rename_columns(df, {"founded": "foundation_year"})
    if resolve(df, "name") is not None:
        df = df.withColumn("name", normalize_name("name"))
    return align_to_schema(df, SUBJECT_SCHEMAS[subject])


_FILE = SOURCE_FILE


def teams_to_raw(spark: SparkSession, landing_subject: str, raw: str, subject: str = "TEAMS", split_json: bool = False) -> str | None:
    """CSV standings and JSON team files of one folder merged per team name.

    Every file is a source; files count in the order of their paths, CSV and JSON
    alike, and a column takes the first non-null value in that order.  JSON keeps all its
    columns.  Files that are no JSON go to ``<raw>_rejects``, and so do CSV records with cells that do not fit the
    schema (they are merged with nulls in those places); rows that lost against another row of their name in the
    same file go to ``<raw>_duplicates``.  Nothing is replaced when the folder yields no rows.

    The files are read once: the rows picked per name and file are a work table, which also says whether there
    is anything to list.
    """
    csv_schema = StructType([*STANDING_CSV_SCHEMA.fields, StructField(BAD_RECORD_COLUMN, StringType())])
    csv_df = read_csv_folder(spark, landing_subject, csv_schema, {
        "columnNameOfCorruptRecord": BAD_RECORD_COLUMN, "columnPruning": "false"})
    json_df, rejects = _json_rows(spark, landing_subject, split_json)
    sources, seen, bad_records = [], Observation(), None
    if csv_df is not None:
        tagged = csv_df.select("*", file_path().alias(_FILE))
        cells = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in STANDING_CSV_SCHEMA.fields]))
        bad_records = tagged.filter(F.col(BAD_RECORD_COLUMN).isNotNull()).select(
            F.col(_FILE).alias("path"), F.col(BAD_RECORD_COLUMN).alias("record"), cells.alias("parsed"))
        counted = tagged.observe(seen, F.count(BAD_RECORD_COLUMN).alias("bad"))
        sources.append(conform_standing(counted.drop(BAD_RECORD_COLUMN), "TEAMS"))
    if json_df is not None:
        sources.append(conform_team_json(json_df, "TEAMS"))
    rows = union_by_name_strict(unify_schemas(sources)) if sources else None
    if rows is None or "name" not in rows.columns:
        _list_rejects(spark, raw, rejects)
        return None
    picked = written(picked_rows(rows, "name", _FILE), spark, "picked-teams")
    _list_rejects(spark, raw, rejects, bad_records if csv_df is not None and seen.get["bad"] else None)
    if picked.isEmpty():
        return None
    merged = align_to_schema(merge_picked(picked, "name", _FILE), SUBJECT_SCHEMAS[subject])
    repeated = not picked.filter(F.col(ROWS) > 1).isEmpty()
    replace_side_table(spark, duplicate_rows(rows, "name", _FILE, picked) if repeated else None, f"{raw.rstrip('/')}_duplicates")
    return write_parquet(merged, raw)


def team_dimension(df: DataFrame) -> DataFrame:
    """W7 body: drop ``index``; ``total_goals`` "a-b" -> scored / against ints."""
    df = drop_columns(df, "index")
    goals = resolve(df, "total_goals")
    if goals is None:
        return df.withColumns({"total_goals_scored": F.lit(None).cast("int"),
                               "total_goals_against": F.lit(None).cast("int")})
    scored, against = split_pair_to_ints(F.col(f"`{goals}`"))
    return df.withColumns({"total_goals_scored": scored, "total_goals_against": against})


def teams_to_dim(spark: SparkSession, raw_teams: str, dim: str) -> str | None:
    """Raw teams -> master team dimension (replaced, never appended twice; no rows: left alone)."""
    return write_if_nonempty(team_dimension(read_parquet(spark, raw_teams)), write_parquet, dim)


# -- W8 / W9 / W10 ------------------------------------------------------------

def _json_rows(spark: SparkSession, folder: str, split_json: bool) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of the JSON files of a folder with their file (``SOURCE_FILE``), and what is no JSON.

    ``split_json`` reads large arrays by many tasks (``read_json_arrays``) instead of a task per file.
    """
    if not split_json:
        rows, bad = split_rejects(read_json_folder(spark, folder))
        return (None if rows is None else rows.select("*", file_path().alias(SOURCE_FILE))), bad
    rows, bad = read_json_arrays(spark, folder, pattern="*.json")
    bad = bad.withColumn("parsed", F.lit(None).cast("string"))
    return (rows if SOURCE_FILE in rows.columns else None), bad


def mixed_folder(spark: SparkSession, folder: str, split_json: bool = False) -> tuple[DataFrame | None, DataFrame | None]:
    """``(rows, rejects)`` of the CSV and JSON files of a folder.

    Columns that a file lacks are null, whatever its format.  A column keeps its type when
    all sources agree on it (or all are numbers); otherwise it is text, nested values as
    JSON.  Rejects are the files that are no JSON and the CSV records that do not fit their header.
    """
    records = read_or_none(lambda p: read_csv_by_header(spark, p, "*.csv", {PATH: file_path()}), folder)
    csv_df = None if records is None else well_formed(records.drop(PATH))
    json_df, bad_files = _json_rows(spark, folder, split_json)
    frames = [df for df in (csv_df, None if json_df is None else json_df.drop(SOURCE_FILE)) if df is not None]
    rejects = [df for df in (None if records is None else ragged_records(records, PATH), bad_files) if df is not None]
    return (union_by_name_strict(unify_schemas(frames)) if frames else None), (union_by_name_strict(rejects) if rejects else None)


def countries_to_raw(spark: SparkSession, landing_countries: str, raw_countries: str,
                     one_file: bool = False, split_json: bool = False) -> str | None:
    """Country files -> parquet; unreadable files go to ``<raw_countries>_rejects``."""
    return _publish_folder(spark, landing_countries, raw_countries, one_file, split_json)


def _publish_folder(spark: SparkSession, folder: str, dest: str, one_file: bool, split_json: bool = False) -> str | None:
    rows, rejects = mixed_folder(spark, folder, split_json)
    _list_rejects(spark, dest, rejects)
    return None if rows is None else write_if_nonempty(rows, publish, dest, "parquet", one_file)


def country_dimension(df: DataFrame) -> DataFrame:
    """W9 body: drop ``id``, ``fifa_name`` -> ``country_id``."""
    return rename_columns(drop_columns(df, "id"), {"fifa_name": "country_id"})


def countries_to_building(spark: SparkSession, raw_countries: str, building_countries: str) -> str | None:
    """Raw countries -> building countries (no rows: left alone)."""
    return write_if_nonempty(country_dimension(read_parquet(spark, raw_countries)), write_parquet, building_countries)


GENERAL_DIMENSIONS = (("TEAMS", "DimTeams"), ("COUNTRIES", "DimCountries"))


def general_dims_job(spark: SparkSession, raw_general: str, master: str,
                     subjects: Iterable[tuple[str, str]] = GENERAL_DIMENSIONS, one_file: bool = False) -> dict[str, str]:
    """Each subject folder (mixed files) -> one dimension."""
    written = {}
    for subject, dim in subjects:
        done = _publish_folder(spark, f"{raw_general.rstrip('/')}/{subject}", f"{master.rstrip('/')}/{dim}", one_file)
        if done is not None:
            written[dim] = done
    return written


# -- W11 / W12 ----------------------------------------------------------------

def all_seasons_csv_job(spark: SparkSession, building: str, dest: str, one_file: bool = False) -> str | None:
    """Every season of a building table -> one CSV export with header.

    Seasons may hold a column in different types; files that are no parquet are left out and listed.
    """
    scan = scan_season_table(spark, building)
    if scan is None:
        return None
    _list_rejects(spark, dest, scan.rejects() if scan.broken else None)
    return None if scan.rows is None else export_csv(scan.rows, dest, one_file)


def serve_table_job(spark: SparkSession, table: str, dest: str) -> str:
    """``SELECT * FROM table`` -> JSON rows of text values plus the column list."""
    return write_json_rows(catalog_select_all(spark, table), dest)
