"""Match-row transforms of the building zone (the bodies of W2, W3, W4).

Each is a pure ``DataFrame -> DataFrame`` function; the jobs in
``zoneflow.plans.jobs`` add the reads and writes around them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.casts import cast_value
from zoneflow.functions.dates import (
    date_from_text,
    date_from_timestamp,
    day_from_iso,
    week_from_iso,
)
from zoneflow.functions.names import TEAM_SYNONYM_RULES, canonicalize
from zoneflow.functions.scores import backfill_int, null_token_default
from zoneflow.operators.enrich import fill_from_latest_known, fill_with_state
from zoneflow.operators.schema import (
    STANDARD_MATCH_COLUMNS,
    drop_columns,
    resolve,
    standardize_columns,
)
from zoneflow.sources.seasons import SKIPPED_SEASON, exclude_seasons, only_seasons

Has = Callable[[str], Column]


def everywhere(_: str) -> Column:
    """The ``has`` of a frame whose columns are those of all its rows."""
    return F.lit(True)


# --- fixed values ----------------------------------------------------------
DATE_SOURCES = ("datetime", "Date")              # first present wins
DATE_JOB_DROPS = ("∑ft", "matchday", "index")
SCORE_SOURCES = (("team1score", "score1"), ("team2score", "score2"))
# ---------------------------------------------------------------------------


def derive_match_dates(df: DataFrame, has: Has = everywhere) -> DataFrame:
    """P8 + F4-F8: ``dateonly`` from ``datetime`` else from ``Date`` text; then day/week.

    Which source counts is decided by the columns of each row's file (``has``, see ``TableScan.has``;
    without it the frame's columns are those of all rows): the first one present wins, and a row whose file
    has neither keeps its ``dateonly``.  ``day`` and ``week`` derive from the date; a row whose file has no
    source and that has no ``dateonly`` keeps them.  Source columns are matched case-insensitively and
    dropped.  Running the transform again on its own output changes nothing.
    """
    stamp, text = (resolve(df, c) for c in DATE_SOURCES)
    only, types = resolve(df, "dateonly"), dict(df.dtypes)
    dated = None
    for source, parse in ((only, None), (text, date_from_text), (stamp, date_from_timestamp)):  # the last one wins
        if source is not None:
            value = F.col(f"`{source}`") if parse is None else parse(F.col(f"`{source}`"))
            dated = F.when(has(source), value).otherwise(F.lit(None) if dated is None else dated)
    if dated is None:
        return df
    known = F.col("_dated").isNotNull()
    for source in (stamp, text):
        if source is not None:
            known = known | has(source)
    out = df.withColumn("_dated", dated).withColumn("_known", known)
    derived = {"dateonly": F.col("_dated")}
    for name, made, kind in (("day", day_from_iso("_dated"), "string"), ("week", week_from_iso("_dated"), "int")):
        have = resolve(df, name)
        kept = F.lit(None).cast(kind) if have is None else cast_value(F.col(f"`{have}`"), types[have], kind)
        derived[name] = F.when(F.col("_known"), made).otherwise(kept)
    out = out.withColumns(derived)
    return out.drop("_dated", "_known", *(c for c in (stamp, text) if c is not None))


def clean_match_dates(df: DataFrame, columns: Sequence[tuple[str, str]] = STANDARD_MATCH_COLUMNS,
                      has: Has = everywhere) -> DataFrame:
    """W2 body: dates, drop helper columns, conform to the standard columns."""
    return standardize_columns(drop_columns(derive_match_dates(df, has), *DATE_JOB_DROPS), columns)


def clean_match_scores(df: DataFrame, columns: Sequence[tuple[str, str]] = STANDARD_MATCH_COLUMNS,
                       has: Has = everywhere) -> DataFrame:
    """W3 body: back-fill scores, ints, default round type, standard columns.

    The round type gets its default where the row's file has the column.
    """
    for target, source in SCORE_SOURCES:
        src, tgt = resolve(df, source), resolve(df, target)
        types = dict(df.dtypes)
        if src is not None:
            fallback = F.col(f"`{tgt}`") if tgt is not None else None
            filled = backfill_int(F.col(f"`{src}`"), fallback, types[src], types.get(tgt, "string"))
            df = df.withColumn(target, filled).drop(src)
        elif tgt is not None:
            df = df.withColumn(tgt, cast_value(F.col(f"`{tgt}`"), types[tgt], "int"))
    if resolve(df, "round_type") is not None:
        df = df.withColumn("round_type", F.when(has("round_type"), null_token_default("round_type"))
                           .otherwise(F.col("round_type")))
    return standardize_columns(df, columns)


def enrich_matches(df: DataFrame, skip_seasons: Iterable[str] = (SKIPPED_SEASON,),
                   rules: Iterable[tuple[str, str]] = TEAM_SYNONYM_RULES,
                   team: str = "team_name_1", country: str = "country_1", season: str = "season") -> DataFrame:
    """W4 body: canonical team names, then countries filled from earlier knowledge.

    Rows of skipped seasons pass through untouched and teach nothing; rows without a
    season are not skipped.
    """
    skip = list(skip_seasons)
    work = exclude_seasons(df, *skip, column=season)
    work = work.withColumn(team, canonicalize(team, rules))
    work = fill_from_latest_known(work, team, country, season)
    if not skip:
        return work
    return work.unionByName(only_seasons(df, *skip, column=season))


def enrich_matches_incremental(df: DataFrame, state: DataFrame | None,
                               rules: Iterable[tuple[str, str]] = TEAM_SYNONYM_RULES,
                               team: str = "team_name_1", country: str = "country_1",
                               season: str = "season") -> tuple[DataFrame, DataFrame]:
    """W4 body for new seasons only: synonyms, then the fill from carried team knowledge.

    Returns ``(enriched_rows, new_state)``; ``state`` is the previous run's
    ``new_state`` (one row per team) or ``None`` for the first run.
    """
    work = df.withColumn(team, canonicalize(team, rules))
    return fill_with_state(work, state, team, country, season)
