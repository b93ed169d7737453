"""Run one zone job with explicit paths: ``python -m zoneflow.plans.cli <job> ...``.

The active SparkSession (spark-submit / cluster) is used when there is one;
otherwise a local session is built.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from zoneflow.plans import jobs
from zoneflow.sources import register_table
from zoneflow.sources.seasons import SKIPPED_SEASON
from zoneflow.streaming import incremental_landing_to_raw


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from zoneflow.session import build_session

    return build_session(master="local[*]")


def _serve(spark: SparkSession, table_path: str, name: str, dest: str) -> str:
    register_table(spark.read.parquet(table_path), name)
    return jobs.serve_table_job(spark, name, dest)


COMMANDS = {
    "landing-to-raw": (jobs.landing_to_raw, ["landing", "raw"]),
    "landing-to-raw-incremental": (incremental_landing_to_raw, ["landing", "raw"]),
    "match-dates": (jobs.match_dates_job, ["src", "dst"]),
    "match-scores": (jobs.match_scores_job, ["src", "dst"]),
    "match-enrich": (jobs.match_enrich_job, ["src", "dst"]),
    "match-enrich-incremental": (jobs.match_enrich_incremental_job, ["src", "dst", "seasons", "state_in", "state_out"]),
    "match-enrich-late": (jobs.match_enrich_late_job, ["src", "dst", "seasons", "knowledge"]),
    "fact-matches": (jobs.fact_matches_job, ["building", "master"]),
    "teams-to-raw": (jobs.teams_to_raw, ["landing_subject", "raw"]),
    "teams-to-dim": (jobs.teams_to_dim, ["raw_teams", "dim"]),
    "countries-to-raw": (jobs.countries_to_raw, ["landing_countries", "raw_countries"]),
    "countries-to-building": (jobs.countries_to_building, ["raw_countries", "building_countries"]),
    "general-dims": (jobs.general_dims_job, ["raw_general", "master"]),
    "all-seasons-csv": (jobs.all_seasons_csv_job, ["building", "dest"]),
    "serve-table": (_serve, ["table_path", "name", "dest"]),
}


ONLY_CHANGED = ("landing-to-raw", "match-dates", "match-scores")
SEASON_LIMITED = ("landing-to-raw", "match-dates", "match-scores", "fact-matches")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="zoneflow")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (_fn, params) in COMMANDS.items():
        p = sub.add_parser(name)
        for param in params:
            p.add_argument(param)
        if name == "match-enrich":
            p.add_argument("--skip-season", action="append", default=None,
                           help=f"season to leave untouched (default {SKIPPED_SEASON})")
        if name == "teams-to-raw":
            p.add_argument("--subject", default="TEAMS", choices=["TEAMS", "PLAYERS"])
        if name in SEASON_LIMITED:
            p.add_argument("--season", action="append", default=None,
                           help="process and replace only this season (repeatable)")
        if name in ONLY_CHANGED:
            p.add_argument("--only-changed", action="store_true", help="leave out seasons whose input files did not change")
    args = parser.parse_args(argv)
    fn, params = COMMANDS[args.command]
    kwargs = {}
    if args.command == "match-enrich" and args.skip_season is not None:
        kwargs["skip_seasons"] = tuple(args.skip_season)
    if args.command == "teams-to-raw":
        kwargs["subject"] = args.subject
    if args.command in SEASON_LIMITED and args.season is not None:
        kwargs["seasons"] = tuple(args.season)
    if args.command in ONLY_CHANGED and args.only_changed:
        kwargs["only_changed"] = True
    values = [getattr(args, p) for p in params]
    if args.command == "match-enrich-late":
        values[2] = [x for x in values[2].split(",") if x]
    if args.command == "match-enrich-incremental":
        # seasons as a comma-separated list; "-" for no previous state
        values[2] = [x for x in values[2].split(",") if x]
        values[3] = None if values[3] == "-" else values[3]
    result = fn(_session(), *values, **kwargs)
    print(json.dumps({"command": args.command, "result": result}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
