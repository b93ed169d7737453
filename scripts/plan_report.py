"""Physical-plan facts for each job body and operator (initial plan, before AQE re-planning).

Usage: python scripts/plan_report.py [sf_dir]
Prints a markdown table: shuffles, broadcasts, aggregates, windows, sorts and scans per plan.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from zoneflow.functions import canonicalize  # noqa: E402
from zoneflow.operators import (  # noqa: E402
    fill_from_knowledge,
    fill_from_latest_known,
    known_pairs,
    latest_known_value,
    merge_grouped,
    merge_joined,
    merge_stored,
    period_knowledge,
    row_counts,
    store_by_key,
)
from zoneflow.operators.matches import (  # noqa: E402
    clean_match_dates,
    clean_match_scores,
    enrich_matches,
    enrich_matches_incremental,
)
from zoneflow.plans import jobs, queries, standins  # noqa: E402
from zoneflow.session import build_session, scratch_dir  # noqa: E402
from zoneflow.sinks import write_parquet  # noqa: E402
from zoneflow.sources import (  # noqa: E402
    read_mixed_format,
    read_season_table,
    row_counts_from_footers,
    scan_season_table,
    season_folder_scan,
)


def facts(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "shuffle": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"
                         r"|Exchange RoundRobinPartitioning"),
        "broadcast": count(r"BroadcastExchange"),
        "aggregate": count(r"HashAggregate|SortAggregate|ObjectHashAggregate"),
        "window": count(r"\bWindow\b"),
        "sort": count(r"\bSort \["),
        "scan": count(r"FileScan|BatchScan|Scan parquet|Scan csv|Scan json"),
    }


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(**{"spark.sql.adaptive.enabled": "true"})
    landing = standins.landing_orders(spark, sf)
    dates_raw = read_season_table(spark, standins.raw_match_dates(spark, sf))
    scores_raw = read_season_table(spark, standins.raw_match_scores(spark, sf))
    teams_raw = read_season_table(spark, standins.raw_match_teams(spark, sf))
    teams_landing = standins.landing_teams(spark, sf)
    csv_df, json_df = read_mixed_format(spark, teams_landing, csv_schema=jobs.STANDING_CSV_SCHEMA)
    w6 = merge_grouped([jobs.conform_standing(csv_df), jobs.conform_team_json(json_df)], "name")
    match = read_season_table(spark, standins.raw_match_teams(spark, sf))
    state = write_parquet(latest_known_value(teams_raw.filter(F.col("season") < "1999-00"), "team_name_1",
                                             "country_1", "season"), scratch_dir(spark, "plan-report-state"))
    entities = list(queries._entities(spark, sf))
    plans = {
        "W1 landing -> raw, one header (season_folder_scan)": season_folder_scan(spark, landing),
        "W1 landing -> raw, several headers": season_folder_scan(spark, standins.landing_layouts(spark, sf)),
        "O8 parquet of differing types (2 groups)": scan_season_table(spark, standins.building_conflicting(spark, sf)).rows,
        "W2 scan with layouts of single files": scan_season_table(spark, standins.raw_dates_by_layout(spark, sf), tagged=True).rows,
        "W2 dates cleaning": clean_match_dates(dates_raw),
        "W3 scores cleaning": clean_match_scores(scores_raw),
        "W4 synonyms + country fill": enrich_matches(teams_raw),
        "W4 incremental (new seasons + team state)": enrich_matches_incremental(
            teams_raw.filter(F.col("season") >= "1999-00"), spark.read.parquet(state))[0],
        "W6 merge of CSV + JSON teams (grouped)": w6,
        "W7 team dimension": jobs.team_dimension(spark.read.parquet(standins.raw_team_goals(spark, sf))),
        "J1 merge_grouped (3 sources)": merge_grouped(entities),
        "J1 merge_joined (3 sources)": merge_joined(entities),
        "J1 merge_stored (3 sources in buckets)": merge_stored(store_by_key(
            entities, "name", scratch_dir(spark, "plan-report-stored"), "zf_plan_report", 16), "name"),
        "J2 fill from knowledge table": fill_from_knowledge(match, period_knowledge(match, "team_name_1", "country_1", "season"),
                                                            "team_name_1", "country_1", "season"),
        "A2 counts from footers": row_counts_from_footers(spark, standins.raw_match_teams(spark, sf)),
        "J2 fill": fill_from_latest_known(match, "team_name_1", "country_1", "season"),
        "A1 known_pairs": known_pairs(match, "team_name_1", "country_1"),
        "A3 latest_known_value": latest_known_value(match, "team_name_1", "country_1", "season"),
        "A2 row_counts": row_counts(match),
        "F2 canonicalize (folded map)": match.withColumn("team_name_1", canonicalize("team_name_1")),
        "O2 exclude season (partition pruned)": match.filter(F.col("season") != standins.EXCLUDED_SEASON),
    }
    print("| Plan | shuffles | broadcasts | aggregates | windows | sorts | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, df in plans.items():
        f = facts(df)
        print(f"| {name} | {f['shuffle']} | {f['broadcast']} | {f['aggregate']} | {f['window']} | {f['sort']} | "
              f"{f['scan']} |")


if __name__ == "__main__":
    main(sys.argv[1:])
