"""Zone jobs end to end on sf0.001 stand-ins."""

from __future__ import annotations

import pytest

from tests.conftest import SMOKE_DIR
from zoneflow.plans import jobs, standins
from zoneflow.sources import read_season_table


def test_dates_job_is_idempotent(spark, scratch):
    raw = standins.raw_match_dates(spark, SMOKE_DIR)
    jobs.match_dates_job(spark, raw, f"{scratch}/once")
    jobs.match_dates_job(spark, f"{scratch}/once", f"{scratch}/twice")
    once = read_season_table(spark, f"{scratch}/once")
    twice = read_season_table(spark, f"{scratch}/twice")
    assert sorted(once.columns) == sorted(twice.columns)
    assert once.exceptAll(twice.select(*once.columns)).isEmpty()
    assert once.count() == spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").count()


def test_rerun_replaces_instead_of_appending(spark, scratch):
    raw = standins.raw_match_scores(spark, SMOKE_DIR)
    jobs.match_scores_job(spark, raw, f"{scratch}/dst")
    jobs.match_scores_job(spark, raw, f"{scratch}/dst")
    assert read_season_table(spark, f"{scratch}/dst").count() == \
        spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").count()


def test_season_limited_stages_touch_only_those_seasons(spark, scratch):
    from pyspark.sql import functions as F

    from zoneflow.sources import season_partitions

    raw = standins.raw_match_dates(spark, SMOKE_DIR)
    seasons = season_partitions(spark, raw)
    jobs.match_dates_job(spark, raw, f"{scratch}/b", seasons=seasons[:2])
    assert season_partitions(spark, f"{scratch}/b") == seasons[:2]
    jobs.match_dates_job(spark, raw, f"{scratch}/b", seasons=seasons[2:])
    jobs.fact_matches_job(spark, f"{scratch}/b", f"{scratch}/fact", seasons=seasons[:3])
    jobs.fact_matches_job(spark, f"{scratch}/b", f"{scratch}/fact", seasons=seasons[3:])
    full = f"{scratch}/full"
    jobs.match_dates_job(spark, raw, full)
    a = read_season_table(spark, f"{scratch}/fact")
    b = read_season_table(spark, full)
    assert season_partitions(spark, f"{scratch}/fact") == seasons
    assert a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()
    assert a.filter(F.col("dateonly").isNull()).isEmpty()


def test_cli_incremental_enrich_chain(spark, scratch):
    from zoneflow.plans.cli import main
    from zoneflow.sources import season_partitions

    src = standins.raw_match_teams(spark, SMOKE_DIR)
    seasons = season_partitions(spark, src)
    first, rest = ",".join(seasons[:3]), ",".join(seasons[3:])
    assert main(["match-enrich-incremental", src, f"{scratch}/dst", first, "-", f"{scratch}/s1"]) == 0
    assert main(["match-enrich-incremental", src, f"{scratch}/dst", rest, f"{scratch}/s1", f"{scratch}/s2"]) == 0
    jobs.match_enrich_job(spark, src, f"{scratch}/full", skip_seasons=())
    a = read_season_table(spark, f"{scratch}/dst")
    b = read_season_table(spark, f"{scratch}/full").select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_job_bodies_stay_on_the_jvm(spark):
    from zoneflow.operators import merge_grouped
    from zoneflow.operators.matches import clean_match_dates, clean_match_scores, enrich_matches

    teams = read_season_table(spark, standins.raw_match_teams(spark, SMOKE_DIR))
    landing = standins.landing_teams(spark, SMOKE_DIR)
    csv_df, json_df = jobs.read_mixed_format(spark, landing, csv_schema=jobs.STANDING_CSV_SCHEMA)
    bodies = [
        clean_match_dates(read_season_table(spark, standins.raw_match_dates(spark, SMOKE_DIR))),
        clean_match_scores(read_season_table(spark, standins.raw_match_scores(spark, SMOKE_DIR))),
        enrich_matches(teams),
        merge_grouped([jobs.conform_standing(csv_df), jobs.conform_team_json(json_df)]),
        jobs.team_dimension(spark.read.parquet(standins.raw_team_goals(spark, SMOKE_DIR))),
    ]
    for df in bodies:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def write_team_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("idx,team,m,w,d,l,g,dif,pt\n" + "".join(",".join(map(str, r)) + "\n" for r in rows))


@pytest.mark.parametrize("split_json", [False, True])
def test_files_of_one_team_count_in_path_order(spark, scratch, split_json):
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1)) / "TEAMS"
    write_team_csv(base / "a.csv", [(1, "FC Alpha", 10, 9, 0, 1, "20-5", 15, 27), (2, "", "", 1, "", "", "", "", ""),
                                    (3, "", "", 2, "", "", "", "", "")])
    write_team_csv(base / "c.csv", [(7, "Alpha", 10, 3, 3, 4, "1-2", -1, 12), (8, "Beta", "", 1, 1, 1, "1-1", 0, 4)])
    (base / "b.json").write_text('[{"name": "Beta Club", "founded": "1899", "stadium": "S", "points": 99, "coach": {"last_name": "L"}}]')
    (base / "z.json").write_text("{not json")
    jobs.teams_to_raw(spark, f"file:{base}", f"{scratch}/raw", split_json=split_json)
    rows = spark.read.parquet(f"{scratch}/raw").collect()
    named = {r["name"]: r for r in rows if r["name"]}
    assert (named["alpha"]["wins"], named["alpha"]["losses"], named["alpha"]["points"], named["alpha"]["index"]) == (9, 1, 27, 1)
    assert (named["beta"]["points"], named["beta"]["index"], named["beta"]["foundation_year"], named["beta"]["stadium"]) == (99, 8, 1899, "S")
    assert named["beta"]["coach_last_name"] == "L"
    assert sorted(r["wins"] for r in rows if not r["name"]) == [1, 2]
    assert spark.read.parquet(f"{scratch}/raw_rejects").count() == 1
    # what the next run no longer finds is no longer listed
    (base / "z.json").unlink()
    write_team_csv(base / "c.csv", [(7, "Alpha", 10, 3, 3, 4, "1-2", -1, 12, 13), (8, "Beta", "x")])
    jobs.teams_to_raw(spark, f"file:{base}", f"{scratch}/raw", split_json=split_json)
    listed = spark.read.parquet(f"{scratch}/raw_rejects").collect()
    assert sorted(r.record for r in listed) == ["7,Alpha,10,3,3,4,1-2,-1,12,13", "8,Beta,x"]
    (base / "c.csv").unlink()
    jobs.teams_to_raw(spark, f"file:{base}", f"{scratch}/raw", split_json=split_json)
    assert not Path(f"{scratch}/raw_rejects".replace("file:", "", 1)).exists()


def test_rows_that_lose_in_their_file_are_listed(spark, scratch):
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1)) / "TEAMS"
    write_team_csv(base / "a.csv", [(1, "Alpha", "", 5, 1, 1, "1-1", 0, 4), (2, "Alpha", 3, 4, 1, 1, "1-1", 0, 4)])
    jobs.teams_to_raw(spark, f"file:{base}", f"{scratch}/raw")
    kept, = spark.read.parquet(f"{scratch}/raw").collect()
    lost, = spark.read.parquet(f"{scratch}/raw_duplicates").collect()
    assert (kept["index"], kept["matches_played"], kept["wins"]) == (2, 3, 4) and (lost["index"], lost["wins"]) == (1, 5)


def test_seasons_keep_their_own_rules_from_landing_on(spark, scratch):
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1)) / "landing"
    for season, text in (("2020-21", "datetime,round_type\n2020-10-05 10:00:00,NA\n"), ("2021-22", "Date\n(Tue) 14 Sep 2021 (W37)\n"),
                         ("2022-23", "day,week\nFri,7\n")):
        (base / season).mkdir(parents=True)
        (base / season / "x.csv").write_text(text)
    jobs.landing_to_raw(spark, f"file:{base}", f"{scratch}/raw")
    jobs.match_dates_job(spark, f"{scratch}/raw", f"{scratch}/dates")
    jobs.match_scores_job(spark, f"{scratch}/dates", f"{scratch}/scores")
    got = {str(r.season): (r.dateonly, r.day, r.week, r.round_type) for r in read_season_table(spark, f"{scratch}/scores").collect()}
    # W2 writes the standard columns everywhere, so W3 finds a round type to default in every season
    assert got == {"2020-21": ("2020-10-05", "Mon", 41, "g"), "2021-22": ("2021-09-14", "Tue", 37, "g"), "2022-23": (None, "Fri", 7, "g")}
    jobs.match_dates_job(spark, f"{scratch}/raw", f"{scratch}/one", seasons=["2021-22"])
    assert [(r.dateonly, r.week) for r in read_season_table(spark, f"{scratch}/one").collect()] == [("2021-09-14", 37)]


def test_empty_inputs_leave_dimensions_alone(spark, scratch):
    from zoneflow.sinks import write_parquet

    rows = spark.createDataFrame([("a", "1-2")], "name string, total_goals string")
    write_parquet(rows, f"{scratch}/raw")
    jobs.teams_to_dim(spark, f"{scratch}/raw", f"{scratch}/dim")
    jobs.countries_to_building(spark, f"{scratch}/raw", f"{scratch}/countries")
    write_parquet(rows.limit(0), f"{scratch}/raw")
    assert jobs.teams_to_dim(spark, f"{scratch}/raw", f"{scratch}/dim") is None
    assert jobs.countries_to_building(spark, f"{scratch}/raw", f"{scratch}/countries") is None
    assert spark.read.parquet(f"{scratch}/dim").count() == spark.read.parquet(f"{scratch}/countries").count() == 1


def test_enrich_keeps_rows_without_a_season_and_splits_no_plan_by_size(spark):
    from zoneflow.operators.matches import enrich_matches

    rows = [("A", "ES", "2020-21"), ("A", None, None), ("A", "NA", "2023-24"), ("A", None, "2021-22")]
    df = spark.createDataFrame(rows, "team_name_1 string, country_1 string, season string")
    assert enrich_matches(df).count() == 4
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('t', id % 500)) AS team_name_1",
                                         "if(id % 7 = 0, 'ES', null) AS country_1", "concat('20', 10 + id % 9, '-11') AS season")
    out = enrich_matches(hot, skip_seasons=())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 30_000 and "ExistingRDD" not in plan
    assert out.filter("team_name_1 = 'hot' and country_1 = 'NA'").isEmpty()


def test_letters_tell_long_keys_apart(spark):
    keys = spark.createDataFrame([(k,) for k in (12, 123456789, 123456780, 12345678, 10 ** 12)], "k long")
    assert keys.select(standins.letters("k")).distinct().count() == 5
