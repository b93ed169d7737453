"""Late seasons, changed inputs, rules as data, counts from footers, merges of stored sources."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.test_properties import COUNTRIES, SEASONS, SETTINGS, TEAMS, brute_fill, brute_merge
from zoneflow.functions import canonicalize_by_join, close_rules, names
from zoneflow.operators import (
    fill_from_knowledge,
    merge_joined,
    merge_stored,
    period_knowledge,
    periods_that_move,
    store_by_key,
)
from zoneflow.plans import jobs
from zoneflow.sinks import replace_partitions, write_parquet
from zoneflow.sources import read_season_table, row_counts_from_footers

MATCHES = "team string, season string, country string"


# -- J2 / W4: late and corrected seasons ---------------------------------------------

@SETTINGS
@given(st.lists(st.tuples(TEAMS, SEASONS, COUNTRIES), min_size=1, max_size=25),
       st.lists(st.tuples(TEAMS, st.just("2020-21"), COUNTRIES), max_size=6))
def test_only_periods_whose_fill_changes_move(spark, rows, correction):
    after = [r for r in rows if r[1] != "2020-21"] + correction

    def fills(some):
        return sorted(brute_fill(some), key=repr)

    old, new = (period_knowledge(spark.createDataFrame(r, MATCHES), "team", "country", "season") for r in (rows, after))
    moved = {r.season for r in periods_that_move(old, new, "team", "season").collect()}
    for season in {r[1] for r in rows} - {"2020-21"}:
        gaps = [(t, s, c) for t, s, c in rows if s == season]
        differ = any(brute_fill_one(r, rows) != brute_fill_one(r, after) for r in gaps if r[2] in (None, "NA"))
        assert (season in moved) == differ
    got = fill_from_knowledge(spark.createDataFrame(after or [], MATCHES), new, "team", "country", "season").collect()
    assert sorted((tuple(r) for r in got), key=repr) == fills(after)


def brute_fill_one(row, rows):
    team, season, _ = row
    known = [(s, c) for t, s, c in rows if t == team and s <= season and c not in (None, "NA")]
    last = max((s for s, _ in known), default=None)
    return max((c for s, c in known if s == last), default="NA")


@pytest.mark.parametrize("seed", range(3))
def test_late_job_equals_one_run_whatever_the_order(spark, scratch, seed):
    rng = random.Random(seed)
    seasons = ["2018-19", "2019-20", "2020-21", "2021-22", "2022-23"]

    def season_rows(s):
        return [(rng.choice("ABCD"), s, rng.choice(["ES", "FR", "NA", None, None])) for _ in range(8)]

    src, dst, knowledge = (f"{scratch}/{p}" for p in ("src", "dst", "knowledge"))
    current = {}
    arrivals = [*rng.sample(seasons, 5), *rng.sample(seasons, 3)]   # each once in any order, then corrections
    for s in arrivals:
        current[s] = season_rows(s)
        frame = spark.createDataFrame(current[s], "team_name_1 string, season string, country_1 string")
        replace_partitions(frame, src, ("season",))
        rewritten = jobs.match_enrich_late_job(spark, src, dst, [s], knowledge, rules=())
        assert s in rewritten and set(rewritten) <= {x for x in current if x >= s}
        got = sorted(((r.team_name_1, str(r.season), r.country_1) for r in read_season_table(spark, dst).collect()), key=repr)
        assert got == brute_fill([r for rows in current.values() for r in rows])


# -- K2: changed inputs ---------------------------------------------------------------

def files_below(path):
    from pathlib import Path

    return {f: (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path.replace("file:", "", 1)).rglob("*.parquet")}


def test_a_second_run_writes_nothing_and_a_touched_file_its_season_only(spark, scratch):
    import os
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1)) / "landing"
    for s in ("2020-21", "2021-22", "2022-23"):
        (base / s / "in").mkdir(parents=True)
        (base / s / "in" / "x.csv").write_text(f"Date,v\n(Tue) 14 Sep 2021,{s}\n")
    raw, dates = f"{scratch}/raw", f"{scratch}/dates"
    assert jobs.landing_to_raw(spark, f"file:{base}", raw, only_changed=True) == raw
    assert jobs.match_dates_job(spark, raw, dates, only_changed=True) == dates
    before, before_dates = files_below(raw), files_below(dates)
    assert jobs.landing_to_raw(spark, f"file:{base}", raw, only_changed=True) is None
    assert jobs.match_dates_job(spark, raw, dates, only_changed=True) is None
    assert files_below(raw) == before and files_below(dates) == before_dates
    os.utime(base / "2021-22" / "in" / "x.csv", (1_700_000_000, 1_700_000_000))
    (base / "2020-21" / "in" / "y.csv").write_text("v,Date\nnew,\n")
    assert jobs.landing_to_raw(spark, f"file:{base}", raw, seasons=["2020-21", "2022-23"], only_changed=True) == raw
    changed = {f.parent.name for f in files_below(raw).keys() ^ before.keys()}
    assert changed == {"season=2020-21"}
    assert jobs.landing_to_raw(spark, f"file:{base}", raw, only_changed=True) == raw
    assert {f.parent.name for f in files_below(raw).keys() ^ before.keys()} == {"season=2020-21", "season=2021-22"}
    assert jobs.match_dates_job(spark, raw, dates, only_changed=True) == dates
    assert {f.parent.name for f in files_below(dates).keys() ^ before_dates.keys()} == {"season=2020-21", "season=2021-22"}
    got = sorted(((str(r.season), r.dateonly) for r in read_season_table(spark, dates).collect()), key=repr)
    assert got == [("2020-21", "2021-09-14"), ("2020-21", None), ("2021-22", "2021-09-14"), ("2022-23", "2021-09-14")]


# -- F2: rules as data -----------------------------------------------------------------

def in_turn(value, rules):
    for _, source, target in rules:
        if value == source:
            value = target
    return value


@settings(parent=SETTINGS, max_examples=10)
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from("abcdef")), max_size=25))
def test_closed_rules_are_those_applied_in_turn(spark, pairs):
    rules = [(k, a, b) for k, (a, b) in enumerate(pairs)]
    closed = {r.source: r.target for r in close_rules(spark.createDataFrame(rules, "position long, source string, target string")).collect()}
    want = {v: in_turn(v, rules) for v in "abcdef"}
    assert closed == {v: w for v, w in want.items() if v != w}


def test_closure_of_a_hundred_thousand_rules(spark):
    rng = random.Random(3)
    n = 100_000
    rules = [(k, f"v{rng.randrange(4000) if k % 3 else 0}", f"v{rng.randrange(4000)}") for k in range(n)]
    follow: dict[str, str] = {}
    for k in range(n - 1, -1, -1):      # from the last rule back: what a value becomes from here on
        _, a, b = rules[k]
        follow[a] = follow.get(b, b)
    got = close_rules(spark.createDataFrame(rules, "position long, source string, target string"))
    assert {r.source: r.target for r in got.collect()} == {v: w for v, w in follow.items() if v != w}


def test_rules_closed_in_many_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rules = [(rng.randrange(150), rng.choice("abcdefgh"), rng.choice("abcdefgh")) for _ in range(300)] + [(7, "a", "b")] * 30
    monkeypatch.setattr(names, "BLOCK_RULES", 20)
    got = close_rules(spark.createDataFrame(rules, "position long, source string, target string"))
    want = {v: in_turn(v, sorted(rules)) for v in "abcdefgh"}
    assert {r.source: r.target for r in got.collect()} == {v: w for v, w in want.items() if v != w}


def test_long_chains_are_closed_without_a_join_for_each_doubling(spark, monkeypatch):
    n, written = 5000, []
    rules = [(k, f"v{k % 7}", f"v{(k + 1) % 7}") for k in range(n)]   # every rule fires on the one before
    made = names.scratch_dir
    monkeypatch.setattr(names, "scratch_dir", lambda spark, tag: written.append(tag) or made(spark, tag))
    closed = {r.source: r.target for r in close_rules(spark.createDataFrame(rules, "position long, source string, target string")).collect()}
    assert closed == {v: w for v in (f"v{k}" for k in range(7)) if (w := in_turn(v, rules)) != v}
    assert len(written) <= 4   # 13 doublings of the rules before


def test_rules_with_nulls_and_no_rules(spark):
    schema = "position long, source string, target string"
    frame = spark.createDataFrame([(1, "a", None), (None, "a", "b"), (2, None, "c"), (3, "a", "d"), (3, "a", "d")], schema)
    assert [tuple(r) for r in close_rules(frame).collect()] == [("a", "d")]
    teams = spark.createDataFrame([("a",), (None,), ("z",)], "team string")
    assert sorted((r.team or "") for r in canonicalize_by_join(teams, "team", close_rules(frame)).collect()) == ["", "d", "z"]
    assert close_rules(spark.createDataFrame([], schema)).collect() == []


# -- A2: counts from footers -------------------------------------------------------------

def test_counts_are_pushed_into_the_scan(spark, scratch):
    rows = [(k, None if k % 3 else f"d{k}", "2020-21" if k % 2 else "2021-22") for k in range(100)] + [(1, None, "2022-23")]
    write_parquet(spark.createDataFrame(rows, "k long, d string, season string"), scratch, partition_by=("season",))
    counted = row_counts_from_footers(spark, scratch, filled="d")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(d)]" in plan and "PushedGroupBy: [season]" in plan
    assert {str(r.season): r.n_rows for r in counted.collect()} == {"2020-21": 17, "2021-22": 17}
    assert {str(r.season): r.n_rows for r in row_counts_from_footers(spark, scratch).collect()} == {"2020-21": 50, "2021-22": 50, "2022-23": 1}
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


# -- J1: merge of stored sources -----------------------------------------------------------

def test_stored_sources_merge_without_an_exchange(spark, scratch):
    rng = random.Random(1)
    sources = [[(k, rng.choice([None, rng.randrange(9)]), rng.choice([None, "x", "y"])) for k in rng.sample("abcdefghij", 6)] for _ in range(3)]
    frames = [spark.createDataFrame([*s, (None, 1, "lost")], "name string, n int, s string") for s in sources]
    stored = store_by_key(frames, "name", scratch, "zf_test_stored", buckets=4)
    merged = merge_stored(stored, "name")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 4
    got = {r.name: (r.n, r.s) for r in merged.collect()}
    assert got == brute_merge(sources)
    assert got == {r.name: (r.n, r.s) for r in merge_joined(frames).collect() if r.name}
    assert merged.count() == len(got)
