"""Operators against brute-force Python on random small inputs."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from zoneflow.functions import canonicalize_by_join
from zoneflow.operators import fill_from_latest_known, merge_grouped, merge_joined

TEAMS = st.sampled_from(["A", "B", "C", None])
SEASONS = st.sampled_from(["2019-20", "2020-21", "2021-22", "2022-23"])
COUNTRIES = st.sampled_from(["ES", "FR", "IT", "NA", None])
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_fill(rows):
    """The dictionary semantics: latest season <= own with a real value (max within it), else NA."""
    out = []
    for team, season, country in rows:
        if country is not None and country != "NA":
            out.append((team, season, country))
            continue
        known = [(s, c) for t, s, c in rows if t == team and s <= season and c is not None and c != "NA"]
        if not known:
            out.append((team, season, "NA"))
            continue
        last = max(s for s, _ in known)
        out.append((team, season, max(c for s, c in known if s == last)))
    return sorted(out, key=repr)


@SETTINGS
@given(st.lists(st.tuples(TEAMS, SEASONS, COUNTRIES), min_size=1, max_size=30))
def test_fill_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "team string, season string, country string")
    got = sorted(((r.team, r.season, r.country) for r in
                  fill_from_latest_known(df, "team", "country", "season").collect()), key=repr)
    assert got == brute_fill(rows)


def brute_merge(sources):
    """First non-null per column in source order; one row per key (keys unique per source)."""
    keys = []
    for src in sources:
        for k, *_ in src:
            if k not in keys:
                keys.append(k)
    out = {}
    for k in keys:
        row = []
        for col in range(2):
            vals = [r[col + 1] for src in sources for r in src if r[0] == k and r[col + 1] is not None]
            row.append(vals[0] if vals else None)
        out[k] = tuple(row)
    return out


@SETTINGS
@given(st.lists(st.dictionaries(st.sampled_from("abcdefg"),
                                st.tuples(st.one_of(st.none(), st.integers(0, 9)),
                                          st.one_of(st.none(), st.sampled_from("xyz"))), max_size=6),
                min_size=1, max_size=3))
def test_merge_forms_match_brute_force(spark, dicts):
    sources = [[(k, *v) for k, v in d.items()] for d in dicts]
    frames = [spark.createDataFrame(src, "name string, n int, s string") for src in sources]
    want = brute_merge(sources)
    for merge in (merge_grouped, merge_joined):
        got = {r.name: (r.n, r.s) for r in merge(frames).collect()}
        assert got == want, merge.__name__


def test_canonicalize_by_join(spark):
    df = spark.createDataFrame([("PSG",), ("Barça",), ("other",), (None,)], "team string")
    rules = spark.createDataFrame([("PSG", "Paris Saint-Germain"), ("Barça", "Barcelona")], "source string, target string")
    got = sorted((r.team or "") for r in canonicalize_by_join(df, "team", rules).collect())
    assert got == ["", "Barcelona", "Paris Saint-Germain", "other"]


@SETTINGS
@given(st.lists(st.tuples(TEAMS, SEASONS, COUNTRIES), min_size=1, max_size=30), SEASONS)
def test_incremental_fill_equals_full(spark, rows, split):
    from zoneflow.operators import fill_with_state

    schema = "team string, season string, country string"
    old = spark.createDataFrame([r for r in rows if r[1] < split] or [], schema)
    new = spark.createDataFrame([r for r in rows if r[1] >= split] or [], schema)
    first, state = fill_with_state(old, None, "team", "country", "season")
    second, _ = fill_with_state(new, state, "team", "country", "season")
    got = sorted(((r.team, r.season, r.country) for r in first.unionByName(second).collect()), key=repr)
    assert got == brute_fill(rows)
