"""Column functions on the edge rows of FIXTURES.md."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zoneflow.functions import (
    TEAM_SYNONYM_RULES,
    canonicalize,
    date_from_text,
    date_from_timestamp,
    day_from_iso,
    day_from_text,
    fold_rules,
    normalize_name,
    null_token_default,
    split_pair_to_ints,
    week_from_iso,
    week_from_text,
)


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def test_normalize_name(spark):
    cases = {
        "FC Barcelona": "barcelona",
        "Atlético de Madrid": "atltico madrid",
        "Schalke 04": "schalke",
        "Paris Saint-Germain": "paris saintgermain",
        "Deportivo de La Coruña": "deportivo corua",
        "Club Fútbol X": "x",
        "1. FC Köln": "kln",
        "De\tLa": "",
        "FCé": "fc",
        None: None,
    }
    df = one_col(spark, list(cases)).select("x", normalize_name("x").alias("y"))
    assert {r.x: r.y for r in df.collect()} == cases


def test_dates_from_text(spark):
    df = one_col(spark, ["(Tue) 14 Sep 2021 (W37)", "(Sat) 1 Jan 2022 (W52)", "(W37) (Tue) 5 May 2021",
                         "14 Sept 2021", None])
    d = df.select("x", date_from_text("x").alias("d"))
    out = d.select("x", "d", day_from_iso("d").alias("day"), week_from_iso("d").alias("week")).collect()
    got = {r.x: (r.d, r.day, r.week) for r in out}
    assert got["(Tue) 14 Sep 2021 (W37)"] == ("2021-09-14", "Tue", 37)
    assert got["(Sat) 1 Jan 2022 (W52)"] == ("2022-01-01", "Sat", 52)
    assert got["(W37) (Tue) 5 May 2021"] == ("2021-05-05", "Wed", 18)
    assert got["14 Sept 2021"] == (None, None, None)
    assert got[None] == (None, None, None)


def test_text_parts_week_first_is_taken_as_day(spark):
    df = one_col(spark, ["(W37) (Tue) 5 May 2021", "(Tue) 5 May 2021", "no parts"])
    got = {r.x: (r.d, r.w) for r in df.select("x", day_from_text("x").alias("d"),
                                              week_from_text("x").alias("w")).collect()}
    assert got["(W37) (Tue) 5 May 2021"] == ("W37", 37)
    assert got["(Tue) 5 May 2021"] == ("Tue", None)
    assert got["no parts"] == ("", None)


def test_date_from_timestamp_is_ansi_safe(spark):
    df = one_col(spark, ["2021-09-14T20:00:00Z", "garbage", None])
    got = {r.x: r.d for r in df.select("x", date_from_timestamp("x").alias("d")).collect()}
    assert got == {"2021-09-14T20:00:00Z": "2021-09-14", "garbage": None, None: None}


def test_goal_pairs(spark):
    df = one_col(spark, ["12-7", "12", "12 - 7", "-3-7", None])
    a, b = split_pair_to_ints("x")
    got = {r.x: (r.a, r.b) for r in df.select("x", a.alias("a"), b.alias("b")).collect()}
    assert got == {"12-7": (12, 7), "12": (12, None), "12 - 7": (12, 7), "-3-7": (None, 3), None: (None, None)}


def test_round_type_default(spark):
    df = one_col(spark, [None, "NA", "q"])
    got = {r.x: r.y for r in df.select("x", null_token_default("x").alias("y")).collect()}
    assert got == {None: "g", "NA": "g", "q": "q"}


def test_synonyms_follow_rule_order(spark):
    df = one_col(spark, ["PSG", "Paris Saint-Germain", "Barça", "psg", "Nowhere United", "Inter Milan", None])
    got = {r.x: r.y for r in df.select("x", canonicalize("x").alias("y")).collect()}
    assert got == {"PSG": "Paris Saint-Germain", "Paris Saint-Germain": "Paris Saint-Germain",
                   "Barça": "Barcelona", "psg": "psg", "Nowhere United": "Nowhere United",
                   "Inter Milan": "Inter Milan", None: None}


def sequential(value, rules):
    for src, dst in rules:
        if value == src:
            value = dst
    return value


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.sampled_from("abcde")), max_size=12),
       st.sampled_from("abcdef"))
def test_folded_map_equals_sequential_rules(rules, value):
    assert fold_rules(rules).get(value, value) == sequential(value, rules)


def test_folded_team_rules_in_spark_equal_sequential(spark):
    pool = sorted({x for pair in TEAM_SYNONYM_RULES for x in pair} | {"psg", "x"})
    df = one_col(spark, pool)
    got = {r.x: r.y for r in df.select("x", canonicalize("x").alias("y")).collect()}
    assert got == {v: sequential(v, TEAM_SYNONYM_RULES) for v in pool}


def test_no_python_udf_in_function_plans(spark):
    df = one_col(spark, ["a"]).select(normalize_name("x"), canonicalize("x"), date_from_text("x"),
                                      F.to_json(F.array(F.col("x"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("0123456789+-. \t\n\x01\x0b\xa0ae١")), max_size=12),
                min_size=1, max_size=40))
def test_guarded_integer_cast_equals_try_cast(spark, values):
    from zoneflow.functions.casts import text_to_integral

    df = spark.createDataFrame([(v,) for v in values + ["2147483648", "-2147483649"]], "s string")
    for t in ("int", "bigint"):
        rows = df.select(F.col("s").try_cast(t).alias("a"), text_to_integral("s", t).alias("b")).collect()
        assert all(r.a == r.b for r in rows)
