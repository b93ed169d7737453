"""Schema operators, merges and the country fill on FIXTURES.md rows."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from zoneflow.operators import (
    align_to_schema,
    cast_all_to_string,
    drop_columns,
    fill_from_latest_known,
    flatten_struct,
    latest_known_value,
    merge_grouped,
    merge_joined,
    rename_columns,
    standardize_columns,
    union_by_name_lenient,
    union_by_name_strict,
)
from zoneflow.operators.matches import clean_match_dates, clean_match_scores

FILL_ROWS = [
    ("A", "2018-19", None, "NA"),
    ("A", "2019-20", "ES", "ES"),
    ("A", "2020-21", None, "ES"),
    ("A", "2021-22", "XX", "XX"),
    ("A", "2022-23", "NA", "XX"),
    ("B", "2020-21", "NA", "NA"),
    ("B", "2021-22", "FR", "FR"),
]


def test_country_fill(spark):
    df = spark.createDataFrame([r[:3] for r in FILL_ROWS], "team string, season string, country string")
    out = fill_from_latest_known(df, "team", "country", "season")
    got = {(r.team, r.season): r.country for r in out.collect()}
    assert got == {(r[0], r[1]): r[3] for r in FILL_ROWS}
    assert out.count() == df.count()


def test_country_fill_same_season_and_null_team(spark):
    rows = [("A", "s1", "B1"), ("A", "s1", "A1"), ("A", "s1", None), (None, "s1", "Z"), (None, "s2", None)]
    df = spark.createDataFrame(rows, "team string, season string, country string")
    got = sorted(((r.team or ""), r.season, r.country)
                 for r in fill_from_latest_known(df, "team", "country", "season").collect())
    assert got == [("", "s1", "Z"), ("", "s2", "Z"), ("A", "s1", "A1"), ("A", "s1", "B1"), ("A", "s1", "B1")]


def test_latest_known_value(spark):
    df = spark.createDataFrame([r[:3] for r in FILL_ROWS], "team string, season string, country string")
    got = {r.team: (r.season, r.country) for r in latest_known_value(df, "team", "country", "season").collect()}
    assert got == {"A": ("2021-22", "XX"), "B": ("2021-22", "FR")}


def test_grouped_merge_consolidates_duplicates_and_nulls(spark):
    left = spark.createDataFrame([("k", 1), ("k", 2), (None, 3)], "name string, v int")
    right = spark.createDataFrame([("k", 10), ("k", 20), (None, 30), ("z", 5)], "name string, v int")
    got = sorted(((r.name or "", r.v) for r in merge_grouped([left, right]).collect()))
    assert got == [("", 3), ("", 30), ("k", 1), ("z", 5)]


def test_join_merge_never_fans_out(spark):
    left = spark.createDataFrame([("k", 1), ("k", 2)], "name string, v int")
    right = spark.createDataFrame([("k", 10), ("z", 5)], "name string, v int")
    got = sorted((r.name, r.v) for r in merge_joined([left, right]).collect())
    assert got == [("k", 1), ("z", 5)]


def test_merge_forms_agree_on_unique_keys(spark):
    a = spark.createDataFrame([("x", 1, None), ("y", None, "p")], "name string, n int, s string")
    b = spark.createDataFrame([("y", 7, "q"), ("w", 3, None)], "name string, n int, s string")
    c = spark.createDataFrame([("w", 9, "r", 1.5)], "name string, n int, s string, extra double")
    g = merge_grouped([a, b, c])
    j = merge_joined([a, b, c])
    assert g.columns == j.columns == ["name", "n", "s", "extra"]
    assert g.exceptAll(j).isEmpty() and j.exceptAll(g).isEmpty()
    assert {r.name: (r.n, r.s) for r in g.collect()} == {"x": (1, None), "y": (7, "p"), "w": (3, "r")}


def test_grouped_merge_aggregates_twice_without_a_join(spark):
    a = spark.range(100).select(F.col("id").cast("string").alias("name"), F.col("id").alias("v"))
    b = spark.range(50).select(F.col("id").cast("string").alias("name"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with redirect_stdout(buf):
            merge_grouped([a, b]).explain()
        assert buf.getvalue().count("Exchange") == 2 and "Join" not in buf.getvalue()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_align_to_schema(spark):
    df = spark.createDataFrame([("a", "12", "e"), ("b", "x", "f")], "name string, foundation_year string, extra string")
    out = align_to_schema(df, {"name": "string", "foundation_year": "int", "status": "string"})
    assert out.columns == ["name", "foundation_year", "extra", "status"]
    assert dict(out.dtypes)["foundation_year"] == "int"
    assert [(r.foundation_year, r.status) for r in out.orderBy("name").collect()] == [(12, None), (None, None)]


def test_standardize_is_idempotent_and_typed(spark):
    df = spark.createDataFrame([("r1", "extra")], "round string, mine string")
    once = standardize_columns(df)
    assert standardize_columns(once).columns == once.columns
    assert dict(once.dtypes)["week"] == "int" and dict(once.dtypes)["team1score"] == "int"
    assert "mine" in once.columns and len(once.columns) == 23


def test_rename_and_drop_ignore_absent_and_case(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "c_custkey long, c_name string, c_acctbal double")
    assert rename_columns(df, {"C_NAME": "name", "nope": "x"}).columns == ["c_custkey", "name", "c_acctbal"]
    assert drop_columns(df, "C_ACCTBAL", "nope").columns == ["c_custkey", "c_name"]


def test_flatten_struct(spark):
    df = spark.createDataFrame([("t", ("Ann", "Lee"))], "name string, coach struct<first_name:string,last_name:string>")
    out = flatten_struct(df, "coach")
    assert out.columns == ["name", "coach_first_name", "coach_last_name", "coach_nationality", "coach_date_of_birth"]
    assert out.first()[1:] == ("Ann", "Lee", None, None)
    plain = spark.createDataFrame([("t",)], "name string")
    assert flatten_struct(plain, "coach").columns == ["name"]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, k int")
    c = spark.createDataFrame([(3,)], "k int")
    assert union_by_name_strict([a, b]).count() == 2
    with pytest.raises(AnalysisException):
        union_by_name_strict([a, c]).collect()
    assert sorted((r.k, r.s) for r in union_by_name_lenient([a, c]).collect()) == [(1, "x"), (3, None)]


def test_text_with_number_union_needs_cast(spark):
    text = spark.createDataFrame([("abc",)], "v string")
    num = spark.createDataFrame([(1,)], "v long")
    got = sorted(r.v for r in union_by_name_strict([cast_all_to_string(text), cast_all_to_string(num)]).collect())
    assert got == ["1", "abc"]


def test_match_stages_are_idempotent(spark):
    raw = spark.createDataFrame(
        [("(Tue) 14 Sep 2021 (W37)", 3, None, "2", "NA", "x"), ("(Sat) 1 Jan 2022 (W52)", None, "4", None, None, "y")],
        "Date string, score1 int, team1score string, score2 string, round_type string, matchday string")
    once = clean_match_scores(clean_match_dates(raw))
    twice = clean_match_scores(clean_match_dates(once))
    assert once.columns == twice.columns
    assert once.exceptAll(twice).isEmpty()
    got = sorted((r.dateonly, r.day, r.week, r.team1score, r.team2score, r.round_type) for r in once.collect())
    assert got == [("2021-09-14", "Tue", 37, 3, 2, "g"), ("2022-01-01", "Sat", 52, 4, None, "g")]
    assert "matchday" not in once.columns and "Date" not in once.columns


def test_lowercase_date_column_is_processed(spark):
    df = spark.createDataFrame([("(Tue) 14 Sep 2021 (W37)",)], "date string")
    assert clean_match_dates(df).first().dateonly == "2021-09-14"


def test_known_pairs_keeps_na_drops_null(spark):
    from zoneflow.operators import known_pairs

    df = spark.createDataFrame([("A", "ES"), ("A", "ES"), ("A", None), ("B", "NA")], "team string, country string")
    assert sorted(tuple(r) for r in known_pairs(df, "team", "country").collect()) == [("A", "ES"), ("B", "NA")]


def test_preview_is_a_top_k_not_a_global_sort(spark):
    from zoneflow.sinks import preview_rows

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    plan = preview_rows(df, "k", 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert [r.k for r in preview_rows(df, "k", 5).collect()] == [0, 1, 2, 3, 4]


def test_unify_agrees_on_a_type(spark):
    from zoneflow.operators import unify_schemas, union_by_name_strict

    a = spark.createDataFrame([(1, 2, "x")], "a int, b int, c string")
    b = spark.createDataFrame([(1.5, 2, (1,))], "a double, b bigint, c struct<k:int>")
    out = union_by_name_strict(unify_schemas([a, b]))
    assert dict(out.dtypes) == {"a": "double", "b": "bigint", "c": "string"}
    assert sorted((r.a, r.b, r.c) for r in out.collect()) == [(1.0, 2, "x"), (1.5, 2, '{"k":1}')]
