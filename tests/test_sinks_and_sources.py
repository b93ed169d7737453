"""Round trips through the scans and sinks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from zoneflow.operators import STANDING_CSV_SCHEMA
from zoneflow.sinks import (
    data_files,
    export_csv,
    export_single_csv,
    json_rows,
    path_exists,
    publish,
    replace_partitions,
    serve_page,
    write_json_rows,
    write_parquet,
    write_single_parquet,
    writers,
)
from zoneflow.sources import (
    read_csv_quoted,
    read_csv_strings,
    read_csv_with_schema,
    read_mixed_format,
    season_folder_scan,
    tolerant_scan,
)


def write_text(spark, lines, path):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_replace_partitions_leaves_other_seasons_alone(spark, scratch):
    df = spark.createDataFrame([(1, "2020-21"), (2, "2021-22"), (3, "2022-23")], "v int, season string")
    write_parquet(df, scratch, partition_by=("season",))
    before = sorted(data_files(spark, f"{scratch}/season=2020-21"))
    replace_partitions(spark.createDataFrame([(20, "2021-22")], "v int, season string"), scratch)
    assert sorted(data_files(spark, f"{scratch}/season=2020-21")) == before
    got = sorted((r.v, r.season) for r in spark.read.parquet(scratch).collect())
    assert got == [(1, "2020-21"), (3, "2022-23"), (20, "2021-22")]


def test_single_file_outputs(spark, scratch):
    df = spark.range(1000).repartition(8).select(F.col("id"), (F.col("id") % 7).alias("m"))
    write_single_parquet(df, f"{scratch}/p")
    assert len(data_files(spark, f"{scratch}/p", ".parquet")) == 1
    assert spark.read.parquet(f"{scratch}/p").count() == 1000
    export_single_csv(df, f"{scratch}/c")
    assert len(data_files(spark, f"{scratch}/c", ".csv")) == 1
    assert export_single_csv(df.filter("id < 0"), f"{scratch}/empty") is None
    assert not path_exists(spark, f"{scratch}/empty")


def test_parallel_parts_unless_one_file_is_asked_for(spark, scratch):
    df = spark.range(1000).repartition(4)
    publish(df, f"{scratch}/big")
    assert len(data_files(spark, f"{scratch}/big", ".parquet")) == 4
    publish(df, f"{scratch}/big", one_file=True)
    assert len(data_files(spark, f"{scratch}/big", ".parquet")) == 1
    assert spark.read.parquet(f"{scratch}/big").count() == 1000


def test_csv_export_keeps_every_text(spark, scratch):
    rows = [(1, "a\nb"), (2, ""), (3, None), (4, 'say "x", y'), (5, "  pad "), (6, "a\r\nb"), (7, "back\\slash"), (8, '"')]
    df = spark.createDataFrame(rows, "k int, v string")
    for path in (export_single_csv(df, f"{scratch}/one"), export_csv(df, f"{scratch}/many")):
        # a reader tells empty strings from nulls by its own emptyValue
        reader = spark.read.options(header=True, multiLine=True, escape='"', emptyValue="<empty>")
        got = reader.schema("k int, v string").csv(path)
        assert sorted((r.k, "" if r.v == "<empty>" else r.v) for r in got.collect()) == rows


def test_single_csv_is_written_and_read_by_many_tasks(spark, scratch, monkeypatch):
    odd = ["a\nb", "", None, 'say "x", y', "  pad ", "a\r\nb", "back\\slash", '"', "\n", '"\n"', "lone\rreturn", "é\n\n😀", ",", "x" * 400, "l\n" * 150]
    rows = [(k, odd[k % len(odd)], odd[k * 7 % len(odd)]) for k in range(240)]
    df = spark.createDataFrame(rows, "k int, `v,\n1` string, w string").repartition(5)
    monkeypatch.setattr(writers, "COPY_BYTES", 700)
    export_single_csv(df, f"{scratch}/one")
    assert len(data_files(spark, f"{scratch}/one")) == 1
    whole = read_csv_strings(spark, f"{scratch}/one", multiLine="true", escape='"')
    want = sorted((tuple(r) for r in whole.collect()), key=repr)
    assert sorted((int(r[0]), r[1] or "", r[2] or "") for r in want) == sorted((k, v or "", w or "") for k, v, w in rows)
    export_csv(df, f"{scratch}/many")
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (1 << 20, 2500, 600):   # texts are longer than the smallest ranges
            for c in before:
                spark.conf.set(c, str(size))
            for path in ("one", "many"):
                got = read_csv_quoted(spark, f"{scratch}/{path}")
                assert got.columns == whole.columns and sorted((tuple(r) for r in got.collect()), key=repr) == want
            assert size > 2500 or got.rdd.getNumPartitions() > 8 > 1 == whole.rdd.getNumPartitions()
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    spark.createDataFrame([(1, "a")], "k int, other string").write.csv(f"{scratch}/many", header=True, mode="append")
    with pytest.raises(Exception, match="header"):
        read_csv_quoted(spark, f"{scratch}/many").collect()


def test_failed_write_leaves_the_old_rows(spark, scratch):
    import pytest

    bad = spark.range(10).select(F.when(F.col("id") > 4, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    for write in (write_parquet, publish, write_single_parquet, export_single_csv):
        write(spark.range(5), f"{scratch}/t")
        with pytest.raises(Exception, match="stop"):
            write(bad, f"{scratch}/t")
        reader = spark.read.option("header", "true")
        old = reader.csv(f"{scratch}/t") if write is export_single_csv else spark.read.parquet(f"{scratch}/t")
        assert sorted(int(r.id) for r in old.collect()) == list(range(5))


def test_json_rows_and_serving(spark, scratch):
    df = spark.createDataFrame([(None, "a"), (2, None)], "n int, s string")
    assert sorted(r.data for r in json_rows(df).collect()) == ['["2",null]', '[null,"a"]']
    write_json_rows(df, scratch)
    assert json.loads(spark.read.text(f"{scratch}/_columns").first().value) == ["n", "s"]
    assert spark.read.text(scratch).count() == 2
    pages = spark.createDataFrame([(k, f"v{k}" if k % 2 else None) for k in range(7)], "n int, s string")
    got, after, columns = [], None, None
    while True:
        page = serve_page(pages, "n", 3, after)
        got, after, columns = got + page["data"], page["next"], page["columns"]
        if after is None:
            break
    assert columns == ["n", "s"]
    assert got == [[str(k), f"v{k}" if k % 2 else None] for k in range(7)]
    assert serve_page(pages.limit(0), "n", 3) == {"columns": ["n", "s"], "data": [], "next": None}


def test_standing_csv_is_positional_and_permissive(spark, scratch):
    write_text(spark, ["idx,TEAM,x,y,z,q,gl,df,pts", "1,FC A,3,2,1,0,5-2,3,7", "2,Short,3", "3,B,x,1,1,1,1-1,0,4"],
               scratch)
    rows = {r["index"]: r for r in read_csv_with_schema(spark, scratch, STANDING_CSV_SCHEMA).collect()}
    assert rows[1]["Team"] == "FC A" and rows[1]["Pt."] == 7
    assert rows[2]["M."] == 3 and rows[2]["W"] is None and rows[2]["Pt."] is None
    assert rows[3]["M."] is None and rows[3]["W"] == 1


def test_tolerant_scan_splits_bad_lines(spark, scratch):
    write_text(spark, ["a,b", "1,2", "x,3", "4,5"], scratch)
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    good, bad = tolerant_scan(spark, scratch, schema)
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, 2), (4, 5)]
    assert [(r.b, r._bad_record) for r in bad.collect()] == [(3, "x,3")]


def test_season_scan_ignores_non_season_folders(spark, scratch):
    for folder, rows in (("2020-21/a", ["v", "1", "2"]), ("2021-22", ["v", "3"]), ("COUNTRIES", ["v", "9"]),
                         ("2021-2022", ["v", "8"])):
        write_text(spark, rows, f"{scratch}/{folder}")
    got = sorted((r.v, r.season) for r in season_folder_scan(spark, scratch).collect())
    assert got == [("1", "2020-21"), ("2", "2020-21"), ("3", "2021-22")]


def test_season_scan_keeps_each_seasons_header(spark, scratch):
    write_text(spark, ["a,b", "1,2"], f"{scratch}/2020-21")
    write_text(spark, ["b,c", "3,4"], f"{scratch}/2021-22")
    got = {r.season: (r.a, r.b, r.c) for r in season_folder_scan(spark, scratch).collect()}
    assert got == {"2020-21": ("1", "2", None), "2021-22": (None, "3", "4")}
    assert season_folder_scan(spark, f"{scratch}/nothing-here") is None


def test_mixed_folder_reads_each_format_once(spark, scratch):
    write_text(spark, ["k,v", "1,a"], f"{scratch}/x")
    csv_df, json_df = read_mixed_format(spark, scratch)
    assert json_df is None and csv_df is None  # text writer files are *.txt: neither format


def test_single_file_replaces_existing_target(spark, scratch):
    write_single_parquet(spark.range(5), f"{scratch}/t")
    write_single_parquet(spark.range(3), f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 3
    assert len(data_files(spark, f"{scratch}/t", ".parquet")) == 1
    from zoneflow.sinks.writers import filesystem

    fs, root = filesystem(spark, scratch)
    assert [st.getPath().getName() for st in fs.listStatus(root)] == ["t"]  # no staging folders left


def test_stage_on_empty_source_leaves_target_alone(spark, scratch):
    from zoneflow.plans import jobs

    write_parquet(spark.createDataFrame([(1, "2020-21")], "v int, season string"), f"{scratch}/dst",
                  partition_by=("season",))
    assert jobs.match_dates_job(spark, f"{scratch}/missing", f"{scratch}/dst") is None
    assert jobs.fact_matches_job(spark, f"{scratch}/missing", f"{scratch}/dst") is None
    assert spark.read.parquet(f"{scratch}/dst").count() == 1


def test_tolerant_scan_skips_unreadable_files(spark, scratch):
    from pathlib import Path

    write_text(spark, ["a,b", "1,2"], f"{scratch}/ok")
    broken = Path(scratch.replace("file:", "", 1)) / "ok" / "broken.csv.gz"
    broken.write_bytes(b"\x1f\x8b\x08\x00 this is not gzip data")
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    good, bad = tolerant_scan(spark, scratch, schema)
    assert [(r.a, r.b) for r in good.collect()] == [(1, 2)]
    assert bad.collect() == []


def test_season_scan_glob_mode_takes_season_from_path(spark, scratch):
    write_text(spark, ["v", "1"], f"{scratch}/2020-21/deep/er")
    write_text(spark, ["v", "2"], f"{scratch}/2021-22")
    write_text(spark, ["v", "9"], f"{scratch}/COUNTRIES")
    got = sorted((r.v, r.season) for r in season_folder_scan(spark, scratch, per_season_header=False).collect())
    assert got == [("1", "2020-21"), ("2", "2021-22")]


def test_tolerant_scan_json_lines(spark, scratch):
    write_text(spark, ['{"a": 1, "b": 2}', '{"a": "x", "b": 3}', "not json", '{"a": 4}'], scratch)
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    good, bad = tolerant_scan(spark, scratch, schema, fmt="json")
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, 2), (4, None)]
    assert sorted(r._bad_record for r in bad.collect()) == ["not json", '{"a": "x", "b": 3}']


def test_season_scan_limited_to_named_seasons(spark, scratch):
    write_text(spark, ["v", "1"], f"{scratch}/2020-21")
    write_text(spark, ["v", "2"], f"{scratch}/2021-22")
    for glob_mode in (False, True):
        got = [(r.v, r.season) for r in season_folder_scan(spark, scratch, per_season_header=not glob_mode,
                                                           seasons=["2021-22"]).collect()]
        assert got == [("2", "2021-22")]


def test_csv_header_mismatch_fails_instead_of_shifting(spark, scratch):
    import pytest

    from zoneflow.sources import read_csv_strings

    write_text(spark, ["a,b", "1,2"], f"{scratch}/x")
    write_text(spark, ["b,a", "3,4"], f"{scratch}/y")
    with pytest.raises(Exception):
        read_csv_strings(spark, scratch).collect()
    write_text(spark, ["a,b", "5,6"], f"{scratch}/y")
    assert sorted((r.a, r.b) for r in read_csv_strings(spark, scratch).collect()) == [("1", "2"), ("5", "6")]


def test_mixed_folder_reads_each_csv_layout_by_name(spark, scratch):
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1))
    (base / "a").mkdir(parents=True)
    (base / "a" / "one.csv").write_text("code,name\n1,x\n")
    (base / "two.csv").write_text("name,code\ny,2\n")
    (base / "skip.txt").write_text("name,code\nz,3\n")
    csv_df, json_df = read_mixed_format(spark, scratch)
    assert json_df is None
    assert sorted((r.code, r.name) for r in csv_df.collect()) == [("1", "x"), ("2", "y")]


def test_season_folder_with_two_layouts_is_read_by_name(spark, scratch):
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1)) / "2020-21"
    base.mkdir(parents=True)
    (base / "one.csv").write_text("a,b\n1,2\n")
    (base / "two.csv").write_text("b,a\n4,3\n")
    got = sorted((r.a, r.b, r.season) for r in season_folder_scan(spark, scratch).collect())
    assert got == [("1", "2", "2020-21"), ("3", "4", "2020-21")]


def test_season_grouping_never_drops_other_files(spark, scratch):
    import gzip
    from pathlib import Path

    base = Path(scratch.replace("file:", "", 1)) / "2020-21"
    base.mkdir(parents=True)
    (base / "one.csv").write_text("a,b\n1,2\n")
    (base / "two.csv").write_text("a,b\n3,4\n")
    (base / "three.csv.gz").write_bytes(gzip.compress(b"a,b\n5,6\n"))
    got = sorted((r.a, r.b) for r in season_folder_scan(spark, scratch).collect())
    assert got == [("1", "2"), ("3", "4"), ("5", "6")]


def local(path):
    from pathlib import Path

    return Path(path.replace("file:", "", 1))


def test_layouts_of_many_files_are_found_in_one_job(spark, scratch):
    """More files than any fixed bound, a plain text file among them, and a base path with blanks and signs."""
    base = local(scratch) / "land ing+x"
    for season in range(5):
        folder = base / f"20{10 + season}-{11 + season}"
        folder.mkdir(parents=True)
        for k in range(410):
            (folder / f"f{k}.csv").write_text(f"a,b\n{k},{season}\n" if k % 2 else f"b,a\n{season},{k}\n")
    (base / "2010-11" / "readme.txt").write_text("notes\nhello\n")
    rows = season_folder_scan(spark, f"file:{base}")
    assert sorted(rows.columns) == ["a", "b", "notes", "season"]
    got = sorted((r.season, int(r.a), int(r.b)) for r in rows.filter("notes is null").collect())
    assert got == sorted((f"20{10 + s}-{11 + s}", k, s) for s in range(5) for k in range(410))
    assert [r.season for r in rows.filter("notes = 'hello'").collect()] == ["2010-11"]


def test_number_of_jobs_does_not_depend_on_the_seasons(spark, scratch):
    def jobs_of(n):
        base = local(scratch) / f"n{n}"
        for k in range(n):
            (base / f"20{10 + k}-{11 + k}").mkdir(parents=True)
            (base / f"20{10 + k}-{11 + k}" / "x.csv").write_text("a,b\n1,2\n")
        spark.sparkContext.setJobGroup(f"layouts-{n}", "")
        season_folder_scan(spark, f"file:{base}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"layouts-{n}"))

    assert jobs_of(2) == jobs_of(12) > 0


def test_bad_json_is_put_aside_and_types_stay(spark, scratch):
    from zoneflow.plans import jobs

    base = local(scratch) / "in"
    base.mkdir(parents=True)
    (base / "a.json").write_text('[{"id": 1, "x": 6.5e7, "in": {"v": 1.5}}, {"id": 2, "x": 1.0, "in": null}]')
    (base / "b.json").write_text('{"id": 3, "more": "m"}')
    (base / "c.json").write_text('{"id": 4, broken')
    jobs.countries_to_raw(spark, f"file:{base}", f"{scratch}/out")
    got = spark.read.parquet(f"{scratch}/out")
    assert dict(got.dtypes) == {"id": "bigint", "x": "double", "in": "struct<v:double>", "more": "string"}
    assert sorted((r.id, r.x, r.more) for r in got.collect()) == [(1, 6.5e7, None), (2, 1.0, None), (3, None, "m")]
    assert [r.path.rsplit("/", 1)[-1] for r in spark.read.parquet(f"{scratch}/out_rejects").collect()] == ["c.json"]
    (base / "d.csv").write_text("id,more\n9,z\n")
    jobs.countries_to_raw(spark, f"file:{base}", f"{scratch}/out")
    got = spark.read.parquet(f"{scratch}/out")
    assert dict(got.dtypes)["id"] == "string" and got.count() == 4
    for name in ("a.json", "b.json", "d.csv"):
        (base / name).unlink()
    jobs.countries_to_raw(spark, f"file:{base}", f"{scratch}/out")  # nothing readable is left: the old rows stay
    assert spark.read.parquet(f"{scratch}/out").count() == 4
