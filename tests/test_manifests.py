"""Header and footer manifests: files that do not agree, files that cannot be read, layouts of single files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zoneflow.plans import jobs
from zoneflow.sources import (
    header_manifest,
    ragged_records,
    read_csv_by_header,
    read_parquet_recursive_merged,
    read_season_table,
    season_folder_scan,
    well_formed,
)
from zoneflow.sources import manifests
from zoneflow.sources.manifests import file_path
from zoneflow.sources.tables import scan_parquet, scan_season_table


def local(path):
    from pathlib import Path

    return Path(path.replace("file:", "", 1))


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text) if isinstance(text, bytes) else path.write_text(text, newline="")


def tasks_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, "")
    action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]


# -- CSV headers -----------------------------------------------------------------

def test_one_task_per_file_however_long_it_is(spark, scratch):
    base = local(scratch)
    put(base / "long.csv", "a,b\n" + "1,2\n" * 400_000)
    for k in range(11):
        put(base / f"f{k}.csv", "a,b\n1,2\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert tasks_of(spark, f"heads-{scratch}", lambda: header_manifest(spark, scratch)) == [12]
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "256k"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_many_files_and_layouts_are_one_scan(spark, scratch):
    base = local(scratch)
    for k in range(600):
        order = ["v", f"x{k % 60}", "k"] if k % 2 else ["k", "v", f"x{k % 60}"]
        cells = {"k": str(k), "v": f"v{k}", f"x{k % 60}": f"x-{k}"}
        put(base / f"f{k}.csv", ",".join(order) + "\n" + ",".join(cells[c] for c in order) + "\n")
    rows = read_csv_by_header(spark, scratch)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # the scan of the lines, the manifest and the layouts; no union
    assert plan.count("FileScan csv") == 1 and "Union" not in plan
    got = {r["k"]: r for r in well_formed(rows).collect()}
    assert len(got) == 600 and len(rows.columns) == 63
    for k in range(600):
        r = got[str(k)]
        assert r["v"] == f"v{k}" and r[f"x{k % 60}"] == f"x-{k}" and r[f"x{(k + 1) % 60}"] is None


@pytest.mark.parametrize("layouts", [1, 2])
def test_blank_lines_quotes_and_ragged_records(spark, scratch, layouts):
    base = local(scratch)
    put(base / "a.csv", '﻿\n \r\n\na,b\r\n1,2\r\n\r\n"x,\\"y\\"",\r\n7\n3,4,5,6\n8,"9"\n,\n"open,1\n')
    if layouts == 2:
        put(base / "b.csv", 'b,c,a\nB,"C\\" d",A\nonly\n1,2,3,\nq\x01z,2,3\n')
    put(base / "empty.csv", "")
    put(base / "blank.csv", "\n\n")
    rows = read_csv_by_header(spark, scratch, extra={"path": file_path()})
    good = well_formed(rows).select("a", "b", F.regexp_extract("path", "([a-z]+).csv", 1).alias("f")).collect()
    want = [("1", "2", "a"), ('x,"y"', None, "a"), ("8", "9", "a"), (None, None, "a")]
    if layouts == 2:
        want += [("A", "B", "b"), ("3", "q\x01z", "b")]
    assert sorted(map(tuple, good), key=repr) == sorted(want, key=repr)
    bad = [r["record"] for r in ragged_records(rows, "path").collect()]
    assert sorted(bad) == sorted(["7", "3,4,5,6", '"open,1', *(["only", "1,2,3,"] if layouts == 2 else [])])


def test_names_without_regard_to_case_blank_and_repeated(spark, scratch):
    base = local(scratch)
    put(base / "a.csv", "Date,,x,x\n1,2,3,4\n")
    put(base / "b.csv", "date,y\n5,6\n")
    rows = well_formed(read_csv_by_header(spark, scratch))
    assert rows.columns == ["Date", "_c1", "x2", "x3", "y"]
    assert sorted(map(tuple, rows.collect()), key=repr) == [("1", "2", "3", "4", None), ("5", None, None, None, "6")]


def test_records_of_several_lines_and_other_separators(spark, scratch):
    base = local(scratch)
    put(base / "a.csv", 'a;b\n1;"two\nlines"\n3;4;5\n')
    put(base / "b.csv", "b;c\n6;7\n8\n")
    rows = read_csv_by_header(spark, scratch, sep=";", multiLine="true")
    assert sorted(map(tuple, well_formed(rows).collect()), key=repr) == [("1", "two\nlines", None), (None, "6", "7"), (None, "8", None)]


@pytest.mark.parametrize("layouts", [1, 2])
def test_rows_are_counted_whatever_columns_are_asked_for(spark, scratch, layouts):
    base = local(scratch)
    for k in range(4):
        put(base / "2020-21" / f"{k}.csv", "a,b\n1,2\n3\n" if k < 3 or layouts == 1 else "b\n1\n1,2\n")
    rows = season_folder_scan(spark, scratch)
    assert rows.count() == rows.select("season").count() == rows.select("b").count() == 4
    assert [tuple(r) for r in rows.groupBy("season").count().collect()] == [("2020-21", 4)]


def test_more_files_than_are_broadcast(spark, scratch, monkeypatch):
    monkeypatch.setattr(manifests, "BROADCAST_FILES", 0)
    for k in range(6):
        put(local(scratch) / f"20{10 + k}-{11 + k}" / "f.csv", "a,b\n1,2\n" if k % 2 else "b,a\n2,1\n")
    assert {tuple(r)[:2] for r in season_folder_scan(spark, scratch).collect()} in ({("2", "1")}, {("1", "2")})


def test_landing_lists_ragged_records_and_writes_the_rest(spark, scratch):
    base = local(scratch) / "landing"
    put(base / "2020-21" / "a.csv", "\n\nv,w\n1,2\n3,4,5,6\n7\n")
    put(base / "2021-22" / "a.csv", "w,v,x\n1,2,3\n")
    jobs.landing_to_raw(spark, f"file:{base}", f"{scratch}/raw")
    got = sorted((r.v, r.w, r.x, str(r.season)) for r in read_season_table(spark, f"{scratch}/raw").collect())
    assert got == [("1", "2", None, "2020-21"), ("2", "1", "3", "2021-22")]
    rejects = spark.read.parquet(f"{scratch}/raw_rejects").collect()
    assert sorted((r.record, r.season, r.path.rsplit("/", 1)[-1]) for r in rejects) == [("3,4,5,6", "2020-21", "a.csv"), ("7", "2020-21", "a.csv")]
    put(base / "2020-21" / "a.csv", "v,w\n1,2\n3,4\n")
    jobs.landing_to_raw(spark, f"file:{base}", f"{scratch}/raw")
    assert not (local(scratch) / "raw_rejects").exists() and read_season_table(spark, f"{scratch}/raw").count() == 3


# -- parquet footers -----------------------------------------------------------------

def season_file(spark, base, season, **columns):
    ddl = ", ".join(f"{c} {'long' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for c, v in columns.items())
    spark.createDataFrame([tuple(columns.values())], ddl).coalesce(1).write.mode("append").parquet(f"{base}/season={season}")


def test_columns_of_several_types_get_the_type_they_agree_on(spark, scratch):
    season_file(spark, scratch, "2020-21", k=1, v=10)
    season_file(spark, scratch, "2021-22", k=2, v="ten")
    season_file(spark, scratch, "2021-22", k=3, v=2.5, w="w")
    season_file(spark, scratch, "2022-23", k=4)
    scan = scan_season_table(spark, scratch)
    assert dict(scan.rows.dtypes) == {"k": "bigint", "v": "string", "w": "string", "season": "string"} and scan.n_rows == 4
    assert sorted((r.k, r.v, r.w, r.season) for r in scan.rows.collect()) == [
        (1, "10", None, "2020-21"), (2, "ten", None, "2021-22"), (3, "2.5", "w", "2021-22"), (4, None, None, "2022-23")]
    assert sorted((r.k, r.v) for r in read_parquet_recursive_merged(spark, scratch).collect()) == [(1, "10"), (2, "ten"), (3, "2.5"), (4, None)]
    jobs.fact_matches_job(spark, scratch, f"{scratch}-facts")
    assert sorted((r.k, r.v) for r in read_season_table(spark, f"{scratch}-facts").collect()) == [(1, "10"), (2, "ten"), (3, "2.5"), (4, None)]
    season_file(spark, f"{scratch}/n", "2020-21", v=1)
    season_file(spark, f"{scratch}/n", "2021-22", v=2.5)
    assert dict(scan_season_table(spark, f"{scratch}/n").rows.dtypes)["v"] == "double"


def test_broken_files_are_listed_and_the_rest_is_exported(spark, scratch):
    base = f"{scratch}/building"
    season_file(spark, base, "2020-21", k=1, v="a")
    season_file(spark, base, "2021-22", k=2, v=5)
    put(local(base) / "season=2021-22" / "part-x.parquet", b"PAR1 is not enough")
    put(local(base) / "season=2022-23" / "part-y.parquet", b"PAR1" + b"x" * 50 + b"PAR1")
    jobs.all_seasons_csv_job(spark, base, f"{scratch}/csv")
    assert sorted((r.k, r.v) for r in spark.read.option("header", "true").csv(f"{scratch}/csv").collect()) == [("1", "a"), ("2", "5")]
    listed = spark.read.parquet(f"{scratch}/csv_rejects").collect()
    assert sorted(r.path.rsplit("/", 1)[-1] for r in listed) == ["part-x.parquet", "part-y.parquet"] and all(r.error for r in listed)
    (local(base) / "season=2021-22" / "part-x.parquet").unlink()
    (local(base) / "season=2022-23" / "part-y.parquet").unlink()
    jobs.all_seasons_csv_job(spark, base, f"{scratch}/csv")
    assert not (local(scratch) / "csv_rejects").exists()
    with pytest.raises(ValueError):
        put(local(base) / "broken.parquet", b"x")
        read_parquet_recursive_merged(spark, base)


def test_broken_files_where_types_agree_are_never_opened(spark, scratch):
    season_file(spark, scratch, "2020-21", k=1)
    put(local(scratch) / "season=2020-21" / "part-x.parquet", b"no parquet")
    scan = scan_season_table(spark, scratch)
    assert [r.k for r in scan.rows.collect()] == [1] and scan.broken == 1


def test_files_of_one_season_keep_their_own_layouts(spark, scratch):
    """A batch season without a date, then an ingested file that has one: its dates are found."""
    from pyspark.sql.types import StringType, StructField, StructType

    from zoneflow.streaming import incremental_landing_to_raw

    base = local(scratch) / "landing"
    put(base / "2020-21" / "a.csv", "day,week\nFri,7\n")
    jobs.landing_to_raw(spark, f"file:{base}", f"{scratch}/raw")
    (base / "2020-21" / "a.csv").unlink()
    put(base / "2020-21" / "b.csv", "Date\n(Tue) 14 Sep 2021 (W37)\n")
    schema = StructType([StructField("Date", StringType())])
    incremental_landing_to_raw(spark, f"file:{base}", f"{scratch}/raw", schema, f"{scratch}/ckpt")
    put(base / "2020-21" / "c.csv", "datetime\n2020-10-05 10:00:00\n")
    (base / "2020-21" / "b.csv").unlink()
    incremental_landing_to_raw(spark, f"file:{base}", f"{scratch}/raw", StructType([StructField("datetime", StringType())]), f"{scratch}/ckpt")
    jobs.match_dates_job(spark, f"{scratch}/raw", f"{scratch}/dates")
    got = sorted(((r.dateonly, r.day, r.week) for r in read_season_table(spark, f"{scratch}/dates").collect()), key=repr)
    assert got == [("2020-10-05", "Mon", 41), ("2021-09-14", "Tue", 37), (None, "Fri", 7)]
    jobs.match_dates_job(spark, f"{scratch}/dates", f"{scratch}/again")
    again = sorted(((r.dateonly, r.day, r.week) for r in read_season_table(spark, f"{scratch}/again").collect()), key=repr)
    assert again == got


def test_number_of_stage_jobs_does_not_depend_on_the_seasons(spark, scratch):
    def jobs_of(n):
        for k in range(n):
            season_file(spark, f"{scratch}/{n}", f"20{10 + k}-{11 + k}", **({"Date": "(Tue) 14 Sep 2021"} if k % 2 else {"datetime": "2020-10-05"}))
        spark.sparkContext.setJobGroup(f"stage-{n}", "")
        jobs.match_dates_job(spark, f"{scratch}/{n}", f"{scratch}/{n}-out")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"stage-{n}"))

    assert jobs_of(2) == jobs_of(9) > 0


def test_files_that_spark_did_not_write(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    base = local(scratch)
    base.mkdir(parents=True)
    pq.write_table(pa.table({"k": [1], "when": pa.array([0], pa.timestamp("us")), "tags": [["a"]]}), base / "x.parquet")
    rows = scan_parquet(spark, scratch).rows
    assert rows.columns == ["k", "when", "tags"] and [(r.k, r.tags) for r in rows.collect()] == [(1, ["a"])]


def test_missing_table(spark, scratch):
    assert scan_season_table(spark, f"{scratch}/none") is None
