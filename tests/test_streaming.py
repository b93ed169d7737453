"""Incremental landing ingestion: each landing file is written exactly once."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

from zoneflow.streaming import incremental_landing_to_raw


def land(spark, path, rows):
    spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_incremental_ingest_is_exactly_once(spark, scratch):
    landing, raw, ckpt = f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/ckpt"
    schema = StructType([StructField("v", StringType())])
    land(spark, f"{landing}/2020-21/a", ["v", "1", "2"])
    land(spark, f"{landing}/COUNTRIES", ["v", "9"])
    assert incremental_landing_to_raw(spark, landing, raw, schema, ckpt) == 2
    assert incremental_landing_to_raw(spark, landing, raw, schema, ckpt) == 0
    land(spark, f"{landing}/2021-22/b", ["v", "3"])
    assert incremental_landing_to_raw(spark, landing, raw, schema, ckpt) == 1
    got = sorted((r.v, str(r.season)) for r in spark.read.parquet(raw).collect())
    assert got == [("1", "2020-21"), ("2", "2020-21"), ("3", "2021-22")]


def test_cli_runs_a_job(spark, scratch):
    from zoneflow.plans.cli import main

    land(spark, f"{scratch}/landing/2020-21", ["v", "1"])
    assert main(["landing-to-raw", f"{scratch}/landing", f"{scratch}/raw"]) == 0
    assert [(r.v, str(r.season)) for r in spark.read.parquet(f"{scratch}/raw").collect()] == [("1", "2020-21")]


def test_cli_serve_table_and_season_limit(spark, scratch):
    import json

    from zoneflow.plans.cli import main
    from zoneflow.sinks import write_parquet

    write_parquet(spark.createDataFrame([(1, "x", "2020-21"), (2, None, "2021-22")], "k int, v string, season string"),
                  f"{scratch}/t", partition_by=("season",))
    assert main(["serve-table", f"{scratch}/t", "zf_cli_t", f"{scratch}/served"]) == 0
    rows = sorted(r.value for r in spark.read.text(f"{scratch}/served").collect())
    assert rows == ['["1","x","2020-21"]', '["2",null,"2021-22"]']
    assert json.loads(spark.read.text(f"{scratch}/served/_columns").first().value) == ["k", "v", "season"]
    assert main(["match-dates", f"{scratch}/t", f"{scratch}/dates", "--season", "2021-22"]) == 0
    assert [str(r.season) for r in spark.read.parquet(f"{scratch}/dates").collect()] == ["2021-22"]


def test_every_micro_batch_is_counted_and_batch_corrections_share_the_target(spark, scratch):
    from pathlib import Path

    from zoneflow.plans import jobs
    from zoneflow.sources import read_season_table

    landing = Path(scratch.replace("file:", "", 1)) / "land"
    (landing / "2020-21").mkdir(parents=True)
    (landing / "2021-22").mkdir()
    for k in range(104):
        (landing / ("2020-21" if k % 2 else "2021-22") / f"{k}.csv").write_text(f"v\n{k}\n")
    schema = StructType([StructField("v", StringType())])
    raw = f"{scratch}/raw"
    assert incremental_landing_to_raw(spark, f"file:{landing}", raw, schema, f"{scratch}/ckpt", max_files_per_trigger=1) == 104
    assert sorted(int(r.v) for r in read_season_table(spark, raw).collect()) == list(range(104))
    (landing / "2020-21" / "1.csv").write_text("v\n1001\n")
    jobs.landing_to_raw(spark, f"file:{landing}", raw, seasons=["2020-21"])
    assert sorted(int(r.v) for r in spark.read.parquet(raw).collect()) == sorted([*range(0, 104, 2), 1001, *range(3, 104, 2)])
    (landing / "2021-22" / "new.csv").write_text("v\n2000\n")
    assert incremental_landing_to_raw(spark, f"file:{landing}", raw, schema, f"{scratch}/ckpt") == 1
    assert read_season_table(spark, raw).count() == 105


def test_a_batch_that_runs_again_is_ingested_once(spark, scratch):
    from zoneflow.streaming.ingest import _ingest

    batch = spark.createDataFrame([("a", "2020-21"), ("b", "2021-22")], "v string, season string")
    assert _ingest(batch, 3, f"{scratch}/raw") == _ingest(batch, 3, f"{scratch}/raw") == 2
    assert _ingest(batch, 4, f"{scratch}/raw") == 2
    assert spark.read.parquet(f"{scratch}/raw").count() == 4
