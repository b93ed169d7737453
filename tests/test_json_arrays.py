"""Large JSON arrays cut by byte ranges, against Spark's own multi-line read."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql.types import LongType, StructField, StructType

from zoneflow.sources import read_json_multiline
from zoneflow.sources.json_arrays import SOURCE_FILE, read_json_arrays


def local(path):
    from pathlib import Path

    return Path(path.replace("file:", "", 1))


def made_up(rng, depth=0):
    words = ["plain", 'quo"te', "back\\slash", "brace } { ] [", "line\nbreak", "é😀", "\\", '\\"', "}", ""]
    kind = rng.randrange(5 if depth < 3 else 3)
    if kind == 3:
        return {rng.choice("abc"): made_up(rng, depth + 1) for _ in range(rng.randrange(3))}
    if kind == 4:
        return [made_up(rng, depth + 1) for _ in range(rng.randrange(3))]
    return rng.choice([rng.choice(words), rng.randrange(100), None])


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", str(size)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", opening)


@pytest.mark.parametrize("size", [37, 300])
def test_objects_in_tiny_ranges_equal_the_whole_read(spark, scratch, small_ranges, size):
    rng = random.Random(size)
    base = local(scratch)
    base.mkdir(parents=True)
    want = []
    for k in range(6):
        objects = [{"id": 100 * k + i, "t": made_up(rng), "long": "}{" * rng.randrange(40)} for i in range(15 if k else 1)]
        want += [(o["id"], json.dumps(o["t"], sort_keys=True), o["long"], f"f{k}.json") for o in objects]
        text = json.dumps(objects if k else objects[0], indent=[None, 2][k % 2], ensure_ascii=bool(k % 3))
        (base / f"f{k}.json").write_text(("﻿" if k == 4 else "") + text + "\n" * (k % 2))
    (base / "empty.json").write_text("[]")
    (base / "members.json").write_text('[{}, { }, {"id": -1}]')
    small_ranges(size)
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("id", LongType()), StructField("t", StringType()), StructField("long", StringType())])
    rows, rejects = read_json_arrays(spark, scratch, schema, "f*.json")
    got = sorted((r["id"], json.dumps(json.loads(r.t) if (r.t or "")[:1] in ("{", "[") else r.t, sort_keys=True), r.long,
                  r[SOURCE_FILE].rsplit("/", 1)[-1]) for r in rows.collect())
    whole = sorted((r["id"], json.dumps(json.loads(r.t) if (r.t or "")[:1] in ("{", "[") else r.t, sort_keys=True), r.long)
                   for r in read_json_multiline(spark, f"{scratch}/f*.json", schema).collect())
    assert [g[:3] for g in got] == whole and [(g[0], g[3]) for g in got] == sorted((w[0], w[3]) for w in want)
    assert rejects.isEmpty()
    rows, rejects = read_json_arrays(spark, scratch, schema, "[em]*.json")
    assert sorted((r.id for r in rows.collect()), key=repr) == [-1, None, None] and rejects.isEmpty()


def test_a_file_is_read_by_many_tasks(spark, scratch, small_ranges):
    base = local(scratch)
    base.mkdir(parents=True)
    objects = [{"k": i, "s": f"text {i} }}{{ \\" * 5, "in": {"v": [i]}} for i in range(30_000)]
    (base / "big.json").write_text(json.dumps(objects))
    small_ranges(256 * 1024)
    rows, rejects = read_json_arrays(spark, scratch)
    whole = read_json_multiline(spark, scratch)
    from zoneflow.sources.json_arrays import _fragments

    assert _fragments(spark, scratch, "*").rdd.getNumPartitions() > 8 > 1 == whole.rdd.getNumPartitions()
    assert dict(rows.drop(SOURCE_FILE).dtypes) == dict(whole.dtypes)
    columns = whole.columns
    assert rows.select(*columns).exceptAll(whole).isEmpty() and rows.count() == whole.count() == 30_000 and rejects.isEmpty()


def test_what_is_no_object_is_listed(spark, scratch, small_ranges):
    base = local(scratch)
    base.mkdir(parents=True)
    (base / "a.json").write_text('[{"k": 1}, oops, {"k": 2}]')
    (base / "b.json").write_text('[{"k": 3}, {"k": "open')
    (base / "c.json").write_text("not json")
    (base / "d.json").write_text('[{"k": 4}, {"k": 5')
    for size in (7, 1 << 20):
        small_ranges(size)
        rows, rejects = read_json_arrays(spark, scratch)
        assert sorted(r.k for r in rows.collect()) == [1, 2, 3, 4]
        assert sorted((r.path.rsplit("/", 1)[-1], r.record.strip(" ,")) for r in rejects.collect()) == [
            ("a.json", "oops"), ("b.json", '{"k": "open'), ("c.json", "not json"), ("d.json", '{"k": 5')]


def test_rejects_and_rows_can_be_counted_alone(spark, scratch):
    base = local(scratch)
    base.mkdir(parents=True)
    (base / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    for text, bad in (('[{"k": 3}]', 0), ('[{"k": 3}, {"k": nope}]', 1)):
        (base / "b.json").write_text(text)
        rows, rejects = read_json_arrays(spark, scratch, StructType([StructField("k", LongType())]))
        assert rejects.isEmpty() == (bad == 0) and rejects.count() == bad
        assert rows.count() == 3 and not rows.isEmpty()
