"""Large JSON arrays read by many tasks.

Spark reads a multi-line JSON file in one task.  Here a file is cut by byte ranges at its closing braces, and a
prefix scan tells each range where it begins:

1. each range is summarised: whether it flips between inside and outside of a string, and by how much it changes the
   depth of braces, for both ways it may begin (``_summary``);
2. running sums over the ranges of a file give the state each one begins in;
3. each range cuts its objects out; objects that reach over ranges are put together from their parts.

The objects become JSON lines below the checkpoint folder, which Spark reads with as many tasks as it likes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from zoneflow.session import scratch_dir, ship_package
from zoneflow.sources.manifests import file_path, written

SOURCE_FILE = "_source_file"
_ESCAPED = re.compile(r"\\.", re.S)
_BETWEEN = " \t\r\n,[]﻿"


def _fragments(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``(path, block, file_size, value)``: pieces of text that end where a closing brace stood, in order inside a byte range."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "}").text(path)
    return text.select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("_metadata.file_size").alias("file_size"), "value")


def _counts(value: str) -> tuple[int, int, int]:
    """Of a fragment: quotes, and opening braces outside of strings if it begins outside, and if inside."""
    parts = _ESCAPED.sub("", value).split('"') if "\\" in value else value.split('"')
    return len(parts) - 1, sum(p.count("{") for p in parts[::2]), sum(p.count("{") for p in parts[1::2])


_SUMMARY = pa.schema([("path", pa.string()), ("block", pa.int64()), ("file_size", pa.int64()), ("flips", pa.int32()),
                      ("outside", pa.int64()), ("inside", pa.int64()), ("bytes", pa.int64())])


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per byte range: does it flip the string state, the change of depth if it begins outside and if inside, its bytes."""
    found: dict[tuple[str, int, int], list[int]] = {}
    for batch in batches:
        for path, block, size, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            state = found.setdefault((path, block, size), [0, 0, 0, 0])
            state[3] += len(value.encode()) + 1
            quotes, even, odd = _counts(value)
            for begun in (0, 1):
                now = begun ^ state[0]
                ends = now ^ (quotes & 1)
                state[1 + begun] += (even, odd)[now] - (ends == 0)   # the brace that ended it counts outside of strings
            state[0] ^= quotes & 1
    yield pa.record_batch([pa.array([k[i] for k in found], _SUMMARY.field(i).type) for i in range(3)]
                          + [pa.array([v[i] for v in found.values()], _SUMMARY.field(i + 3).type) for i in range(4)], schema=_SUMMARY)


_PARTS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("text", pa.string())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects of each byte range: ``whole``; ``head``, ``middle`` and ``tail`` of those that reach over ranges; ``junk`` between them."""
    current, depth, inside, text, began = None, 0, False, [], False
    out: list[tuple[str, int, str, str]] = []

    def step(path: str, block: int, value: str, brace: str) -> None:
        """One fragment; ``brace`` ended it, but for the last one of a file that ends otherwise."""
        nonlocal depth, inside, text, began
        quotes, even, odd = _counts(value)
        opened = odd if inside else even
        if depth == 0 and opened:   # between objects, hence outside of strings: the first brace begins one
            before, first, value = value.partition("{")
            if before.strip(_BETWEEN):
                out.append((path, block, "junk", before))
            text, began = [first], True
        text.append(value)
        inside ^= bool(quotes & 1)
        depth += opened
        text.append(brace)
        if inside or not brace:
            return
        depth = max(depth - 1, 0)
        if depth == 0:
            rest = "".join(text)
            if began or opened:
                out.append((path, block, "whole" if began and rest.startswith("{") else "junk", rest))
            elif rest.strip(_BETWEEN):
                out.append((path, block, "tail" if entered else "junk", rest))
            text, began = [], True

    def finish() -> None:
        if pending is not None:
            step(*current, pending, "" if open_end else "}")
            rest = "".join(text)
            if depth > 0 or inside:
                out.append((*current, "head" if began else "middle", rest))
            elif rest.strip(_BETWEEN):
                out.append((*current, "junk", rest))

    pending, open_end, entered = None, False, False
    for batch in batches:
        for path, block, value, start_inside, start_depth, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if start_inside is None:
                raise ValueError(f"the byte ranges of {path} changed while it was read")
            if (path, block) != current:
                finish()
                current, depth, inside, text, began = (path, block), start_depth, bool(start_inside), [], start_depth == 0
                entered, open_end = start_depth > 0, ends
            else:
                step(path, block, pending, "}")
            pending = value
        if len(out) >= 2000:
            yield _part_rows(out)
            out.clear()
    finish()
    yield _part_rows(out)


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_PARTS)], schema=_PARTS)


def json_array_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, text, junk)``: the objects of all JSON files below ``path``, each file one object or an array of them.

    ``junk`` marks text between objects that belongs to none, and objects that never end.  No file is
    read as a whole by a task, but an object is put together in one.
    """
    ship_package(spark)
    pieces = _fragments(spark, path, pattern)
    ranges = written(pieces.mapInArrow(
        _summary, "path string, block long, file_size long, flips int, outside long, inside long, bytes long"), spark, "json-ranges")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranges.withColumn("start_inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    begins = begins.withColumn("change", F.when(F.col("start_inside") == 0, F.col("outside")).otherwise(F.col("inside")))
    # a file that does not end with a brace counts one byte too many (a byte order mark at its head, three too few)
    whole = Window.partitionBy("path")
    spare = F.sum("bytes").over(whole) - F.col("file_size")
    open_end = (F.col("block") == F.max("block").over(whole)) & spare.isin(1, -2)
    begins = written(begins.select(F.col("path").alias("_p"), F.col("block").alias("_b"), "start_inside",
                                   F.coalesce(F.sum("change").over(before), F.lit(0)).alias("start_depth"),
                                   open_end.alias("open_end")), spark, "json-begins")
    count = begins.count()
    # a broadcast keeps the order of the fragments; beyond its bound they are sorted again
    numbered = pieces.withColumn("_n", F.monotonically_increasing_id())
    match = (F.col("path") == F.col("_p")) & (F.col("block") == F.col("_b"))
    if count <= 500_000:
        joined = numbered.join(F.broadcast(begins), match, "left")
    else:
        joined = numbered.join(begins, match, "left").sortWithinPartitions("path", "block", "_n")
    parts = written(joined.select("path", "block", "value", "start_inside", "start_depth", "open_end").mapInArrow(
        _cut, "path string, block long, kind string, text string"), spark, "json-parts")
    # a tail or middle belongs to the last head before it
    torn = parts.filter(F.col("kind").isin("head", "middle", "tail"))
    order = F.when(F.col("kind") == "head", 1).otherwise(0)
    here = Window.partitionBy("path").orderBy("block", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = F.last(F.when(F.col("kind") == "head", F.col("block")), ignorenulls=True).over(here)
    mended = torn.withColumn("head", heads).groupBy("path", "head").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("all"), F.max(F.col("kind") == "tail").alias("ended"))
    mended = mended.select("path", F.array_join(F.transform("all", lambda p: p["text"]), "").alias("text"), (~F.col("ended")).alias("junk"))
    rest = parts.filter(F.col("kind").isin("whole", "junk")).select("path", "text", (F.col("kind") == "junk").alias("junk"))
    return rest.unionByName(mended)


def read_json_arrays(spark: SparkSession, path: str, schema: StructType | None = None, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of JSON files that hold one object or an array of objects each (O6 for large files).

    Rows equal those of a multi-line read, with the file of each in ``SOURCE_FILE``.  ``rejects`` (``path, record``) is what
    is no object: text between objects, objects without an end, and records that are no JSON (with a null path where not
    even their file's name could be read).  A file with such text keeps its good objects.
    """
    objects = json_array_objects(spark, path, pattern)
    lines = scratch_dir(spark, "json-lines")
    # white space between tokens may hold line breaks; inside strings JSON writes them as escapes
    inner = F.translate(F.col("text").substr(F.lit(2), F.length("text")), "\r\n", "  ")
    name = F.to_json(F.struct(F.col("path").alias(SOURCE_FILE)))   # {"_source_file":"..."}; the object's members follow
    tagged = objects.filter(~F.col("junk")).withColumn("_name", name)
    body = F.when(F.ltrim(inner) == "}", inner).otherwise(F.concat(F.lit(","), inner))
    tagged.select(F.concat(F.expr("substring(_name, 1, length(_name) - 1)"), body).alias("value")).write.text(lines)
    corrupt = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields, StructField(SOURCE_FILE, StringType()), StructField(corrupt, StringType())]))
    rows = reader.json(lines)
    rejects = objects.filter("junk").select("path", F.col("text").alias("record"))
    if corrupt in rows.columns:
        # Spark reads no plan that needs the corrupt column alone (a count, isEmpty): the file's name is always needed with it
        both = F.length(F.concat_ws("", SOURCE_FILE)) >= 0
        bad = rows.filter(F.col(corrupt).isNotNull() & both).select(F.col(SOURCE_FILE).alias("path"), F.col(corrupt).alias("record"))
        rows, rejects = rows.filter(F.col(corrupt).isNull() & both).drop(corrupt), rejects.unionByName(bad)
    return rows, rejects
