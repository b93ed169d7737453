"""CSV files with line breaks inside quotes, read by many tasks.

Spark reads such a file in one task.  Here its lines are read by byte ranges.  A record ends with a line after which
the number of quotes is even, so the quotes of the ranges before tell each range whether it begins inside of a record.
Every quote counts: it is for files in which quotes stand around cells and twice inside of them only, as ``export_csv``
writes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.session import ship_package
from zoneflow.sources.files import header_names, read_csv_strings
from zoneflow.sources.manifests import file_path, written

_PIECES = pa.schema([("path", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("header", pa.bool_()), ("record", pa.binary())])
_DIALECT = {"quote": '"', "escape": '"', "multiLine": "true"}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each byte range: ``whole``; ``head``, ``middle`` and ``tail`` of those that reach over ranges."""
    out: list[tuple[str, int, str, bool, bytes]] = []
    current, held, size = None, [], 0
    inside = began = first = False
    for batch in batches:
        for path, block, value, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if start is None:
                raise ValueError(f"the byte ranges of {path} changed while it was read")
            if (path, block) != current:
                if held:
                    out.append((*current, "head" if began else "middle", first, b"\n".join(held)))
                current, held, inside, began, first = (path, block), [], bool(start), not start, block == 0
            held.append(value)
            inside ^= bool(value.count(b'"') & 1)
            if inside:
                continue
            record = b"\n".join(held)
            if record or not began:   # blank lines between records are none
                out.append((path, block, "whole" if began else "tail", first, record))
                first, size = False, size + len(record)
            held, began = [], True
            if len(out) >= 2000 or size > 4_000_000:
                yield _rows(out)
                out, size = [], 0
    if held:
        out.append((*current, "head" if began else "middle", first, b"\n".join(held)))
    yield _rows(out)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_PIECES)], schema=_PIECES)


def _checked(names: list[str]):
    """Records without the headers, each of which must hold ``names``."""
    want = [n.lower() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, header in enumerate(batch.column(0).to_pylist()):
                keep.append(not header)
                if header:
                    found = header_names(batch.column(1)[k].as_py().decode("utf-8", "replace").removesuffix("\r"))
                    if [n.lower() for n in found] != want:
                        raise ValueError(f"a file's header is {found}, not {names}")
            yield batch.filter(pa.array(keep, pa.bool_())).select([1])

    return run


def read_csv_quoted(spark: SparkSession, path: str, recursive: bool = True, **options: str) -> DataFrame:
    """CSV with header, cells with line breaks and doubled quotes; every column is text.

    Rows equal those of ``read_csv_strings`` with ``multiLine`` and ``escape='"'``, but no file is read as a whole by a task.
    """
    ship_package(spark)
    names = read_csv_strings(spark, path, recursive, **_DIALECT, **options).columns   # looks at a first header only
    text = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("lineSep", "\n").text(path)
    lines = text.select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.groupBy(F.col("path").alias("_p"), F.col("block").alias("_b")).agg(F.sum(quotes).alias("quotes"))
    begins = written(counted.select("_p", "_b", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("inside")), spark, "csv-begins")
    # one short row per byte range; a broadcast keeps the order of the lines
    joined = lines.join(F.broadcast(begins), (F.col("path") == F.col("_p")) & (F.col("block") == F.col("_b")), "left")
    pieces = joined.select("path", "block", F.col("value").cast("binary").alias("value"), "inside").mapInArrow(
        _cut, "path string, block long, kind string, header boolean, record binary")
    # a tail or middle belongs to the last head before it
    torn = pieces.filter("kind != 'whole'")
    here = Window.partitionBy("path").orderBy("block", F.when(F.col("kind") == "head", 1).otherwise(0)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    head = F.last(F.when(F.col("kind") == "head", F.col("block")), ignorenulls=True).over(here)
    mended = torn.withColumn("head", head).groupBy("path", "head").agg(
        F.array_sort(F.collect_list(F.struct("block", F.col("record").cast("string").alias("text")))).alias("all"), F.max("header").alias("header"))
    mended = mended.select("header", F.array_join(F.transform("all", lambda p: p["text"]), "\n").cast("binary").alias("record"))
    records = pieces.filter("kind = 'whole'").select("header", "record").unionByName(mended)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv(F.col("record").cast("string"), schema, {**_DIALECT, "lineSep": "\n", **options})
    return records.mapInArrow(_checked(names), "record binary").select(parsed.alias("row")).select("row.*")
