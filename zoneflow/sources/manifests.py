"""Manifests: one row per file, by tasks that read a file's head or foot only.

A manifest says what each file of a folder holds before any of its rows is read: the header line of
a CSV file, the schema of a parquet file.  Manifests are tables below the shared checkpoint folder.
What comes to the driver are the *different* headers or schemas, never the files; rows meet their
file's entry by ``file_key()``, the hash of the path that the scan itself reports.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zoneflow.session import scratch_dir, ship_package

#: files whose entries (about 24 bytes each) are sent to every executor; more of them are joined by a shuffle
BROADCAST_FILES = 2_000_000
#: stores that executors open without Spark; files elsewhere are handed to them whole by Spark's binary scan
OPENED_DIRECTLY = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")
_ROW_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def file_path() -> Column:
    return F.col("_metadata.file_path")


def file_key() -> Column:
    """64-bit key of the file that a scanned row comes from."""
    return F.xxhash64(file_path())


def written(df: DataFrame, spark: SparkSession, tag: str) -> DataFrame:
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def for_join(entries: DataFrame, files: int) -> DataFrame:
    """``entries`` (one short row per file), broadcast while their number allows it."""
    return F.broadcast(entries) if files <= BROADCAST_FILES else entries


def _one_file_per_task(spark: SparkSession) -> SparkSession:
    """A session of its own (same application) in which a file is never split and shares its task with none."""
    session = spark.newSession()
    for name, value in {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
                        "spark.sql.execution.arrow.maxRecordsPerBatch": "8"}.items():
        session.conf.set(name, value)
    return session


def header_manifest(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*", comment: str = "") -> DataFrame:
    """``(path, key, line)``: the header, that is the first line that is not blank, of every visible file below ``paths``.

    One task per file, which stops at its header.  Files without such a line have no row.
    ``comment`` is the character that begins lines to pass over.
    """
    lines = (_one_file_per_task(spark).read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .text(paths if isinstance(paths, str) else list(paths)).select(file_path().alias("path"), file_key().alias("key"),
                                                                           F.col("value").alias("line")))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, line in enumerate(batch.column(2).to_pylist()):
                if line.strip("﻿ \t\r\n") and not (comment and line.startswith(comment)):
                    yield batch.slice(k, 1)
                    return

    return written(lines.mapInArrow(first, "path string, key long, line string"), spark, "headers")


# -- parquet footers -----------------------------------------------------------------

_FOOTER = pa.schema([("path", pa.string()), ("key", pa.int64()), ("schema", pa.string()), ("rows", pa.int64()), ("error", pa.string())])


def _spark_schema(meta: pq.FileMetaData) -> str:
    """Spark's schema of a parquet file, as JSON: the one Spark noted there, else that of its Arrow types."""
    noted = (meta.metadata or {}).get(_ROW_SCHEMA)
    if noted:
        return noted.decode()
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(meta.schema.to_arrow_schema()).json()


def _opened(path: str, content: bytes | None):
    if content is not None:
        return pa.BufferReader(content)
    if path.startswith("file:"):
        return pa.OSFile("/" + path.removeprefix("file:").lstrip("/"))
    filesystem, inside = pafs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))
    return filesystem.open_input_file(inside)


def footer_manifest(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, key, schema, rows, error)`` of every visible file below ``paths``; ``schema`` is Spark's, as JSON.

    Files are listed by Spark and their footers read by its tasks, some tens of files each.  A file that is no
    readable parquet has a null ``schema`` and says why in ``error``.  In a store that only Spark opens
    (not one of ``OPENED_DIRECTLY``) the tasks get the files whole.
    """
    ship_package(spark)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        paths if isinstance(paths, str) else list(paths))
    some = paths if isinstance(paths, str) else paths[0]
    where = spark._jvm.org.apache.hadoop.fs.Path(some).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    content = F.lit(None).cast("binary") if where in OPENED_DIRECTLY else F.col("content")
    listed = listed.select(file_path().alias("path"), file_key().alias("key"), F.col("path").alias("open"), content.alias("content"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, content in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                try:
                    with _opened(path, content) as source:
                        meta = pq.read_metadata(source)
                        found.append((_spark_schema(meta), meta.num_rows, None))
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, TypeError, ValueError) as err:
                    found.append((None, None, f"{type(err).__name__}: {err}"))
            columns = [pa.array([f[k] for f in found], _FOOTER.field(k + 2).type) for k in range(3)]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], schema=_FOOTER)

    return written(listed.mapInArrow(read, "path string, key long, schema string, rows long, error string"), spark, "footers")


def schema_of(text: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(text))


def reader_path(path: str) -> str:
    """A path from ``_metadata.file_path`` as a reader takes it: decoded, with what could be a glob escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(path))
