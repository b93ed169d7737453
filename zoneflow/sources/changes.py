"""Which seasons' input files changed since the last run (K2).

A run notes beside its target, below ``<target>_inputs``, a fingerprint of each season's input files: how many, how
many bytes, and an order-free hash of their paths, sizes and times.  The next run lists the files again
and handles the seasons whose fingerprint is another one or new.  Files are listed and hashed by Spark; what comes to the
driver is one row per season.  A season whose folder is gone is left as it is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.sinks.writers import path_exists, replace_partitions
from zoneflow.sources.manifests import file_path, written
from zoneflow.sources.seasons import season_of_path

_COLUMNS = ("files", "bytes", "print")


def input_fingerprints(spark: SparkSession, folders: Mapping[str, str], base: str) -> DataFrame:
    """``(season, files, bytes, print)`` of the season folders of ``base`` (season to path), each listed recursively."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(folders.values()))
    one = F.xxhash64(file_path(), F.col("length"), F.col("modificationTime"))
    files = listed.select(season_of_path(base).alias("season"), "length", one.alias("one"))
    return files.groupBy("season").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor("one").alias("print"))


def changed_seasons(spark: SparkSession, folders: Mapping[str, str], base: str, target: str) -> tuple[list[str], DataFrame | None]:
    """The seasons of ``folders`` to handle, and the fingerprints to note once that is done (``note_inputs``)."""
    if not folders:
        return [], None
    now = written(input_fingerprints(spark, folders, base), spark, "inputs")
    place = f"{target.rstrip('/')}_inputs"
    if path_exists(spark, target) and path_exists(spark, place):
        last = spark.read.schema("files long, bytes long, print long, season string").parquet(place)
        same = [F.col("season") == F.col("_season"), *[F.col(c) == F.col(f"_{c}") for c in _COLUMNS]]
        now = now.join(last.select([F.col(c).alias(f"_{c}") for c in ("season", *_COLUMNS)]), same, "left_anti")
    now = written(now, spark, "changed-inputs")
    return sorted(r["season"] for r in now.select("season").collect()), now


def note_inputs(spark: SparkSession, fingerprints: DataFrame, target: str) -> None:
    replace_partitions(fingerprints.coalesce(1), f"{target.rstrip('/')}_inputs", ("season",))
