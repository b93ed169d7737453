"""Incremental landing -> raw ingestion (W1 run as Structured Streaming).

The batch job ``plans.jobs.landing_to_raw`` re-reads every landing file on
each run.  At scale, landing files are immutable uploads, so this variant uses
the file stream source with an ``availableNow`` trigger: every run processes
exactly the files that arrived since the previous run (tracked in the
checkpoint), then stops.  Output rows and layout are the same as W1
(``season=yyyy-yy`` parquet partitions).

Each micro-batch is staged below ``_ingest`` in the target and then moved into the season
folders under file names that carry the batch number.  A batch that is run again after a
failure first takes away what it had moved, so files are ingested once.  The target
is an ordinary parquet table: the batch job may replace whole seasons of it (for a landing
file that was replaced under its old name, which a stream does not read again).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from zoneflow.session import checkpoint_root
from zoneflow.sinks.writers import filesystem, move_path, remove_path
from zoneflow.sources.seasons import SEASON_GLOB, season_folder_scan, season_of_path


def landing_schema(spark: SparkSession, landing: str) -> StructType:
    """Column names from the header of the landing CSV files, every column text.

    Seasons with different layouts are unioned by name (``season_folder_scan``).
    """
    rows = season_folder_scan(spark, landing)
    if rows is None:
        raise ValueError(f"no season folder below {landing}")
    return StructType([StructField(f.name, StringType()) for f in rows.schema.fields if f.name != "season"])


def stream_checkpoint(spark: SparkSession, raw: str) -> str:
    """Stable checkpoint folder for one target, below the shared checkpoint root."""
    tag = hashlib.sha1(raw.encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/zoneflow-streams/landing-to-raw-{tag}"


def incremental_landing_to_raw(spark: SparkSession, landing: str, raw: str, schema: StructType | None = None,
                               checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> int:
    """Ingest the landing files not seen before; returns the number of rows written."""
    schema = schema or landing_schema(spark, landing)
    # enforceSchema=false: a file whose header disagrees with the schema fails the
    # run instead of being assigned to columns by position
    reader = (spark.readStream.format("csv").schema(schema).option("header", "true")
              .option("enforceSchema", "false").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.load(f"{landing.rstrip('/')}/{SEASON_GLOB}")
    rows = rows.select("*", season_of_path(landing).alias("season"))
    written: list[int] = []

    def ingest(batch: DataFrame, number: int) -> None:
        written.append(_ingest(batch, number, raw))

    query = (rows.writeStream.foreachBatch(ingest)
             .option("checkpointLocation", checkpoint or stream_checkpoint(spark, raw))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return sum(written)


def _ingest(batch: DataFrame, number: int, raw: str) -> int:
    """Write one micro-batch into the season folders of ``raw``; returns its rows."""
    spark, base = batch.sparkSession, raw.rstrip("/")
    stage, prefix = f"{base}/_ingest/batch-{number}", f"ingest-{number:09d}-"
    batch.write.mode("overwrite").partitionBy("season").parquet(stage)
    fs, root = filesystem(spark, base)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for status in fs.globStatus(hpath(f"{base}/season=*/{prefix}*")) or []:  # of an earlier try
        fs.delete(status.getPath(), False)
    rows = spark.read.schema(batch.schema).parquet(stage).count()
    for status in fs.globStatus(hpath(f"{stage}/season=*/part-*")) or []:
        season = status.getPath().getParent().getName()
        move_path(spark, status.getPath().toString(), f"{base}/{season}/{prefix}{status.getPath().getName()}")
    remove_path(spark, stage)
    return rows
