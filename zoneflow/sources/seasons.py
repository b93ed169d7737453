"""Season-folder scans (O1, O2).

Landing data arrives as ``<base>/<yyyy-yy>/.../*.csv``.  Instead of one job per
folder, the season folders (one metadata listing) are read by a single scan and
written by one job, however many files, headers and seasons there are.
Zones this library writes itself are Hive-partitioned (``season=yyyy-yy``) so
that season filters prune partitions at planning time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.sources.files import read_csv_by_header, well_formed
from zoneflow.sources.manifests import file_path
from zoneflow.sources.tables import SOURCE_COLUMNS

# --- fixed values ----------------------------------------------------------
SEASON_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]"   # folder names like 2021-22
SEASON_REGEX = r"\d{4}-\d{2}"
SKIPPED_SEASON = "2023-24"
PATH = "_path"
# ---------------------------------------------------------------------------


def season_of_path(base: str, path_col: str = "_metadata.file_path") -> Column:
    """Season folder directly below ``base`` in a file path, ``2021-22`` or ``season=2021-22``.

    File paths come percent-encoded; a ``+`` in them is an ordinary character.
    """
    anchor = re.escape(base.rstrip("/").rsplit("/", 1)[-1])
    path = F.url_decode(F.replace(F.col(path_col), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(path, f"/{anchor}/(?:season=)?({SEASON_REGEX})/", 1)


def season_folders(spark: SparkSession, base: str) -> list[tuple[str, str]]:
    """``(season, path)`` of every folder directly below ``base`` named like ``2021-22``.

    A metadata listing of one level (bounded by the number of seasons).
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{SEASON_GLOB}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    folders = [(st.getPath().getName(), st.getPath().toString()) for st in found if st.isDirectory()]
    return sorted(f for f in folders if re.fullmatch(SEASON_REGEX, f[0]))


def season_partitions(spark: SparkSession, table_path: str) -> list[str]:
    """Seasons present in a ``season=yyyy-yy`` partitioned table (metadata listing only)."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/season={SEASON_GLOB}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return sorted(st.getPath().getName().split("=", 1)[1] for st in found if st.isDirectory())


def season_folder_scan(spark: SparkSession, base: str, fmt: str = "csv", per_season_header: bool = True,
                       seasons: Iterable[str] | None = None, **options: str) -> DataFrame | None:
    """All files under every ``<base>/<yyyy-yy>/`` folder, plus a ``season`` column.

    Folders that do not match the season pattern are never read.  CSV columns are text and named by each
    file's own header (``read_csv_by_header``: one scan, missing columns null); records that do not fit their
    header are left out (``season_folder_records`` has them).  ``per_season_header=False`` and other formats read
    everything with one schema.  ``seasons`` limits the scan to those folders.  Returns ``None`` when there
    is no season folder.
    """
    if fmt == "csv" and per_season_header:
        rows = season_folder_records(spark, base, seasons, **options)
        return None if rows is None else well_formed(rows.drop(PATH))
    folders = _wanted_folders(spark, base, seasons)
    if not folders:
        return None
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if fmt == "csv":
        # one header for all: a file with another header line fails instead of shifting columns
        reader = reader.option("header", "true").option("enforceSchema", "false")
    return reader.options(**options).load(folders).select("*", season_of_path(base).alias("season"))


def _wanted_folders(spark: SparkSession, base: str, seasons: Iterable[str] | None) -> list[str]:
    wanted = set(seasons) if seasons is not None else None
    return [p for s, p in season_folders(spark, base) if wanted is None or s in wanted]


def season_folder_records(spark: SparkSession, base: str, seasons: Iterable[str] | None = None, with_source: bool = False,
                          **options: str) -> DataFrame | None:
    """The CSV scan of ``season_folder_scan`` with every record: columns, ``season``, ``PATH`` and ``RAGGED``
    (``with_source``: as in ``read_csv_by_header``)."""
    folders = _wanted_folders(spark, base, seasons)
    if not folders:
        return None
    return read_csv_by_header(spark, folders, extra={"season": season_of_path(base), PATH: file_path()},
                              with_source=with_source, **options)


def exclude_seasons(df: DataFrame, *seasons: str, column: str = "season") -> DataFrame:
    """Drop the given seasons; on a ``season=`` partitioned table this prunes folders.  Rows without one stay."""
    if not seasons:
        return df
    return df.filter(~F.col(column).isin(list(seasons)) | F.col(column).isNull())


def only_seasons(df: DataFrame, *seasons: str, column: str = "season") -> DataFrame:
    """The rows that ``exclude_seasons`` drops."""
    return df.filter(F.col(column).isin(list(seasons)))


def read_season_table(spark: SparkSession, path: str, merge_schema: bool = True,
                      seasons: Iterable[str] | None = None) -> DataFrame | None:
    """A ``season=yyyy-yy`` partitioned parquet table; other sub-folders are ignored.

    With ``seasons`` only those folders are listed and only their footers are read.
    ``None`` when the table has no such partition (nothing to process).
    """
    base = path.rstrip("/")
    if seasons is None:
        paths = [f"{base}/season={SEASON_GLOB}"]
    else:
        wanted = set(seasons)
        paths = [f"{base}/season={s}" for s in season_partitions(spark, path) if s in wanted]
    if not paths:
        return None
    try:
        rows = spark.read.option("basePath", path).option("mergeSchema", str(merge_schema).lower()).parquet(*paths)
        return rows.drop(SOURCE_COLUMNS)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return None
        raise
