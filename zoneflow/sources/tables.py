"""Parquet tables whose files need not agree: schemas from footers, one scan per group of schemas.

``scan_parquet`` reads all footers in a distributed job (``footer_manifest``).  Where files agree on the types
of the columns they share, one scan with the union of all columns reads them.  Where a column is, say, an int in one
file and text in another, files are grouped by the types of such columns, each group is a scan of its own, and
the groups are cast to the agreed types before the union.  Files without a readable footer are left out and listed.

The footers also say which columns each file really has, which a table read with merged schemas no longer shows.
A job that writes rows of several source layouts by one plan gives all its files the same columns; it notes in
``SOURCE_COLUMNS`` of each row which of them the row's source had (one dictionary entry per layout in the file).  Jobs
whose rules depend on a column being there ask ``TableScan.has``: a season may hold rows and files of several
layouts, and nothing has to be kept in step beside the table.  Readers of this package do not show that column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zoneflow.sources.manifests import file_key, file_path, footer_manifest, for_join, reader_path, schema_of

LAYOUT = "_layout"
SOURCE_COLUMNS = "_source_columns"
_BETWEEN = "\x1f"


def source_columns(names: Iterable[str]) -> str:
    """What ``SOURCE_COLUMNS`` holds for a source with these columns."""
    return _BETWEEN + "".join(n.lower() + _BETWEEN for n in names)


class TableScan:
    """Rows of a table, the files that are none of it, and the columns of each file.

    ``rows`` is ``None`` where no file has a schema; ``n_rows`` counts rows by footers, ``broken`` unreadable files.
    """

    def __init__(self, rows: DataFrame | None, footers: DataFrame, columns: Sequence[frozenset[str]], n_rows: int, broken: int):
        self.rows, self.footers, self.columns, self.n_rows, self.broken = rows, footers, columns, n_rows, broken

    def rejects(self) -> DataFrame:
        """``(path, error)`` of the files that are no readable parquet."""
        return self.footers.filter(F.col("schema").isNull()).select("path", "error")

    def has(self, column: str) -> Column:
        """Whether the source of a row, else its file, has ``column`` (rows read with ``tagged``; names in any case)."""
        having = [k for k, names in enumerate(self.columns) if column.lower() in names]
        in_file = F.lit(bool(having)) if len(having) in (0, len(self.columns)) else F.col(LAYOUT).isin(having)
        if not any(SOURCE_COLUMNS in names for names in self.columns):
            return in_file
        return F.coalesce(F.contains(F.col(SOURCE_COLUMNS), F.lit(source_columns([column]))), in_file)


def untagged(rows: DataFrame) -> DataFrame:
    return rows.drop(LAYOUT, SOURCE_COLUMNS)


def scan_parquet(spark: SparkSession, paths: str | Sequence[str], base: str | None = None, tagged: bool = False,
                 recursive: bool = False) -> TableScan:
    """The parquet files below ``paths``, read whatever their schemas are.

    Folders named ``column=value`` below ``base`` are partition columns (not with ``recursive``).  ``tagged``
    adds the column ``LAYOUT`` that ``TableScan.has`` looks at and leaves ``SOURCE_COLUMNS`` there
    (``untagged`` takes both away).  Missing columns are null.
    """
    from zoneflow.operators.schema import agreed_type, as_type

    footers = footer_manifest(spark, paths)
    found = footers.groupBy("schema").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).collect()
    broken = sum(r["files"] for r in found if r["schema"] is None)
    kinds = sorted((r for r in found if r["schema"] is not None), key=lambda r: (-r["files"], r["schema"]))
    if not kinds:
        return TableScan(None, footers, [], 0, broken)
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    schemas = [{(f.name if exact else f.name.lower()): f for f in schema_of(r["schema"]).fields} for r in kinds]
    names = {key: f.name for schema in reversed(schemas) for key, f in schema.items()}
    names = {key: names[key] for schema in schemas for key in schema}
    types = {key: list(dict.fromkeys(s[key].dataType.simpleString() for s in schemas if key in s)) for key in names}
    agreed = {key: agreed_type(t) for key, t in types.items()}
    unsettled = [key for key in names if len(types[key]) > 1]
    files = sum(r["files"] for r in kinds)
    ids = spark.createDataFrame([(r["schema"], k) for k, r in enumerate(kinds)], f"schema string, {LAYOUT} int")
    numbered = footers.join(F.broadcast(ids), "schema").select(F.col("key").alias("_file"), "path", LAYOUT)

    def scan(own: dict[str, str], which: list[str] | None) -> DataFrame:
        fields = [f"`{names[key]}` {own.get(key, agreed[key])}" for key in names]
        reader = spark.read.schema(StructType.fromDDL(", ".join(fields))).option("recursiveFileLookup", str(recursive).lower())
        if base is not None:
            reader = reader.option("basePath", base)
        rows = reader.parquet(*([paths] if isinstance(paths, str) else paths) if which is None else map(reader_path, which))
        if which is None and broken:  # pruned when files are listed: they are never opened
            rows = rows.filter(~file_path().isin([r["path"] for r in footers.filter("schema is null").select("path").collect()]))
        values = [as_type(names[key], own.get(key, agreed[key]), agreed[key]) for key in names]
        others = [F.col(f"`{c}`") for c in rows.columns if (c if exact else c.lower()) not in names]
        return rows.select(*values, *others, *([file_key().alias("_file")] if tagged and len(kinds) > 1 else []))

    if not unsettled:
        rows = scan({}, None)
    else:
        groups: dict[tuple, list[int]] = {}
        for k, schema in enumerate(schemas):
            groups.setdefault(tuple(schema[c].dataType.simpleString() if c in schema else None for c in unsettled), []).append(k)
        parts = []
        for kind, members in groups.items():
            own = {c: t for c, t in zip(unsettled, kind, strict=True) if t is not None}
            which = [r["path"] for r in numbered.filter(F.col(LAYOUT).isin(members)).select("path").collect()]
            parts.append(scan(own, which))
        rows = reduce(lambda a, b: a.unionByName(b), parts)
    if tagged and len(kinds) > 1:
        rows = rows.join(for_join(numbered.select("_file", LAYOUT), files), "_file").drop("_file")
    if not tagged:
        rows = rows.drop(SOURCE_COLUMNS)
    columns = [frozenset(key.lower() for key in schema) for schema in schemas]
    return TableScan(rows, footers, columns, sum(r["rows"] for r in kinds), broken)


def scan_season_table(spark: SparkSession, path: str, seasons: Iterable[str] | None = None, tagged: bool = False) -> TableScan | None:
    """``scan_parquet`` of a ``season=yyyy-yy`` partitioned table; other sub-folders are ignored.

    With ``seasons`` only those folders are listed and only their footers are read.  ``None`` when
    the table has no such partition.
    """
    from zoneflow.sources.seasons import season_partitions

    base = path.rstrip("/")
    wanted = None if seasons is None else set(seasons)
    there = season_partitions(spark, path)
    folders = [f"{base}/season={s}" for s in there if wanted is None or s in wanted]
    if not folders:
        return None
    try:
        return scan_parquet(spark, folders, base=path, tagged=tagged)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return None
        raise


def row_counts_from_footers(spark: SparkSession, path: str, by: str = "season", filled: str | None = None) -> DataFrame:
    """``(by, n_rows)``: rows per partition of a parquet table (with ``filled``: those where that column is not null), A2.

    Counted from file footers alone: parquet is read through Spark's version 2 source with aggregate push-down, in
    a session of its own as both are session settings.
    """
    session = spark.newSession()
    v1 = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counted = session.read.parquet(path).groupBy(by).agg(F.count(F.lit(1) if filled is None else F.col(filled)).alias("n_rows"))
    return counted if filled is None else counted.filter("n_rows > 0")
