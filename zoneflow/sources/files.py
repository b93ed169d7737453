"""File scans (O3-O10): CSV, multi-line JSON, parquet, mixed folders, tolerant reads.

Readers get declared schemas wherever the layout is known, which removes the
extra inference pass over the data that an untyped CSV/JSON read costs.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from zoneflow.sources.manifests import file_key, for_join, header_manifest
from zoneflow.sources.tables import SOURCE_COLUMNS, scan_parquet, source_columns

BAD_RECORD_COLUMN = "_bad_record"


def read_csv_strings(spark: SparkSession, path: str, recursive: bool = True, **options: str) -> DataFrame:
    """CSV with header; every column is text.

    Column names come from the header; every file's header is checked against
    them (``enforceSchema=false``), so a file with another column order fails
    the read instead of being assigned by position.
    """
    reader = (spark.read.option("header", "true").option("enforceSchema", "false")
              .option("recursiveFileLookup", str(recursive).lower()))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_csv_with_schema(spark: SparkSession, path: str, schema: StructType, recursive: bool = True,
                         **options: str) -> DataFrame:
    """CSV with header and a positional schema (O5); bad cells become null."""
    reader = (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", str(recursive).lower()))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_json_multiline(spark: SparkSession, path: str, schema: StructType | None = None,
                        recursive: bool = True) -> DataFrame:
    """Multi-line JSON documents (one object or an array of objects per file)."""
    reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", str(recursive).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet directory."""
    return spark.read.parquet(path)


def read_parquet_recursive_merged(spark: SparkSession, path: str) -> DataFrame:
    """Every parquet file below ``path``, column sets unioned.

    A column that files hold in different types gets the type they agree on: the widest number, else text
    (``tables.scan_parquet``).
    """
    found = scan_parquet(spark, path, recursive=True)
    if found.broken:
        raise ValueError(f"{found.broken} files below {path} are no parquet, such as {found.rejects().first()['path']}")
    if found.rows is None:
        raise ValueError(f"no parquet file below {path}")
    return found.rows


# -- CSV files that differ in their header line ------------------------------------

#: follows the last cell of a line while it is parsed, so that its place tells the number of cells
LINE_END = "\x01end"
RAGGED = "_ragged"


def header_names(line: str, sep: str = ",", quote: str = '"') -> list[str]:
    """Column names of a header line; blank and repeated names are completed by their position."""
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep, quotechar=quote), [])
    counts = Counter(n.lower() for n in names)
    return [f"_c{i}" if not n else f"{n}{i}" if counts[n.lower()] > 1 else n for i, n in enumerate(names)]


def read_csv_by_header(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*",
                       extra: Mapping[str, Column] | None = None, with_source: bool = False, **options: str) -> DataFrame | None:
    """All CSV files below ``paths`` in one scan, every cell under its own file's header name.

    Columns are text, in the order in which the files' headers first name them (case does not tell names
    apart); a file's missing columns are null.  ``extra`` names more columns, expressions over the scan such as
    the file's path.  ``RAGGED`` holds the text of a record that has more or fewer cells than its header, null for
    all others: split them with ``well_formed`` and ``ragged_records``.  Where files differ in their columns,
    ``with_source`` adds ``tables.SOURCE_COLUMNS``.  ``None`` when no file has a header.

    A manifest job looks at each file's head (``header_manifest``).  Only the different headers come to the
    driver.  With one header the scan is a plain CSV scan.  With more, lines are cut into cells by
    position and each row takes its file's layout from the manifest, so the plan has one scan for any number of
    files and headers.
    """
    sep, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    manifest = header_manifest(spark, paths, pattern, options.get("comment", ""))
    heads = manifest.groupBy("line").agg(F.min("path").alias("first"), F.count(F.lit(1)).alias("files")).orderBy("first").collect()
    if not heads:
        return None
    layouts = [header_names(h["line"], sep, quote) for h in heads]
    names: dict[str, str] = {}
    for layout in layouts:
        for name in layout:
            names.setdefault(name.lower(), name)
    extra = dict(extra or {})
    more = [c.alias(n) for n, c in extra.items()]
    reader = spark.read.option("header", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    where = paths if isinstance(paths, str) else list(paths)
    if len(layouts) == 1:
        schema = StructType([StructField(n, StringType()) for n in (*layouts[0], RAGGED)])
        # all cells are parsed whatever columns are asked for, so that a record's cells are counted
        rows = reader.schema(schema).option("mode", "PERMISSIVE").option("columnPruning", "false").option(
            "columnNameOfCorruptRecord", RAGGED).options(**options).csv(where)
        # Spark refuses a scan that needs the record's text alone, so the text goes with a cell (the comparison always holds)
        held = F.when(F.coalesce(F.col(f"`{layouts[0][0]}`"), F.lit("")) >= "", F.col(RAGGED))
        return rows.select(*[F.col(f"`{n}`") for n in layouts[0]], *more, held.alias(RAGGED))

    width = max(map(len, layouts))
    cells = StructType([StructField(f"c{i}", StringType()) for i in range(width + 1)])
    as_array = lambda prefix: F.array(*[F.col(f"{prefix}c{i}") for i in range(width + 1)])
    if options.get("multiLine", "false").lower() == "true":  # records of several lines are cut by the scan itself
        rows = reader.schema(StructType([*cells.fields, StructField("_raw", StringType())])).option(
            "columnNameOfCorruptRecord", "_raw").options(**options).csv(where)
        rows = rows.select(as_array("").alias("_cells"), F.coalesce("_raw", F.lit("")).alias("_line"), file_key().alias("_file"), *more)
        ended = F.get("_cells", "_width").isNull()
    else:
        # lines as the CSV scan gives them, without each file's header; a line that holds the separator is kept whole in _raw
        whole = {k: v for k, v in options.items() if k in ("encoding", "charset", "lineSep", "comment")}
        rows = reader.schema("_one string, _raw string").option("sep", LINE_END[0]).option("quote", "").option(
            "columnNameOfCorruptRecord", "_raw").options(**whole).csv(where)
        rows = rows.select(F.coalesce("_raw", "_one").alias("_line"), file_key().alias("_file"), *more)
        parsed = F.from_csv(F.concat("_line", F.lit(sep + LINE_END)), ", ".join(f"c{i} string" for i in range(width + 1)), options)
        rows = rows.withColumn("_parsed", parsed).select(as_array("_parsed.").alias("_cells"), "_line", "_file", *extra)
        ended = F.get("_cells", "_width") == LINE_END
    slots = [[{n.lower(): i for i, n in enumerate(layout)}.get(n, -1) for n in names] for layout in layouts]
    known = spark.createDataFrame([(h["line"], k) for k, h in enumerate(heads)], "line string, _layout int")
    files = manifest.join(F.broadcast(known), "line").select(F.col("key").alias("_file"), "_layout")
    shapes = spark.createDataFrame([(k, len(layout), slots[k], source_columns(layout)) for k, layout in enumerate(layouts)],
                                   f"_layout int, _width int, _slots array<int>, `{SOURCE_COLUMNS}` string")
    rows = rows.join(for_join(files, sum(h["files"] for h in heads)), "_file").join(F.broadcast(shapes), "_layout")
    values = [F.get("_cells", F.get("_slots", F.lit(k))).alias(n) for k, n in enumerate(names.values())]
    if with_source and len({frozenset(n.lower() for n in layout) for layout in layouts}) > 1:
        extra[SOURCE_COLUMNS] = F.col(SOURCE_COLUMNS)
    return rows.select(*values, *extra, F.when(~F.coalesce(ended, F.lit(False)), F.col("_line")).alias(RAGGED))


def well_formed(rows: DataFrame) -> DataFrame:
    """The rows of ``read_csv_by_header`` that have the cells their header names."""
    return rows.filter(F.col(RAGGED).isNull()).drop(RAGGED)


def ragged_records(rows: DataFrame, path: str, *keep: str) -> DataFrame:
    """``(path, record, parsed)`` of the others (and columns to ``keep``): the file's path (column ``path``), the record's
    text, and as JSON the cells that were read under a name."""
    cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in (path, RAGGED, *keep)]))
    return rows.filter(F.col(RAGGED).isNotNull()).select(*keep, F.col(path).alias("path"), F.col(RAGGED).alias("record"),
                                                         cells.alias("parsed"))


def read_mixed_format(spark: SparkSession, path: str, csv_schema: StructType | None = None,
                      json_schema: StructType | None = None, csv_options: dict | None = None
                      ) -> tuple[DataFrame | None, DataFrame | None]:
    """A folder holding ``*.csv`` and ``*.json`` (other files ignored).

    One read per format over the whole folder -- not one read per file.  A
    format with no files gives ``None`` when its schema has to be inferred.
    Without a CSV schema, cells are named by their own file's header (``read_csv_by_header``); columns
    that a file lacks are null, as for JSON, and records that don't fit their header are left out.
    """
    return read_csv_folder(spark, path, csv_schema, csv_options), read_json_folder(spark, path, json_schema)


def read_csv_folder(spark: SparkSession, path: str, schema: StructType | None = None, options: dict | None = None) -> DataFrame | None:
    """The ``*.csv`` files below a folder, by a positional schema or by their own headers; ``None`` when there are none."""
    options = dict(options or {})
    if schema is not None:
        return read_or_none(lambda p: spark.read.option("header", "true").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.csv").options(**options).schema(schema).csv(p), path)
    rows = read_or_none(lambda p: read_csv_by_header(spark, p, "*.csv", **options), path)
    return None if rows is None else well_formed(rows)


def read_json_folder(spark: SparkSession, path: str, json_schema: StructType | None = None) -> DataFrame | None:
    """The ``*.json`` files below a folder, each one document or an array of them; ``None`` when there are none."""
    def json_reader(p: str) -> DataFrame:
        r = (spark.read.option("multiLine", "true").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.json"))
        if json_schema is not None:
            r = r.schema(json_schema)
        return r.json(p)

    return read_or_none(json_reader, path)


def read_or_none(reader, path: str):
    try:
        return reader(path)
    except AnalysisException as err:  # nothing of that format in the folder
        if "UNABLE_TO_INFER_SCHEMA" in str(err) or "PATH_NOT_FOUND" in str(err):
            return None
        raise


def split_rejects(json_df: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """JSON rows of ``read_json_multiline``-like scans and, apart from them, ``(path, record, parsed)`` of what is no JSON."""
    if json_df is None:
        return None, None
    spark = json_df.sparkSession
    corrupt = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    if corrupt not in json_df.columns:
        return json_df, None
    rest = [c for c in json_df.columns if c != corrupt]
    path = F.col("_metadata.file_path").alias("path")
    if not rest:  # no file is JSON
        whole = spark.read.option("wholetext", "true").text(json_df.inputFiles())
        return None, whole.select(path, F.col("value").alias("record"), F.lit(None).cast("string").alias("parsed"))
    parsed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("parsed")
    bad = json_df.filter(F.col(corrupt).isNotNull()).select(path, F.col(corrupt).alias("record"), parsed)
    return json_df.filter(F.col(corrupt).isNull()).drop(corrupt), bad


def tolerant_scan(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                  **options: str) -> tuple[DataFrame, DataFrame]:
    """Read with malformed records split off instead of failing the job.

    Returns ``(good_rows, bad_rows)``; unreadable files are skipped.  ``bad_rows``
    keeps the partly parsed fields plus the raw text in ``_bad_record``.  Spark
    rejects a scan that needs the raw-text column alone (e.g. ``bad.count()``);
    write ``bad_rows`` out, or select a parsed field with it.
    """
    full = StructType(list(schema.fields) + [StructField(BAD_RECORD_COLUMN, StringType())])
    reader = (spark.read.format(fmt).schema(full).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BAD_RECORD_COLUMN)
              .option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true"))
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    good = df.filter(df[BAD_RECORD_COLUMN].isNull()).drop(BAD_RECORD_COLUMN)
    bad = df.filter(df[BAD_RECORD_COLUMN].isNotNull())
    return good, bad
