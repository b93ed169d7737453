"""Writers (K1-K8) and result pages.

Rules kept by every writer:

* never write to a path the plan reads (stage outputs go to the next zone);
* a replaced target is only touched after the new data exists: whole tables are
  written to a folder beside it and swapped in by two renames (a reader that opens the
  target between them finds none), partition replacement commits per job;
* one action per output, no ``count()`` guard before a write;
* the layout of an output does not depend on its size: parallel part files, or one
  file where the caller asks for one.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from zoneflow.functions.render import row_as_json_array

log = logging.getLogger(__name__)


# -- filesystem helpers (metadata operations only) ---------------------------

def filesystem(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path objects for ``path`` (metadata operations only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return bool(fs.exists(p))


def data_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Visible data files directly in ``path`` (names not starting with ``_``/``.``)."""
    fs, p = filesystem(spark, path)
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append(status.getPath().toString())
    return out


def move_path(spark: SparkSession, src: str, dst: str) -> None:
    """Rename ``src`` to ``dst`` (parent folders are created)."""
    fs, s = filesystem(spark, src)
    _, d = filesystem(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"could not move {src} to {dst}")


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def swap_in(spark: SparkSession, ready: str, path: str) -> str:
    """Make the finished folder ``ready`` the new ``path``; what was there goes last."""
    old = f"{path.rstrip('/')}._old-{uuid.uuid4().hex[:8]}"
    if path_exists(spark, path):
        move_path(spark, path, old)
    move_path(spark, ready, path)
    remove_path(spark, old)
    return path


def _staged(spark: SparkSession, path: str, write) -> str:
    """Run ``write(folder)`` on a new folder beside ``path`` and swap it in; a failure leaves ``path`` alone."""
    ready = f"{path.rstrip('/')}._new-{uuid.uuid4().hex[:8]}"
    try:
        write(ready)
    except BaseException:
        remove_path(spark, ready)
        raise
    return swap_in(spark, ready, path)


# -- K1 / K3 / K4: whole-table parquet ---------------------------------------

def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy",
                  partition_by: Sequence[str] = ()) -> str:
    """Parquet directory, replaced (default) or appended; snappy-compressed.

    Replacing is safe: a job that fails leaves the old table as it was.
    """
    def write(folder: str, how: str = "errorifexists") -> None:
        writer = df.write.mode(how).option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)

    if mode == "overwrite":
        return _staged(df.sparkSession, path, write)
    write(path, mode)
    return path


def append_parquet(df: DataFrame, path: str) -> str:
    """Explicit append sink (K3); re-running appends again by design."""
    return write_parquet(df, path, mode="append")


# -- K2: replace only the partitions present in the data ---------------------

def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("season",),
                       fmt: str = "parquet", **options: str) -> str:
    """Overwrite the partitions that ``df`` holds; all other partitions stay as they are.

    Uses Spark's dynamic partition overwrite: new files are staged and swapped
    in at job commit, so a failed job leaves the old partition intact.
    """
    writer = (df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
              .partitionBy(*partition_by))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


# -- K8: skip empty results ----------------------------------------------------

def write_if_nonempty(df: DataFrame, write, *args, **kwargs):
    """Run ``write(df, *args, **kwargs)`` only if ``df`` has a row (a limit-1 probe)."""
    if not df.take(1):
        log.warning("empty result: nothing written")
        return None
    return write(df, *args, **kwargs)


def replace_side_table(spark: SparkSession, df: DataFrame | None, path: str) -> str | None:
    """Make ``path`` hold the rows of ``df``, or nothing at all where there are none: it tells of the last run only."""
    if df is not None and df.take(1):
        return write_parquet(df, path)
    remove_path(spark, path)
    return None


# -- K5 / K6: published tables, in one file where the caller asks for it ---------

#: Bytes that one task copies to their place in a single CSV file.
COPY_BYTES = 64 << 20


def _local_path(spark: SparkSession, path: str) -> str:
    return filesystem(spark, path)[1].toUri().getPath()


def _joined_csv(df: DataFrame, folder: str, options: dict[str, str]) -> None:
    """One CSV file in ``folder``, which lies on a file system that all machines mount.

    Tasks write their rows as files of their own; other tasks copy these, piece by piece, to their places in the
    single file.  A task that runs again writes the same bytes to the same place.
    """
    spark = df.sparkSession
    rows, head = f"{folder}_rows", f"{folder}_head"
    plain = {**options, "compression": "none"}
    try:
        df.write.format("csv").options(**{**plain, "header": "false"}).save(rows)
        files = []
        if str(options.get("header", "false")).lower() == "true":
            spark.createDataFrame([], df.schema).write.format("csv").options(**plain).save(head)
            files += sorted(data_files(spark, head))
        files += sorted(data_files(spark, rows))
        pieces, end = [], 0
        for file in files:
            fs, p = filesystem(spark, file)
            size = fs.getFileStatus(p).getLen()
            pieces += [(_local_path(spark, file), at, min(COPY_BYTES, size - at), end + at) for at in range(0, size, COPY_BYTES)]
            end += size
        fs, p = filesystem(spark, folder)
        fs.mkdirs(p)
        target = f"{_local_path(spark, folder)}/part-00000-{uuid.uuid4()}.csv"
        with open(target, "wb") as out:
            out.truncate(end)

        def copy(piece: tuple[str, int, int, int]) -> None:
            name, at, left, to = piece
            with open(name, "rb") as source, open(target, "r+b") as out:
                source.seek(at)
                out.seek(to)
                while left:
                    data = source.read(min(left, 1 << 20))
                    if not data:
                        raise OSError(f"{name} ends too early")
                    out.write(data)
                    left -= len(data)

        spark.sparkContext.parallelize(pieces, max(len(pieces), 1)).foreach(copy)
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")).close()
    finally:
        for path in (rows, head):
            remove_path(spark, path)


def publish(df: DataFrame, path: str, fmt: str = "parquet", one_file: bool = False, **options: str) -> str:
    """Replace ``path`` by ``df``: parallel part files, or with ``one_file`` a single one.

    The plan is evaluated in parallel and once.  A single CSV file below ``file:`` (a disk that all machines mount)
    is put together by many tasks.  Any other single file is first staged as parquet, which keeps every value, and
    one task then writes it.
    """
    spark = df.sparkSession
    if not one_file:
        return _staged(spark, path, lambda folder: df.write.format(fmt).options(**options).save(folder))
    own = {"compression", "codec", "encoding", "charset"} & {k.lower() for k in options}
    if fmt == "csv" and not own and filesystem(spark, path)[0].getScheme() == "file":
        return _staged(spark, path, lambda folder: _joined_csv(df, folder, options))
    parts = f"{path.rstrip('/')}._parts-{uuid.uuid4().hex[:8]}"
    try:
        df.write.parquet(parts)
        staged = spark.read.schema(df.schema).parquet(parts).repartition(1)
        return _staged(spark, path, lambda folder: staged.write.format(fmt).options(**options).save(folder))
    finally:
        remove_path(spark, parts)


def write_single_parquet(df: DataFrame, path: str) -> str:
    """K5: a dimension as one parquet file."""
    return publish(df, path, "parquet", one_file=True)


#: Dates as text, and blanks, quotes and empty strings kept, so that an export reads back as it was.
CSV_EXPORT_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
                      "timestampFormat": "yyyy-MM-dd HH:mm:ss", "escape": '"', "emptyValue": '""',
                      "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_csv(df: DataFrame, path: str, one_file: bool = False, **options: str) -> str | None:
    """CSV with header; nothing is written for an empty result.

    Values may hold line breaks and quotes: read them back with ``multiLine`` and
    ``escape='"'``.
    """
    return write_if_nonempty(df, publish, path, "csv", one_file, **{**CSV_EXPORT_OPTIONS, **options})


def export_single_csv(df: DataFrame, path: str, **options: str) -> str | None:
    """K6: one CSV file with header; nothing is written for an empty result."""
    return export_csv(df, path, one_file=True, **options)


# -- K7 / S1 / S2: serving ------------------------------------------------------

def json_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON array of text values per row, in a column named ``data``."""
    return df.select(row_as_json_array(df, columns).alias("data"))


def write_json_rows(df: DataFrame, path: str) -> str:
    """K7 at scale: JSON-lines data rows plus the column list in ``_columns``.

    Spark readers skip ``_``-prefixed names, so ``spark.read.text(path)``
    returns the data rows only.
    """
    spark = df.sparkSession
    # one row built on the JVM side (no Python worker, one partition)
    header = spark.range(1, numPartitions=1).select(F.lit(json.dumps(df.columns)).alias("value"))

    def write(folder: str) -> None:
        json_rows(df).write.text(folder)
        header.write.text(f"{folder}/_columns")

    return _staged(spark, path, write)


def preview_rows(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a fixed order (a top-k, not a global sort)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def page_document(df: DataFrame, order_by: str, limit: int, after: object | None = None) -> DataFrame:
    """One row ``document, next``: a page of ``limit`` rows as ``{"columns": [...], "data": [[text|null, ...], ...]}``.

    Pages follow ``order_by``, a unique column without nulls; ``after`` is the ``next`` of the page
    before.  ``next`` is null on the last page.
    """
    rows = df if after is None else df.filter(F.col(order_by) > F.lit(after))
    # one row more than the page tells whether another page follows
    page = rows.select(F.col(order_by).alias("_at"), row_as_json_array(df, df.columns).alias("_row")).orderBy("_at").limit(limit + 1)
    both = page.agg(F.sort_array(F.collect_list(F.struct("_at", "_row"))).alias("all"))
    here = F.slice("all", 1, limit)
    head = json.dumps(list(df.columns), separators=(",", ":"), ensure_ascii=False)
    data = F.array_join(F.transform(here, lambda x: x["_row"]), ",")
    return both.select(F.concat(F.lit('{"columns":' + head + ',"data":['), data, F.lit("]}")).alias("document"),
                       F.when(F.size("all") > limit, F.element_at(here, -1)["_at"]).alias("next"))


def serve_page(df: DataFrame, order_by: str, limit: int, after: object | None = None) -> dict:
    """``{"columns", "data", "next"}`` of one page; the caller says how many rows and goes on after ``next``."""
    row = page_document(df, order_by, limit, after).first()
    return {**json.loads(row["document"]), "next": row["next"]}


__all__ = [
    "CSV_EXPORT_OPTIONS", "append_parquet", "data_files", "export_csv", "export_single_csv", "filesystem",
    "json_rows", "move_path", "page_document", "path_exists", "preview_rows", "publish", "remove_path",
    "replace_partitions", "replace_side_table", "serve_page", "swap_in", "write_if_nonempty", "write_json_rows", "write_parquet",
    "write_single_parquet",
]
