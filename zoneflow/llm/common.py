"""Helpers shared by the training-data operators: words, row keys, scratch tables.

A *word* is ``[^\\x20\\x09-\\x0D]+`` after lower-casing ``A-Z``; over UTF-8 bytes
that is exactly ``bytes.lower().split()``, so words never need a regex.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.session import scratch_dir, ship_package
from zoneflow.sinks.writers import remove_path

__all__ = [
    "BITMAP_BITS", "CHUNK_BYTES", "WordCodes", "WorkTables", "byte_values", "chunks", "crc_mod", "distinct", "gather", "materialise",
    "may_hold", "mix64", "row_key", "shingle_hashes", "ship_package", "shuffle_width", "table",
    "text_shingles", "words_of",
]

#: Texts are worked on in pieces of about this many bytes, so that a task's Python
#: memory does not depend on the size of an Arrow batch.
CHUNK_BYTES = 6_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class WorkTables:
    """Tables that one operator writes below the shared checkpoint folder while it works.

    ``result`` writes the last table and removes all others; the result itself stays, as its
    reader comes later.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        """Write ``df`` and read it back (cuts lineage)."""
        path = scratch_dir(self.spark, tag)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the tables kept so far; nothing may read them any more."""
        self.drop_all_but(0)

    def drop_all_but(self, latest: int) -> None:
        """Remove the tables kept so far but for the ``latest`` ones."""
        while len(self.paths) > latest:
            remove_path(self.spark, self.paths.pop(0))

    def result(self, df: DataFrame, tag: str) -> DataFrame:
        done = materialise(df, tag)
        self.drop()
        return done


#: bits of a key bitmap: 8 MB, whatever the number of keys
BITMAP_BITS, _BITMAP_PART = 1 << 26, 1 << 15


def may_hold(rows: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false only where ``key`` is not in ``keys`` (a table with the same column).

    The keys become a bitmap of ``BITMAP_BITS`` hashed bits, which is broadcast: its size does not depend on
    their number.  More keys raise the share of rows that are flagged without need, never the reverse.
    """
    def spot(part: Column) -> Column:
        return F.pmod(part, F.lit(BITMAP_BITS))

    bits = keys.select(spot(F.col(key)).alias("_spot")).groupBy(F.floor(F.col("_spot") / _BITMAP_PART).cast("int").alias("_part")).agg(
        F.bitmap_construct_agg(F.col("_spot") % _BITMAP_PART).alias("_bits"))
    marked = rows.withColumn("_spot", spot(F.col(key))).withColumn("_here", F.floor(F.col("_spot") / _BITMAP_PART).cast("int"))
    joined = marked.join(F.broadcast(bits), F.col("_here") == F.col("_part"), "left")
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_spot % 32768 / 8 as int) + 1, 1)), 16, 10) as int)")
    held = byte.bitwiseAND(F.expr("shiftleft(1, cast(_spot % 8 as int))")) != 0
    return joined.withColumn(flag, F.coalesce(held, F.lit(False))).drop("_spot", "_here", "_part", "_bits")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of a row's id and text: rows repeated in full share it, null ids have one."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def crc_mod(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_values(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def chunks(values: Sequence[bytes | None], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, one row at least."""
    start, size = 0, 0
    for i, v in enumerate(values):
        n = len(v) if v else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if len(values) > start:
        yield start, len(values)


def words_of(value: bytes | None) -> list[bytes]:
    return value.lower().split() if value else []


class WordCodes:
    """Words of several texts as numbers: ``codes`` in text order, ``offsets`` per text
    (one more than texts), ``words`` the distinct words by code."""

    def __init__(self, values: Sequence[bytes | None]):
        texts = pa.array([v.lower() if v else b"" for v in values], pa.binary()).view(pa.string())
        cut = pc.ascii_split_whitespace(texts)
        ends, flat = cut.offsets.to_numpy() - cut.offsets[0].as_py(), cut.flatten()
        full = pc.greater(pc.binary_length(flat), 0)   # white space at either end gives an empty word
        coded = flat.filter(full).dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.offsets = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64))[ends]
        self.words = coded.dictionary.cast(pa.binary()).to_pylist()

    def hashes(self) -> np.ndarray:
        """64-bit hash of every distinct word."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(codes: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size``-word shingles of one text (shorter texts: the whole sequence; none: empty)."""
    h = hashes[codes]
    n = len(h)
    if n == 0:
        return h
    size = min(size, n)
    with np.errstate(over="ignore"):
        out = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k:n - size + 1 + k])
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted (``np.unique`` takes several times as long for the sets of one text)."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def text_shingles(codes: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, size: int, block: int = 1 << 15) -> Iterator[np.ndarray]:
    """``shingle_hashes`` of each of several texts, made in blocks that span texts."""
    every = np.empty(max(len(codes) - size + 1, 0), np.uint64)
    for lo in range(0, len(every), block):
        hi = min(lo + block, len(every))
        every[lo:hi] = shingle_hashes(codes[lo:hi + size - 1], hashes, size)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield every[a:b - size + 1] if b - a >= size else shingle_hashes(codes[a:b], hashes, size)


def gather(parts: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch out of lists or arrays by column."""
    return pa.record_batch([p if isinstance(p, pa.Array) else pa.array(p, type=f.type)
                            for f, p in zip(schema, (parts[f.name] for f in schema), strict=True)], schema=schema)
