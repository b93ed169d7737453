"""Documents in id order, dealt over all tasks: cut points, then one exchange."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import byte_values, gather, shuffle_width

LOWEST = -(1 << 63)  # the place of rows without an id: before all others

ROW_SCHEMA = pa.schema([("range", pa.int32()), ("extra", pa.bool_()), ("doc_id", pa.int64()), ("place", pa.int64()),
                        ("text_key", pa.int64()), ("z", pa.binary())])
ROW_DDL = "range int, extra boolean, doc_id long, place long, text_key long, z binary"


def cut_points(docs: DataFrame, id_col: str, ranges: int) -> np.ndarray:
    """Ids that cut the table into about equal ranges (approximate quantiles of the id column alone)."""
    if ranges < 2:
        return np.zeros(0, np.int64)
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.col(id_col).cast("long").alias("id")).approxQuantile("id", shares, 0.2 / ranges)
    return np.unique(np.array(found, np.float64)).astype(np.int64)


def first_of_ranges(docs: DataFrame, id_col: str, cuts: np.ndarray) -> list[tuple[int, int]]:
    """``(range, greatest place)`` of the ranges that have rows, in ascending order (one pair per range)."""
    schema = pa.schema([("range", pa.int32()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = batch.column(0).to_numpy()
                at = np.searchsorted(cuts, place, "right").astype(np.int32)
                keys = np.unique(at)
                most = np.full(len(cuts) + 1, LOWEST)
                np.maximum.at(most, at, place)
                yield gather({"range": pa.array(keys), "place": pa.array(most[keys])}, schema)

    places = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("place"))
    rows = places.mapInArrow(run, "range int, place long").groupBy("range").agg(F.max("place").alias("place")).collect()
    return sorted((r["range"], r["place"]) for r in rows)


def in_ranges(docs: DataFrame, cuts: np.ndarray, extras: dict[int, int] | None = None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Rows with compressed texts, one range per task, unsorted inside.

    ``extras`` maps a place to a range that gets its rows a second time (``extra``).
    """
    extras = extras or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            place = batch.column(1).to_numpy()
            at = np.searchsorted(cuts, place, "right").astype(np.int32)
            z = pa.array([pack.compress(v or b"") for v in byte_values(batch.column(3))], pa.binary())
            rows = {"range": pa.array(at), "extra": pa.array(np.zeros(len(at), bool)), "doc_id": batch.column(0),
                    "place": batch.column(1), "text_key": batch.column(2), "z": z}
            yield gather(rows, ROW_SCHEMA)
            again = [i for i, p in enumerate(place.tolist()) if p in extras]
            if again:
                few = pa.Table.from_batches([gather(rows, ROW_SCHEMA)]).take(again)
                few = few.set_column(0, ROW_SCHEMA.field(0), pa.array([extras[place[i]] for i in again], pa.int32()))
                few = few.set_column(1, ROW_SCHEMA.field(1), pa.array([True] * len(again)))
                yield from few.combine_chunks().to_batches()

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("place"),
                        F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return keyed.mapInArrow(run, ROW_DDL).repartitionById(max(len(cuts) + 1, 1), F.col("range"))


def range_count(docs: DataFrame) -> int:
    return shuffle_width(docs.sparkSession)
