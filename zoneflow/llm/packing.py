"""Operator 1: best-fit packing into sequences of several permitted lengths.

Documents longer than the longest permitted sequence are cut into pieces of that
length and a rest.  Pieces are dealt by a hash into shards of bounded size, whose
number grows with the input, and each shard is packed on its own (best-fit
decreasing): a piece goes into the open bin that it leaves the least room in; if none
has room, a bin of the size with the least cost per token is opened.  Which sizes may be
opened is decided jointly: the shard is packed once for each largest size allowed and
the cheapest result counts, after every bin has been downsized to the cheapest size
that holds its contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import materialise, row_key

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 32            # cost of a sequence besides its length, in tokens
SHARD_PIECES = 20_000    # pieces packed together


def sequence_cost(capacity: int) -> int:
    return capacity + OVERHEAD


def best_fit(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int]]:
    """Best-fit decreasing of ``lengths`` (sorted, longest first, none above the largest capacity).

    Returns the bin of each piece and the final capacity of each bin.
    """
    capacities = tuple(sorted(capacities))
    best = None
    for most in capacities:
        if lengths and most < lengths[0]:
            continue
        allowed = [c for c in capacities if c <= most]
        bins, used, room = [], [], {}
        free = 0  # bit r is set while a bin has r tokens of room
        for n in lengths:
            above = free >> n
            if above:
                r = n + (above & -above).bit_length() - 1
                b = room[r].pop()
                if not room[r]:
                    free &= ~(1 << r)
            else:
                r = min((c for c in allowed if c >= n), key=lambda c: (sequence_cost(c) / c, c))
                b = len(used)
                used.append(0)
            used[b] += n
            bins.append(b)
            r -= n
            room.setdefault(r, []).append(b)
            free |= 1 << r
        sizes = [min((c for c in capacities if c >= u), key=lambda c: (sequence_cost(c), c)) for u in used]
        cost = sum(map(sequence_cost, sizes))
        if best is None or cost < best[0]:
            best = cost, bins, sizes
    return (best[1], best[2]) if best else ([], [])


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, id_col: str = "doc_id", text_col: str = "text",
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, n_tokens, bin_id, capacity, bin_offset``.

    Tokens are words; ``start`` is the piece's first word in its document, ``bin_offset``
    its place in the bin.  Texts without words (null, empty, blank) have one row of 0 tokens
    and no bin.  Null ids and repeated rows are packed like any other row; other columns
    are ignored.  The bins are the same for the same rows, in whatever order they come.
    Very long texts are cut into pieces of the largest capacity; an empty table gives no rows.
    """
    longest = max(capacities)
    n = F.regexp_count(F.col(text_col).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    sized = materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"),
                                    F.coalesce(n, F.lit(0)).alias("n")), "lengths")
    total = sized.agg(F.sum(F.ceil(F.col("n") / longest))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_pieces))
    pieces = (sized.filter("n > 0").withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / longest)))).select(
            F.pmod(F.xxhash64("key", "piece"), F.lit(shards)).alias("shard"), "doc_id", "key", "piece",
            (F.col("piece") * longest).alias("start"),
            F.least(F.lit(longest).cast("long"), F.col("n") - F.col("piece") * longest).alias("n_tokens")))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("bin_id", pa.int64()), ("capacity", pa.int64()), ("bin_offset", pa.int64())])

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("key", "ascending"),
                               ("piece", "ascending")])
        lengths = shard["n_tokens"].to_pylist()
        bins, sizes = best_fit(lengths, capacities)
        ends = [0] * len(sizes)
        offsets = []
        for b, length in zip(bins, lengths, strict=True):
            offsets.append(ends[b])
            ends[b] += length
        number = np.array(bins, np.int64) * shards + shard["shard"][0].as_py()
        return pa.table([shard["doc_id"], shard["piece"], shard["start"], shard["n_tokens"], pa.array(number),
                         pa.array([sizes[b] for b in bins], pa.int64()), pa.array(offsets, pa.int64())], schema=schema)

    packed = pieces.groupBy("shard").applyInArrow(
        run, "doc_id long, piece long, start long, n_tokens long, bin_id long, capacity long, bin_offset long")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    empty = sized.filter("n = 0").select("doc_id", zero.alias("piece"), zero.alias("start"), zero.alias("n_tokens"),
                                         none.alias("bin_id"), none.alias("capacity"), none.alias("bin_offset"))
    return packed.unionByName(empty)
