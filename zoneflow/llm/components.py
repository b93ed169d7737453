"""Connected components by alternating large-star and small-star steps, all in DataFrames.

Every step replaces edges by edges to smaller neighbours, so the number of edges
never grows; after at most a logarithmic number of rounds what remains is one star
around the smallest node of each component.  Minima are pre-aggregated map-side and
the joins back are plain equi-joins, which adaptive execution splits where a hub
node has very many edges.  Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another one.

    ``component`` is the smallest node reachable.  Loops, repeated edges, either
    direction and nulls are allowed (edges with a null end say nothing).  No edge: no row.
    """
    work = WorkTables(edges.sparkSession)
    now = work.keep(
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = work.keep(small.filter("u != v").distinct(), "cc")
        before, mark = mark, _mark(now)
        work.drop_all_but(1)
        if before == mark:
            break
    # stars: every edge leads to the smallest node, which belongs to itself
    return work.result(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal marks mean an unchanged edge set."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.xxhash64("v", "u") % 1_000_003)).first())
