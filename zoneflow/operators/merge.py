"""Merging records of one entity from several sources.

Sources have a priority; for every column the first source that has a non-null value
wins.  ``merge_grouped`` (one frame per source) and ``merge_by_priority`` (one frame, a
priority column such as the file path) work in two aggregates with map-side combine:

1. ``picked_rows``: per (key, source) one *whole* row stays, so values of different rows of one source
   are never mixed: the row with the fewest nulls, of those the least in its rendered form;
2. ``merge_picked``: per key each column takes the first non-null value by priority.

Rows whose key is null or empty belong to no entity: they pass through as they are (equal ones
as one group with a count).  ``duplicate_rows`` gives the rows that step 1 leaves out.  ``merge_joined`` computes
the same by a chain of full outer joins on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.casts import cast_value
from zoneflow.operators.schema import column_types
from zoneflow.session import scratch_dir

_PRIO = "_merge_prio"


def _conform(df: DataFrame, key: str, types: dict[str, str]) -> list[Column]:
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = [F.col(f"`{key}`")]
    for c, t in types.items():
        if c not in have:
            cols.append(F.lit(None).cast(t).alias(c))
        elif have[c] != t:
            cols.append(cast_value(F.col(f"`{c}`"), have[c], t).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return cols


def _tagged(sources: Sequence[DataFrame], key: str) -> DataFrame:
    if not sources:
        raise ValueError("merge needs at least one source")
    types = {c: t for c, t in column_types(sources).items() if c != key}
    tagged = [df.select(*_conform(df, key, types), F.lit(i).alias(_PRIO)) for i, df in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def _keyed(df: DataFrame, key: str) -> Column:
    """Whether a row's key names an entity."""
    k = F.col(f"`{key}`")
    return k.isNotNull() & (k != "") if dict(df.dtypes)[key] == "string" else k.isNotNull()


def _order(values: Sequence[str]) -> Column:
    """What decides between rows of one source: fewer nulls first, then the rendered row."""
    nulls = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in values], F.lit(0))
    return F.struct(nulls, F.to_json(F.struct(*[F.col(f"`{c}`") for c in values]))) if values else F.struct(F.lit(0))


ROWS = "_rows"
_ALONE = "_alone"


def picked_rows(df: DataFrame, key: str, priority: str) -> DataFrame:
    """One whole row per (key, source), and each different row without a key; ``ROWS`` counts the rows it stands for."""
    values = [c for c in df.columns if c not in (key, priority)]
    row = F.struct(*[F.col(f"`{c}`") for c in values], F.lit(0).alias("_any"))
    alone = F.when(~_keyed(df, key), F.coalesce(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), F.lit("")))
    picked = df.withColumn(_ALONE, alone).groupBy(key, priority, _ALONE).agg(
        F.min_by(row, _order(values)).alias("_row"), F.count(F.lit(1)).alias(ROWS))
    return picked.select(key, priority, *[F.col(f"_row.`{c}`").alias(c) for c in values], ROWS, _ALONE)


def merge_picked(picked: DataFrame, key: str, priority: str) -> DataFrame:
    """One row per key of ``picked_rows``; the least ``priority`` comes first.  Rows without a key come back one by one."""
    values = [c for c in picked.columns if c not in (key, priority, ROWS, _ALONE)]
    first = [F.min(F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.col(priority).alias("p"), F.col(f"`{c}`").alias("v"))))
             .getField("v").alias(c) for c in values]
    # rows without a key of different sources stay apart
    source = F.when(F.col(_ALONE).isNotNull(), F.col(priority)).alias("_source")
    merged = picked.groupBy(key, _ALONE, source).agg(*first, F.sum(ROWS).alias(ROWS))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col(_ALONE).isNull(), 1).otherwise(F.col(ROWS)))).alias("_copy")
    return merged.select("*", copies).select(key, *[F.col(f"`{c}`") for c in values])


def merge_by_priority(df: DataFrame, key: str, priority: str) -> DataFrame:
    """One row per key from rows tagged with their source; the least ``priority`` comes first."""
    return merge_picked(picked_rows(df, key, priority), key, priority)


def duplicate_rows(df: DataFrame, key: str, priority: str, picked: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` that differ from the row kept for their key and source (``picked``: what ``picked_rows`` gave)."""
    values = [c for c in df.columns if c not in (key, priority)]
    picked = picked_rows(df, key, priority) if picked is None else picked
    kept = picked.filter(F.col(_ALONE).isNull() & (F.col(ROWS) > 1)).select(
        F.col(key).alias("_k"), F.col(priority).alias("_p"), _order(values).alias("_kept"))
    joined = df.withColumn("_own", _order(values)).join(kept, (F.col(key) == F.col("_k")) & (F.col(priority) == F.col("_p")))
    return joined.filter(F.col("_own") != F.col("_kept")).select(*df.columns)


def merge_grouped(sources: Sequence[DataFrame], key: str = "name") -> DataFrame:
    """One row per key; each column takes the first non-null value by source order."""
    return merge_by_priority(_tagged(sources, key), key, _PRIO)


def merge_joined(sources: Sequence[DataFrame], key: str = "name") -> DataFrame:
    """Full outer join chain on ``key`` + ``coalesce`` in source order."""
    tagged = _tagged(sources, key)
    one = picked_rows(tagged.filter(_keyed(tagged, key)), key, _PRIO)
    values = [c for c in tagged.columns if c not in (key, _PRIO)]
    sides = [one.filter(F.col(_PRIO) == i).select(F.col(key), *[F.col(f"`{c}`").alias(f"{c}__src{i}") for c in values])
             for i in range(len(sources))]
    joined = reduce(lambda a, b: a.join(b, on=key, how="full"), sides)
    merged = joined.select(F.col(key), *[F.coalesce(*[F.col(f"`{c}__src{i}`") for i in range(len(sources))]).alias(c)
                                         for c in values])
    return merged.unionByName(tagged.filter(~_keyed(tagged, key)).drop(_PRIO))


# -- merge of sources stored by key -------------------------------------------------

def store_by_key(sources: Sequence[DataFrame], key: str, path: str, name: str, buckets: int) -> list[DataFrame]:
    """The sources as tables ``<name>_0`` ..., one row per key each, bucketed and sorted by ``key`` below ``path``, and
    their keys as ``<name>_keys``; returns the keys and the sources.

    Rows move once, when they are stored; ``merge_stored`` then reads matching buckets side by side.  A source
    that changes is stored again without the others.  Rows without a key are not stored.
    """
    tagged = _tagged(sources, key)
    spark = tagged.sparkSession
    one = picked_rows(tagged.filter(_keyed(tagged, key)), key, _PRIO).drop(ROWS, _ALONE)
    place = scratch_dir(spark, "picked")
    one.write.parquet(place)
    one = spark.read.schema(one.schema).parquet(place)

    def store(df: DataFrame, tag: str) -> DataFrame:
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option(
            "path", f"{path.rstrip('/')}/{tag}").saveAsTable(f"{name}_{tag}")
        return spark.table(f"{name}_{tag}")

    # the keys come from the work table: Spark 4.1 takes a union of bucketed scans for one that is dealt by the key
    return [store(one.select(key).distinct(), "keys"),
            *[store(one.filter(F.col(_PRIO) == i).drop(_PRIO), str(i)) for i in range(len(sources))]]


def merge_stored(stored: Sequence[DataFrame], key: str) -> DataFrame:
    """``merge_joined`` of what ``store_by_key`` returned, without an exchange: a full outer join of all sources
    as left joins from their keys, which keep the buckets' partitioning (a chain of full joins would lose it)."""
    keys, sources = stored[0], stored[1:]
    values = [c for c in sources[0].columns if c != key]
    sides = [s.select(F.col(key), *[F.col(f"`{c}`").alias(f"{c}__src{i}") for c in values]) for i, s in enumerate(sources)]
    joined = reduce(lambda a, b: a.join(b.hint("merge"), on=key, how="left"), sides, keys)
    return joined.select(key, *[F.coalesce(*[F.col(f"`{c}__src{i}`") for i in range(len(sources))]).alias(c) for c in values])
