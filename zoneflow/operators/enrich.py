"""Lookup fill and the aggregates around it.

``fill_from_latest_known`` replaces a null / ``"NA"`` attribute (a team's
country) by the value known for the same key in the latest period (season) up
to and including the row's own period; keys never seen with a real value get
``"NA"``.  Knowledge therefore accumulates period by period, exactly like a
dictionary updated season after season -- but as one distributed plan, with no
collect, no Python UDF and no driver-side state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.functions.scores import NULL_TOKENS, is_null_token

UNKNOWN = "NA"


def _real(value: str) -> Column:
    return ~is_null_token(value)


def known_pairs(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct (key, value) pairs with a non-null value (A1 + P10)."""
    return df.select(key, value).filter(F.col(value).isNotNull()).distinct()


def latest_known_value(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Per key, the real value from the greatest ``order`` (A3; ties -> max value).

    Output columns: ``key``, ``order`` (of the winner), ``value``.  Partial
    aggregation runs before the shuffle, so hot keys are collapsed map-side.
    """
    best = F.max(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    return (df.filter(_real(value)).groupBy(key).agg(best.alias("_best"))
            .select(key, F.col("_best.o").alias(order), F.col("_best.v").alias(value)))


def row_counts(df: DataFrame, by: str = "season") -> DataFrame:
    """Rows per group (A2)."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))


def fill_plan(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Per (key, order) present in ``df``: latest real value at or before ``order``.

    One aggregate to (key, order) -- partial aggregation runs map-side, so a
    key holding many rows reaches the shuffle as one row per period per task --
    then the running "last known" window on that small table.
    """
    per_period = df.groupBy(F.col(key).alias("_fill_key"), F.col(order).alias("_fill_order")).agg(
        F.max(F.when(_real(value), F.col(value))).alias("_known"))
    upto = (Window.partitionBy("_fill_key").orderBy("_fill_order")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_period.select("_fill_key", "_fill_order", F.last("_known", ignorenulls=True).over(upto).alias("_fill"))


def fill_from_latest_known(df: DataFrame, key: str, value: str, order: str,
                           default: str = UNKNOWN) -> DataFrame:
    """Fill null-token ``value`` from the latest known value of ``key``.

    One lazy plan: aggregate to (key, order) with map-side combine, run the
    last-known window on that small table, and join it back to the rows that need a
    fill only.  Rows that already hold a real value are never shuffled.  Adaptive
    execution chooses how to join and splits a hot (key, order).
    """
    columns = df.columns
    needs = is_null_token(value)
    fill = fill_plan(df, key, value, order)
    match = F.col(key).eqNullSafe(F.col("_fill_key")) & F.col(order).eqNullSafe(F.col("_fill_order"))
    todo = df.filter(needs).join(fill, match, "left")
    todo = todo.withColumn(value, F.coalesce(F.col("_fill"), F.lit(default))).select(*columns)
    return df.filter(~needs).unionByName(todo)


def fill_with_state(df: DataFrame, state: DataFrame | None, key: str, value: str, order: str,
                    default: str = UNKNOWN) -> tuple[DataFrame, DataFrame]:
    """Incremental fill: new periods in ``df`` plus the knowledge carried in ``state``.

    ``state`` holds one row per key -- ``(key, order, value)``, the output of
    ``latest_known_value`` over every earlier period -- so a run touches only
    the new periods and a table with one row per key, never the whole history.
    Returns ``(filled_rows, new_state)``.  Equal to the full recomputation when
    periods arrive in order; re-processing an old period after newer ones must
    use the full ``fill_from_latest_known``.
    """
    if state is None:
        return fill_from_latest_known(df, key, value, order, default), latest_known_value(df, key, value, order)
    flag = "_zf_from_state"
    carried = state.select(key, order, value).withColumn(flag, F.lit(True))
    tagged = df.withColumn(flag, F.lit(False)).unionByName(carried, allowMissingColumns=True)
    filled = fill_from_latest_known(tagged, key, value, order, default).filter(~F.col(flag)).drop(flag)
    return filled, latest_known_value(tagged.drop(flag), key, value, order)


# -- knowledge as a table: late and corrected periods ------------------------------

KNOWN, GAPS = "known", "gaps"


def period_knowledge(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``(key, order, KNOWN, GAPS)``: what each period says of each key.

    ``KNOWN`` is the real value (of several the greatest), null where there is none; a known value holds from
    its period until the next one that knows another.  ``GAPS`` tells whether rows of the period need a fill.
    One row per key and period, whatever the number of rows behind it.
    """
    return df.groupBy(key, order).agg(F.max(F.when(_real(value), F.col(value))).alias(KNOWN),
                                      F.max(is_null_token(value)).alias(GAPS))


def fills_of(knowledge: DataFrame, key: str, order: str) -> DataFrame:
    """``(key, order, GAPS, fill)``: the value known of a key at or before each of its periods."""
    upto = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return knowledge.select(key, order, GAPS, F.last(KNOWN, ignorenulls=True).over(upto).alias("fill"))


def fill_from_knowledge(df: DataFrame, knowledge: DataFrame, key: str, value: str, order: str, default: str = UNKNOWN) -> DataFrame:
    """``fill_from_latest_known`` of ``df``'s periods with the knowledge of all periods (not of ``df`` alone)."""
    fill = fills_of(knowledge, key, order).select(F.col(key).alias("_k"), F.col(order).alias("_o"), F.col("fill").alias("_fill"))
    needs = is_null_token(value)
    match = F.col(key).eqNullSafe(F.col("_k")) & F.col(order).eqNullSafe(F.col("_o"))
    todo = df.filter(needs).join(fill, match, "left")
    todo = todo.withColumn(value, F.coalesce(F.col("_fill"), F.lit(default))).select(*df.columns)
    return df.filter(~needs).unionByName(todo)


def periods_that_move(before: DataFrame, after: DataFrame, key: str, order: str) -> DataFrame:
    """``(order)``: the periods with rows whose fill is not what it was, when ``before`` (knowledge) becomes ``after``.

    Only keys of which some period's knowledge changed are looked at.
    """
    old = before.select(F.col(key).alias("_k"), F.col(order).alias("_o"), F.col(KNOWN).alias("_was"))
    same = F.col(key).eqNullSafe(F.col("_k")) & F.col(order).eqNullSafe(F.col("_o"))
    changed = after.join(old, same, "full").filter(~F.col(KNOWN).eqNullSafe(F.col("_was"))).select(
        F.when(F.col("_o").isNull(), F.col(key)).otherwise(F.col("_k")).alias("_key")).distinct()

    def fills(knowledge: DataFrame) -> DataFrame:
        some = knowledge.join(changed, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        return fills_of(some, key, order)

    was = fills(before).select(F.col(key).alias("_k"), F.col(order).alias("_o"), F.col("fill").alias("_was"))
    now = fills(after).filter(GAPS).join(was, same, "left")
    return now.filter(~F.col("fill").eqNullSafe(F.col("_was"))).select(order).distinct()


__all__ = ["GAPS", "KNOWN", "NULL_TOKENS", "UNKNOWN", "fill_from_knowledge", "fill_from_latest_known", "fill_plan", "fill_with_state",
           "fills_of", "known_pairs", "latest_known_value", "period_knowledge", "periods_that_move", "row_counts"]
