"""Team-name cleaning: normalisation (F1) and synonym canonicalisation (F2).

Both are pure column expressions evaluated inside whole-stage codegen, without a
Python UDF or a driver-side dictionary; only rules that are data are closed block by
block in Python tasks (``close_rules``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from zoneflow.session import scratch_dir, ship_package

# --- fixed values (must equal the reference for identical results) ---------
# Whole words removed by name normalisation, in this order inside one
# alternation: sc bc acf afc fc cf club de la fútbol football 04
NAME_STOP_TOKENS = ("sc", "bc", "acf", "afc", "fc", "cf", "club", "de", "la", "fútbol", "football", "04")

# Ordered team-name synonym rules (source -> target), applied one after another,
# exact and case-sensitive.
TEAM_SYNONYM_RULES = (
    ("FC Barcelona", "Barcelona"),
    ("Barça", "Barcelona"),
    ("Manchester Utd", "Manchester United"),
    ("Man U", "Manchester United"),
    ("Real Madrid CF", "Real Madrid"),
    ("Los Blancos", "Real Madrid"),
    ("Bayern München", "Bayern Munich"),
    ("FC Bayern", "Bayern Munich"),
    ("Juventus FC", "Juventus"),
    ("La Vecchia Signora", "Juventus"),
    ("Paris Saint-Germain", "PSG"),
    ("PSG", "Paris Saint-Germain"),
    ("Chelsea FC", "Chelsea"),
    ("The Blues", "Chelsea"),
    ("Liverpool FC", "Liverpool"),
    ("The Reds", "Liverpool"),
    ("Manchester City FC", "Manchester City"),
    ("Man City", "Manchester City"),
    ("Inter Milano", "Inter Milan"),
    ("Inter Milan", "Inter Milan"),
    ("Atletico Madrid", "Atlético Madrid"),
    ("Atletico", "Atlético Madrid"),
    ("AC Milan", "Milan"),
    ("Milan AC", "Milan"),
    ("Tottenham Hotspur", "Tottenham"),
    ("Spurs", "Tottenham"),
    ("Sevilla FC", "Sevilla"),
    ("Benfica Lisbon", "Benfica"),
    ("SL Benfica", "Benfica"),
    ("Borussia Dortmund", "Dortmund"),
    ("BVB", "Dortmund"),
    ("Olympique de Marseille", "Marseille"),
    ("OM", "Marseille"),
    ("AS Roma", "Roma"),
    ("Giallorossi", "Roma"),
    ("Shakhtar Donetsk", "Shakhtar"),
    ("FC Shakhtar", "Shakhtar"),
    ("Ajax Amsterdam", "Ajax"),
    ("AFC Ajax", "Ajax"),
    ("RB Leipzig", "Leipzig"),
    ("RasenBallsport Leipzig", "Leipzig"),
    ("Zenit St. Petersburg", "Zenit"),
    ("FC Zenit", "Zenit"),
    ("Lazio Roma", "Lazio"),
    ("SS Lazio", "Lazio"),
    ("FC Porto", "Porto"),
    ("The Dragons", "Porto"),
    ("Sporting CP", "Sporting"),
    ("Sporting Lisbon", "Sporting"),
    ("Galatasaray SK", "Galatasaray"),
    ("Gala", "Galatasaray"),
    ("Red Star Belgrade", "Crvena Zvezda"),
    ("FK Crvena Zvezda", "Crvena Zvezda"),
    ("Celtic FC", "Celtic"),
    ("The Hoops", "Celtic"),
)
# ----------------------------------------------------------------------------

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(c: Column | str, stop_tokens: Sequence[str] = NAME_STOP_TOKENS) -> Column:
    """lower -> drop stop words -> drop non ``[a-z\\s]`` -> squeeze spaces -> trim.

    Accented letters and digits are removed (not transliterated), hyphens vanish.
    Word boundaries follow Java regex semantics (accented letters count as
    word characters).
    """
    words = r"\b(" + "|".join(stop_tokens) + r")\b"
    out = F.regexp_replace(F.lower(_col(c)), words, "")
    out = F.regexp_replace(out, r"[^a-z\s]", "")
    out = F.regexp_replace(out, r"\s+", " ")
    return F.trim(out)


def fold_rules(rules: Iterable[tuple[str, str]]) -> dict[str, str]:
    """Close an ordered rule list into one lookup map (plan time, driver side).

    Applying ``rules`` one after another (``if v == src: v = dst``) gives, for
    every source value, the value the returned map holds.  Identity results are
    left out, so the map only lists values that change.
    """
    rules = list(rules)
    closed: dict[str, str] = {}
    for start in dict.fromkeys(src for src, _ in rules):
        value = start
        for src, dst in rules:
            if value == src:
                value = dst
        if value != start:
            closed[start] = value
    return closed


def canonicalize(c: Column | str, rules: Iterable[tuple[str, str]] = TEAM_SYNONYM_RULES) -> Column:
    """Map a value through the folded synonym rules; unknown values and null pass.

    For rules written in code, like the fixed list above.  Rules that are data belong
    in a table: ``canonicalize_by_join``.
    """
    closed = fold_rules(rules)
    if not closed:
        return _col(c)
    lookup = F.create_map(*[F.lit(x) for pair in closed.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, _col(c)), _col(c))


#: Ordered rules that one task closes; a task's memory holds at most one entry for each of them.
BLOCK_RULES = 200_000


def _closed_in_blocks(rules: DataFrame, blocks: int) -> DataFrame:
    """``(block, source, target)``: what each of ``blocks`` consecutive ranges of the ordered rules makes of the values it changes.

    A block is closed from its last rule back, so its rows apply at once, not in turn; sources are unique in it.
    """
    ship_package(rules.sparkSession)
    kind = rules.schema["source"].dataType
    # text travels as its bytes
    source, target = (F.col(c).cast("binary" if isinstance(kind, StringType) else kind).alias(c) for c in ("source", "target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closed: dict = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for value, becomes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                becomes = closed.get(becomes, becomes)
                if becomes == value:
                    closed.pop(value, None)
                else:
                    closed[value] = becomes
        left = list(closed.items())
        for at in range(0, len(left), 10_000):
            some = left[at:at + 10_000]
            yield pa.record_batch([pa.array([r[k] for r in some], schema.field(k).type) for k in range(2)], names=["source", "target"])

    order = ["position", "source", "target"]
    back = rules.repartitionByRange(blocks, *order).sortWithinPartitions(*map(F.desc, order)).select(source, target)
    return back.mapInArrow(run, back.schema).select(F.spark_partition_id().alias("block"), F.col("source").cast(kind).alias("source"),
                                                    F.col("target").cast(kind).alias("target"))


def close_rules(rules_df: DataFrame) -> DataFrame:
    """``(source, target)`` of every value that the ordered rules ``(position, source, target)`` change in the end.

    Rules apply one after another, so after a rule only later positions can fire on its target.  Blocks of about
    ``BLOCK_RULES`` consecutive rules are closed first, one task each.  Every row of a block then points to the row of
    the next block that fires on its target, and the pointers are doubled until each is at the end of its chain: a chain
    has one row of a block at most, so at most about log2 of the number of blocks many joins of these rows with
    themselves, each written below the checkpoint folder.
    Equal positions apply in the order of source, then target; rules with a null are left out.
    """
    spark = rules_df.sparkSession

    def kept(df: DataFrame, tag: str) -> DataFrame:
        path = scratch_dir(spark, tag)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    ordered = kept(rules_df.select("position", "source", "target").dropna().distinct(), "rules")
    blocks = -(-ordered.count() // BLOCK_RULES)   # from the files' footers
    closed = _closed_in_blocks(ordered, max(blocks, 1))
    rules = kept(closed.withColumn("rule", F.struct("block", "source", "target")), "closed-blocks")
    # per value, from the last block back: the row of a later block that fires on it
    fires = rules.select(F.col("source").alias("value"), "rule", F.lit(0).alias("fired"))
    fired = rules.select(F.col("target").alias("value"), "rule", F.lit(1).alias("fired"))
    ahead = Window.partitionBy("value").orderBy(F.desc("rule.block"), F.desc("fired")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.last(F.when(F.col("fired") == 0, F.col("rule")), ignorenulls=True).over(ahead)
    now = fires.unionByName(fired).withColumn("next", following).filter("fired = 1").select("rule", "next")
    now = kept(now, "rule-pointers")
    while True:
        beyond = now.filter("next is not null").select(F.col("rule").alias("r"), F.col("next").alias("n"))
        joined = now.join(beyond, F.col("next") == F.col("r"), "left")
        now = kept(joined.select("rule", F.coalesce("n", "next").alias("next"), F.col("n").isNotNull().alias("moved")), "rule-pointers")
        if now.filter("moved").isEmpty():
            break
        now = now.select("rule", "next")
    first = rules.groupBy("source").agg(F.min("rule").alias("rule"))
    last = first.join(now, "rule").select("source", F.coalesce("next", "rule").getField("target").alias("target"))
    return last.filter("source != target")


def canonicalize_by_join(df: DataFrame, column: str, rules_df: DataFrame) -> DataFrame:
    """Canonicalise ``column`` with an already-closed rule table of any size (``close_rules`` makes one).

    ``rules_df`` has columns ``source``/``target`` with unique sources.  The
    join is a plain left equi-join; Spark (AQE) broadcasts the rule side only
    when its measured size is under the broadcast threshold and otherwise
    shuffles both sides, so no unchecked broadcast happens here.
    """
    rules = rules_df.select(F.col("source").alias("_syn_src"), F.col("target").alias("_syn_dst"))
    joined = df.join(rules, df[column] == rules["_syn_src"], "left")
    return joined.withColumn(column, F.coalesce(F.col("_syn_dst"), F.col(column))).drop("_syn_src", "_syn_dst")
