"""The training-data pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet below the shared checkpoint folder and reads it back as the next stage's
documents.  All stages but the last return the columns of ``documents``.

Stages handle odd rows alike: null, empty and blank texts are not toxic, lose no lines, are copies of nothing,
hold no benchmark item and give no pieces; very long texts are worked on whole; rows without an id are kept by all
filters that judge by copies; a row repeated in full stays once after near-duplicate removal (rows without an id all
stay); an empty table gives an empty table; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm.common import WorkTables, ship_package, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents scored as toxic go."""
    from zoneflow.llm.toxicity import drop_toxic, fit

    ship_package(spark)
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: lines of recurring templates go; every document stays."""
    from zoneflow.llm.templates import drop_recurring_lines

    ship_package(spark)
    return drop_recurring_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies (five-word shingles, 80 percent) one document stays."""
    from zoneflow.llm.setsketch import drop_near_duplicates

    ship_package(spark)
    return drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    from zoneflow.llm.tiling import drop_leaks

    ship_package(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: what is left, packed into sequences."""
    from zoneflow.llm.packing import pack

    ship_package(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Kneser-Ney scores, likelihood estimates, string tiling and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces.

    A stage's table goes when the next one is written.
    """
    docs, work = table(spark, sf_dir, "documents"), WorkTables(spark)
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        work.drop_all_but(1)
    name, stage = STAGES[-1]
    return work.result(stage(spark, docs, sf_dir), f"pipeline-{name}")
