"""Queries of the training-data operators: thin callers with production parameters.

``QUERIES`` and ``ORACLES`` are added to the catalogue by ``__spark_entry__``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.common import WorkTables, crc_mod, ship_package, table
from zoneflow.llm.oracles import ORACLES
from zoneflow.session import scratch_dir
from zoneflow.sinks.writers import remove_path

__all__ = ["ORACLES", "QUERIES"]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 512 to 4096 words."""
    from zoneflow.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op2_warc_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two WARC replicas of all pages, one of them damaged: the records in which they differ.

    The damage is made here, as no table holds any: the last character of every page whose
    id leaves 7 when divided by 101.
    """
    from zoneflow.llm.warc import audit, read_records, write_warc

    pages = table(spark, sf_dir, "pages")
    good, bad = scratch_dir(spark, "warc-a"), scratch_dir(spark, "warc-b")
    write_warc(pages, good)
    hurt = (F.pmod("page_id", F.lit(101)) == 7) & (F.length("html") > 0)
    last = F.when(F.endswith("html", F.lit("~")), "!").otherwise("~")
    damaged = F.concat(F.expr("substring(html, 1, length(html) - 1)"), last)
    write_warc(pages.withColumn("html", F.when(hurt, damaged).otherwise(F.col("html"))), bad)
    work = WorkTables(spark)
    found = audit(read_records(spark, good, work), read_records(spark, bad, work), work)
    for replica in (good, bad):
        remove_path(spark, replica)
    return found


def op3_token_ids_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as ORC and read back."""
    import public_tokenizers

    from zoneflow.llm.token_ids import read_token_ids, with_crc32, write_token_ids

    path = write_token_ids(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-ids"),
                           public_tokenizers.path("word_bpe_49k.json"), by_word=True)
    return with_crc32(read_token_ids(spark, path))


def op4_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from zoneflow.llm.winnowing import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes over two-word shingles at 80 percent."""
    from zoneflow.llm.setsketch import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op6_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled rows that are not held out."""
    from zoneflow.llm.toxicity import fit, toxicity_scores

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), held_out_rest=0, folds=5)
    scored = toxicity_scores(docs, model)
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    from zoneflow.llm.url_rules import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


def op8_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-bigram and unigram log probabilities of every document."""
    from zoneflow.llm.brown import held_out_scores

    return held_out_scores(table(spark, sf_dir, "documents"))


def op9_string_tiling_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in whatever order its parts come."""
    from zoneflow.llm.tiling import leaks

    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_tokens", "covered", "coverage", F.size("tiles").alias("n_tiles"))


def op10_log_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates."""
    from zoneflow.llm.templates import drop_recurring_lines

    clean = drop_recurring_lines(table(spark, sf_dir, "documents"), report=True)
    return clean.select("doc_id", "lines_before", "lines_dropped", F.length("text").cast("long").alias("kept_chars"),
                        F.sha2("text", 256).alias("kept_sha256"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged here by the contract's rule, and their cheapest repairs."""
    from zoneflow.llm.transcripts import damage, repaired_digests

    rows = table(spark, sf_dir, "conversations")
    return repaired_digests(damage(rows), rows)


def op12_int8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of equal label at cosine 0.98."""
    from zoneflow.llm.embeddings import near_duplicate_vectors

    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op13_qchunk_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents (some damaged here, by the contract's rule) with the form they are a variant of."""
    from zoneflow.llm.spelling import spelling_variants, word_counts

    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), damage=True))


def _registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _registered(q) for q in (
    op1_best_fit_packing, op2_warc_merkle_audit, op3_token_ids_orc, op4_winnowing_fingerprints,
    op5_setsketch_near_duplicates, op6_toxicity_kneser_ney, op7_url_rules, op8_brown_class_lm,
    op9_string_tiling_leaks, op10_log_template_lines, op11_repair_conversations,
    op12_int8_near_vectors, op13_qchunk_spelling,
)}
